"""Near-duplicate lines by a segment-partition edit join.

Two lines are near if at most ``edits`` insertions, deletions and replacements of characters turn one into the other. A line
is cut into ``edits`` + 1 segments; a near line holds at least one of them unchanged, at a place that its length limits. So
a line signs its own segments by (length, segment, text), and looks up, for every length that a near line that is not
longer can have, the substrings of its own that could be such a segment. Lines that share a key are compared by a
bit-parallel edit distance in a band of 2 * ``edits`` + 1 diagonals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.candidates import PACKED, packed, resolve, shared
from clickfeat.llm.common import BROADCAST_ROWS, join_groups, semi_join, stored
from clickfeat.llm.components import components
from clickfeat.llm.substrings import keyed
from clickfeat.llm.words import mix

EDITS = 2
MIN_CHARS = 20  # shorter lines are only equal or not
SKETCH = 4  # longs of a line's sketch
BUCKET_BYTES = 4 << 20
CHARS = 1 << 18  # characters handled at a time
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)


def segment(length: np.ndarray, number: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of a segment of lines of the given lengths; the last segments take the remainder."""
    size, longer = length // (edits + 1), length % (edits + 1)
    first_long = edits + 1 - longer
    return number * size + np.maximum(number - first_long, 0), size + (number >= first_long)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def keys(chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the lines ``chars[starts[i]:starts[i] + lengths[i]]``, and the number i of each.

    For a line of length l and a near one of length l - d, segment number i (from 0) of the shorter one can start in the
    longer one at the same place plus a shift s, where |s| <= i (the edits before it), |d - s| <= edits - i (the edits
    after it).
    """
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * _powers(len(chars), _BASE), dtype=np.uint64)])
    down = _powers(len(chars) + 1, _INVERSE)
    found, owners = [], []
    for d in range(edits + 1):
        for number in range(edits + 1):
            for shift in range(-number, number + 1):
                if abs(d - shift) > edits - number:
                    continue
                length = lengths - d
                begin, size = segment(length, number, edits)
                use = np.flatnonzero((begin + shift >= 0) & (begin + shift + size <= lengths) & (size > 0))
                at = starts[use] + begin[use] + shift
                content = (sums[at + size[use]] - sums[at]) * down[at]
                place = mix((length[use].astype(np.uint64) << np.uint64(8)) + np.uint64(number + 1))
                found.append(mix(content + place))
                owners.append(use)
    return np.concatenate(found), np.concatenate(owners)


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: common ends are cut off, then the vertical differences of the
    band of 2 * edits + 1 diagonals are kept as bits of two numbers that move down one row per character."""
    if abs(len(a) - len(b)) > edits:
        return False
    x, y = np.frombuffer(a.encode("utf-32-le"), np.uint32), np.frombuffer(b.encode("utf-32-le"), np.uint32)
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    x, y = x[: len(x) - tail].tolist(), y[: len(y) - tail].tolist()
    if not x or not y:
        return len(x) + len(y) <= edits
    m, n, k = len(x), len(y), edits
    width = 2 * k + 1
    mask, top = (1 << width) - 1, 1 << (width - 1)
    # Bit p of the band in column j stands for row j - k + p; ``match`` is shifted so that the bits line up with it.
    rows: dict[int, int] = {}
    plus, minus, score = mask ^ ((1 << k) - 1), 0, min(k, m)  # column 0: one more for each row
    for r in range(min(k, m)):
        rows[x[r]] = rows.get(x[r], 0) | 1 << (k + 1 + r)
    for j in range(1, n + 1):
        rows = {c: bits >> 1 for c, bits in rows.items() if bits >> 1}
        if j + k <= m:
            c = x[j + k - 1]
            rows[c] = rows.get(c, 0) | top
        match = rows.get(y[j - 1], 0)
        diagonal = ((((match & plus) + plus) ^ plus) | match | minus) & mask
        horizontal_plus = (minus | ~(diagonal | plus)) & mask
        horizontal_minus = diagonal & plus
        shifted = diagonal >> 1
        plus = (horizontal_minus | ~(shifted | horizontal_plus)) & mask
        minus = shifted & horizontal_plus
        # The score follows the last diagonal of the band until its lower end, then the last row upwards.
        if j + k <= m:
            score += 0 if diagonal & top else 1
        else:
            bit = 1 << (m - j + k)
            score += (1 if horizontal_plus & bit else 0) - (1 if horizontal_minus & bit else 0)
        if score > 3 * k:
            return False
    return score <= k


def with_sketches(texts: DataFrame) -> DataFrame:
    """``texts`` (node, text) plus ``fact``: the length, and which of 64 * SKETCH kinds of character pairs (by hash) occur an
    odd number of times. One edit takes away or adds four pairs at most, so it changes four kinds at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, kinds = [], []
            for text in batch.column("text").to_pylist():
                c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
                pairs = mix((c[:-1] << np.uint64(32)) + c[1:]) % np.uint64(64 * SKETCH)
                odd = np.bincount(pairs.astype(np.int64), minlength=64 * SKETCH) & 1
                chars.append(len(c))
                kinds.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            both = np.array(kinds, np.int64).reshape(-1, SKETCH)
            columns = [pa.array(chars, pa.int32()), *[pa.array(np.ascontiguousarray(both[:, i])) for i in range(SKETCH)]]
            fact = pa.StructArray.from_arrays(columns, ["chars", *[f"w{i}" for i in range(SKETCH)]])
            yield pa.RecordBatch.from_arrays([*batch.columns, fact], ["node", "text", "fact"])

    fields = ", ".join(f"w{i}:long" for i in range(SKETCH))
    return texts.select("node", "text").mapInArrow(run, f"node long, text string, fact struct<chars:int, {fields}>")


def can_be_near(a: Column, b: Column, edits: int) -> Column:
    """Whether lines with these facts can be near; far lines are told apart without their texts."""
    changed = sum((F.bit_count(a[f"w{i}"].bitwiseXOR(b[f"w{i}"])) for i in range(SKETCH)), F.lit(0))
    return (F.abs(a["chars"] - b["chars"]) <= edits) & (changed <= 4 * edits)


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc, sub, line, text, node) of every line that is not blank; ``node`` is a hash of the line."""
    parts = docs.select("doc", "sub", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    return parts.where(F.length(F.trim("text")) > 0).withColumn("node", F.xxhash64("text"))


def _signed(lines: DataFrame, edits: int, min_chars: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                node = batch.column("node").to_numpy()
                _, first = np.unique(node, return_index=True)
                texts = batch.column("text").take(pa.array(first))
                node, lengths = node[first], pc.utf8_length(texts).to_numpy().astype(np.int64)
                use = np.flatnonzero(lengths >= min_chars)
                ends = np.cumsum(lengths[use])
                i = 0
                while i < len(use):
                    j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CHARS, "right")))
                    group = use[i:j]
                    chars = "".join(texts.take(pa.array(group)).to_pylist()).encode("utf-32-le")
                    size = lengths[group]
                    found, owner = keys(np.frombuffer(chars, np.uint32), np.cumsum(size) - size, size, edits)
                    yield found, node[group][owner]
                    i = j

        yield from packed(parts(), buckets)

    return lines.select("node", "text").mapInArrow(run, PACKED)


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [within(x, y, edits) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    named = lambda node, column, name: texts.select(F.col("node").alias(node), F.col(column).alias(name))
    facts = pairs.join(named("a", "fact", "_f"), "a").join(named("b", "fact", "_g"), "b")
    near = facts.where(can_be_near(F.col("_f"), F.col("_g"), edits)).select("a", "b")
    near = near.join(named("a", "text", "x"), "a").join(named("b", "text", "y"), "b")
    return near.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept): every row of ``docs`` (doc_id, text) without the lines that repeat an earlier one.

    Lines are parted by line feeds. Lines that are equal, or linked by a chain of near lines (of ``min_chars`` characters
    or more), are one class; the first line of a class stays (smallest id, NULL ids first, then the earlier line), all
    others go. Blank lines stay. NULL text has no lines and stays NULL. Repeated rows are one document and get equal
    results; rows of one id with different texts are ordered by a hash of the text. Other columns are not read; an empty
    table gives no rows. Equal lines are found by a 64-bit hash.
    """
    rows = keyed(docs)
    lines = split_lines(rows)
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    members = stored(shared(_signed(lines, edits, min_chars, int(text_bytes // BUCKET_BYTES) + 1)), "line-members")
    alike = stored(members.select("node").distinct(), "line-alike")
    texts = semi_join(lines.select("node", "text"), alike, "node").dropDuplicates(["node"])
    texts = stored(with_sketches(texts), "line-texts")
    near = lambda a, b: can_be_near(a, b, edits)
    links = resolve(members, lambda pairs: _verified(pairs, texts, edits), texts.select("node", "fact"), near)
    label = stored(components(links), "line-components")
    few = label.count() <= BROADCAST_ROWS
    places = lines.select("doc", "sub", "line", "node").join(F.broadcast(label) if few else label, "node", "left")
    places = stored(places.select("doc", "sub", "line", F.coalesce("component", "node").alias("class")), "line-places")
    place = F.struct("doc", "sub", "line")
    first = places.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several = join_groups(places, stored(first, "line-first"), "class", F.xxhash64("doc", "sub", "line"))
    again = stored(several.where(place != F.col("first")).select("doc", "sub", "line").distinct(), "line-again")
    lists = again.groupBy("doc", "sub").agg(F.collect_set("line").alias("gone"))
    full = rows.join(F.broadcast(lists) if again.count() <= BROADCAST_ROWS else lists, ["doc", "sub"], "left")
    parts = F.split("text", "\n", -1)
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    numbers = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    return full.select(
        "doc_id",
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(numbers, lambda i: F.get(parts, i)), "\n")
        ).alias("kept"),
    )
