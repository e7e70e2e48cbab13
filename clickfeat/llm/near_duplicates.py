"""N-gram Jaccard join with PartEnum signatures, and its connected components.

A document is the set of its distinct ``width``-word shingles (hashed to 64 bits). Two documents link when
``100 * |intersection| >= percent * |union|``. Sizes are cut into bands, each the length of the largest ratio of linked
sizes, so linked sets lie in one band or in neighbouring ones; a set is signed once for its own band and once for the next.
Within a band the bound on the symmetric difference is k: the hashed domain is cut into n1 parts, at least one of which
differs in few elements, and that part into n2 pieces, of which all subsets of n2 - k2 are enumerated. Linked sets
share the hash of their content on at least one subset.

Sets that are equal are linked first and signed once. Candidates come from equal signatures, see ``candidates``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.candidates import PACKED, packed, resolve, shared
from clickfeat.llm.common import BROADCAST_ROWS, join_groups, semi_join, stored
from clickfeat.llm.components import components
from clickfeat.llm.words import Words, inside, mix, window_hashes, words_of

WIDTH, PERCENT = 4, 85
SPARE = 16  # one part in so many, and one more, is beyond what the bound asks for, so that empty subsets need not count
SCHEMES = 8  # partitions of the domain that are tried for sets with too many empty subsets
SKETCH = 8  # longs of a set's sketch
BUCKET_BYTES = 4 << 20  # text bytes per signature bucket


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and where each row begins. A row of fewer than ``width``
    words has its whole sequence as its only shingle, a row without words none."""
    counts = words.counts()
    found = window_hashes(words.hashes, width)
    ok = inside(words.bounds, width, len(found))
    row = np.repeat(np.arange(words.rows), counts)[: len(found)]
    values, rows = [found[ok]], [row[ok]]
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            at = words.bounds[short][:, None] + np.arange(n)
            total = np.zeros(len(short), np.uint64)
            for column in range(n):
                total = mix(total + words.hashes[at[:, column]] + np.uint64(n))
            values.append(total)
            rows.append(short)
    value, row = np.concatenate(values), np.concatenate(rows)
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(words.rows + 1))


def bands(largest: int, percent: int) -> np.ndarray:
    """Upper ends of the size bands, up to one beyond that of ``largest``."""
    ends = [0]
    while len(ends) < 3 or ends[-2] < largest:
        ends.append((ends[-1] + 1) * 100 // percent)
    return np.array(ends[1:])


def layout(bound: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, spare parts among n1) for sets that differ in at most ``bound`` elements."""
    if bound == 0:
        return 1, 1, 0, 0
    if bound <= 3:
        return 1, (3, 4, 6)[bound - 1], bound, 0
    needed = bound // 2 + 1
    spare = 1 + needed // SPARE
    return needed + spare, 3, 1, spare


def _enumerated(values: np.ndarray, starts: np.ndarray, tag: np.ndarray, bound: np.ndarray, scheme: int, last: bool):
    """Signatures of one scheme, the number of the set of each, and which sets ask for another scheme.

    Of the first-level parts, one more than the spare ones at least agree on a subset of their pieces. A set of which no
    more parts than the spare ones have an empty subset therefore agrees on a subset that is not empty, and need not
    sign the empty ones, which unrelated sets would share. The others go to the next scheme, another partition of the
    domain: a pair is found in the first scheme that is good for one of the two. Only the last scheme signs empty subsets.
    """
    sizes = np.diff(starts)
    n1, n2, k2, spare = np.array([layout(b) for b in range(int(bound.max(initial=0)) + 1)])[bound].T
    n1 = np.where(sizes > 0, n1, 0)
    pieces = n1 * n2
    base = np.concatenate([[0], np.cumsum(pieces)])
    # The hash is sorted within a set, and so is the piece, which is its high part scaled to the number of pieces.
    piece = ((values >> np.uint64(32)) * np.repeat(pieces, sizes).astype(np.uint64)) >> np.uint64(32)
    slot = np.repeat(base[:-1], sizes) + piece.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
    sums, counts = np.zeros(base[-1], np.uint64), np.zeros(base[-1], np.int64)
    if len(first):
        sums[slot[first]] = np.add.reduceat(mix(values + np.uint64(0x51ED2701A5)), first)
        counts[slot[first]] = np.diff(np.append(first, len(slot)))
    out, owners, bad = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], np.zeros(len(sizes), bool)
    for two, keep in sorted({(int(x), int(x - y)) for x, y in zip(n2, k2)}):
        mine = (n2 == two) & (n2 - k2 == keep) & (sizes > 0)
        use = np.repeat(mine, pieces)
        owner = np.repeat(np.flatnonzero(mine), n1[mine])
        part = np.arange(len(owner)) - np.repeat(np.cumsum(n1[mine]) - n1[mine], n1[mine])
        grid, size = sums[use].reshape(-1, two), counts[use].reshape(-1, two)
        subsets = list(itertools.combinations(range(two), keep))
        total = np.stack([grid[:, x].sum(axis=1, dtype=np.uint64) for x in subsets], axis=1)
        empty = np.stack([size[:, x].sum(axis=1) == 0 for x in subsets], axis=1)
        place = (tag[owner].astype(np.uint64) << np.uint64(32)) + part.astype(np.uint64)
        code = mix(place + (np.uint64(scheme) << np.uint64(56)))[:, None]
        code = code + np.arange(1, len(subsets) + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
        gaps = np.bincount(owner[empty.any(axis=1)], minlength=len(sizes))
        bad |= gaps > spare
        signed = ~empty | (last & bad[owner][:, None])
        out.append(mix(total + code)[signed])
        owners.append(np.repeat(owner, len(subsets)).reshape(-1, len(subsets))[signed])
    return np.concatenate(out), np.concatenate(owners), bad


def signatures(values: np.ndarray, starts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets ``values[starts[i]:starts[i + 1]]``, and the number i of the set of each."""
    sizes = np.diff(starts)
    ends = bands(int(sizes.max(initial=1)), percent)
    own = np.searchsorted(ends, np.maximum(sizes, 1))
    out, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for tag in (own, own + 1):
        bound = 2 * ends[tag] * (100 - percent) // (100 + percent)
        sets, value, start = np.arange(len(sizes)), values, starts
        for scheme in range(SCHEMES):
            found, owner, bad = _enumerated(value, start, tag[sets], bound[sets], scheme, scheme == SCHEMES - 1)
            out.append(found)
            owners.append(sets[owner])
            if not bad.any():
                break
            # The sets that ask for it go on with another hash of their elements.
            size = np.diff(start)
            value = mix(value[np.repeat(bad, size)] ^ np.uint64(0x2545F4914F6CDD1D))
            sets, size = sets[bad], size[bad]
            row = np.repeat(np.arange(len(sets)), size)
            value = value[np.lexsort((value, row))]
            start = np.concatenate([[0], np.cumsum(size)])
    return np.concatenate(out), np.concatenate(owners)


def with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) plus ``_node``, a number that only rows equal in both share: the id itself, or a hash of
    id and text where an id is NULL or stands for several rows."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | F.col("doc_id").isNull())
    repeated = stored(repeated.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_again")), "repeated-ids")
    if repeated.isEmpty():
        return docs.withColumn("_node", F.col("doc_id").cast("long"))
    joined = docs.join(repeated, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    node = F.when(F.col("_again"), F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(5))).otherwise(F.col("doc_id"))
    return joined.withColumn("_node", node.cast("long")).drop("_again")


def _digests(docs: DataFrame, width: int) -> DataFrame:
    """(node, doc_id, n, d1, d2): the size of every set and a 128-bit digest of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two = [], [], []
            for words in words_of(batch.column("text"), lower=True):
                values, starts = shingle_sets(words, width)
                sizes.append(np.diff(starts))
                for salt, into in ((0x1234567, one), (0x89ABCDE, two)):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(salt)), dtype=np.uint64)])
                    into.append(sums[starts[1:]] - sums[starts[:-1]])
            flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_node"), batch.column("doc_id"), pa.array(flat(sizes, np.int64)),
                 pa.array(flat(one, np.uint64).view(np.int64)), pa.array(flat(two, np.uint64).view(np.int64))],
                ["node", "doc_id", "n", "d1", "d2"],
            )

    return docs.mapInArrow(run, "node long, doc_id long, n long, d1 long, d2 long")


def _signed(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Signatures of all documents, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                nodes = batch.column("_node").to_numpy(zero_copy_only=False)
                for words in words_of(batch.column("text"), lower=True):
                    found, owner = signatures(*shingle_sets(words, width), percent)
                    yield found, nodes[words.first + owner]

        yield from packed(parts(), buckets)

    return docs.select("_node", "text").mapInArrow(run, PACKED)


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """(node, fact, n, sketch): the size of every set and two sketches of it, one in ``fact``, see ``can_link`` and ``close``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bits, cells = [], [], []
            for words in words_of(batch.column("text"), lower=True):
                values, starts = shingle_sets(words, width)
                sizes += np.diff(starts).tolist()
                bits.append(_parities(values, starts))
                cells += _wide_parities(values, starts)
            sketch = np.concatenate(bits) if bits else np.zeros((0, SKETCH), np.int64)
            n = pa.array(sizes, pa.int64())
            fact = pa.StructArray.from_arrays(
                [n, *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH)]], ["n", *[f"w{i}" for i in range(SKETCH)]]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("_node"), fact, n, pa.array(cells, pa.binary())], ["node", "fact", "n", "sketch"]
            )

    fields = ", ".join(f"w{i}:long" for i in range(SKETCH))
    return docs.select("_node", "text").mapInArrow(run, f"node long, fact struct<n:long, {fields}>, n long, sketch binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the sets themselves, as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for words in words_of(batch.column("text"), lower=True):
                values, starts = shingle_sets(words, width)
                cells += [values[i:j].tobytes() for i, j in itertools.pairwise(starts)]
            yield pa.RecordBatch.from_arrays([batch.column("_node"), pa.array(cells, pa.binary())], ["node", "shingles"])

    return docs.select("_node", "text").mapInArrow(run, "node long, shingles binary")


def _once(docs: DataFrame) -> DataFrame:
    """``docs`` (_node, doc_id, text) with one row of each node. Only rows of ids that stand for several rows, whose nodes
    are not their ids, can be repeated; the texts of the others are not shuffled."""
    own = F.col("_node").eqNullSafe(F.col("doc_id"))
    return docs.where(own).unionByName(docs.where(~own).dropDuplicates(["_node"]))


def _parities(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each set, whether it has an odd number of elements in each of 64 * SKETCH classes, as SKETCH longs. The bits
    in which two sets differ are at most as many as the elements in which they differ."""
    rows, width = len(starts) - 1, 64 * SKETCH
    slot = np.repeat(np.arange(rows), np.diff(starts)) * width + (mix(values) % np.uint64(width)).astype(np.int64)
    odd = (np.bincount(slot, minlength=rows * width) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(rows, SKETCH)


def _wide_parities(values: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """For each set of n elements, the same over at least n classes, a power of two from 64 on. Classes follow the low bits
    of a hash, so halving a sketch by the exclusive or of its halves gives the sketch of half as many classes."""
    sizes = np.diff(starts)
    width = 64 << np.ceil(np.log2(np.maximum(sizes, 64) / 64)).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(width)])
    slot = np.repeat(base[:-1], sizes) + (mix(values) & np.repeat(width - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(slot, minlength=base[-1]) & 1).astype(np.uint8)
    raw = np.packbits(odd).tobytes()
    return [raw[i:j] for i, j in itertools.pairwise((base // 8).tolist())]


def close(n: int, one: np.ndarray, m: int, two: np.ndarray, percent: int) -> bool:
    """Whether sets of n and m elements with these wide sketches (bytes) can link, as in ``can_link``."""
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] ^ two[len(two) // 2 :]
    differ = max(int(np.bitwise_count(one ^ two).sum()), abs(n - m))
    return differ * (100 + percent) <= (n + m) * (100 - percent)


def can_link(a: Column, b: Column, percent: int) -> Column:
    """Whether sets with these facts can link: what differs is at most (100 - percent) / (100 + percent) of both sizes."""
    differ = sum((F.bit_count(a[f"w{i}"].bitwiseXOR(b[f"w{i}"])) for i in range(SKETCH)), F.lit(0))
    at_least = F.greatest(differ, F.abs(a["n"] - b["n"]))
    return at_least * (100 + percent) <= (a["n"] + b["n"]) * (100 - percent)


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the intersection of their sets. Sketches go to all pairs; sets are made and sent
    only for the few pairs whose sketches are close."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(name) for name in ("n", "x", "m", "y")))
            keep = [
                close(n.as_py(), np.frombuffer(x.as_buffer(), np.uint8), m.as_py(), np.frombuffer(y.as_buffer(), np.uint8), percent)
                for n, x, m, y in rows
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    named = lambda df, node, **names: df.select(F.col("node").alias(node), *[F.col(k).alias(v) for k, v in names.items()])
    both = pairs.join(named(sketches, "a", n="n", sketch="x"), "a").join(named(sketches, "b", n="m", sketch="y"), "b")
    near = stored(both.select("a", "b", "n", "x", "m", "y").mapInArrow(sketched, "a long, b long"), "near-close")
    needed = near.select(F.explode(F.array("a", "b")).alias("_node")).distinct()
    sets = stored(_sets(_once(semi_join(docs, needed, "_node", 2 * near.count())), width), "near-sets")
    full = near.join(named(sets, "a", shingles="x"), "a").join(named(sets, "b", shingles="y"), "b")
    return full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, first) for every row of ``docs`` (doc_id, text); other columns are not read.

    ``component_id`` is the smallest id among the documents reachable by links, the row's own included; ``node`` tells
    rows apart (see ``with_nodes``), and ``first`` marks the node of the component that has this id. Words are compared
    without the case of A-Z. A text without words, NULL included, has no shingles and links with nothing. Rows with a
    NULL id link like others; their component has the smallest id that is not NULL, or NULL. Repeated rows are one
    document; rows of one id with different texts are judged one by one. An empty table gives no rows.
    """
    keyed = with_nodes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    all_sets = stored(_digests(keyed, width), "near-digests")
    nodes = all_sets.where(F.col("n") > 0).select("node", "n", "d1", "d2").distinct()
    first = nodes.groupBy("n", "d1", "d2").agg(F.min("node").alias("a"))
    equal = nodes.join(first, ["n", "d1", "d2"]).where(F.col("node") != F.col("a"))
    equal = stored(equal.select("a", F.col("node").alias("b")), "near-equal")

    # Equal sets are signed once, by their smallest node; sets without elements are not signed.
    idle = stored(
        equal.select(F.col("b").alias("_node")).unionByName(all_sets.where("n = 0").select(F.col("node").alias("_node"))).distinct(),
        "near-idle",
    )
    side = F.broadcast(idle) if idle.count() <= BROADCAST_ROWS else idle
    distinct = keyed.select("_node", "doc_id", "text").join(side, "_node", "left_anti")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    signed = _signed(distinct, width, percent, int(text_bytes // BUCKET_BYTES) + 1)
    members = stored(shared(signed), "near-members")

    alike = stored(members.select(F.col("node").alias("_node")).distinct(), "near-alike")
    sketches = stored(_sketches(_once(semi_join(distinct, alike, "_node")), width), "near-sketches")
    verify = lambda pairs: _verified(pairs, sketches, distinct, width, percent)
    possible = lambda a, b: can_link(a, b, percent)
    links = resolve(members, verify, sketches.select("node", "fact"), possible)
    label = stored(components(links.unionByName(equal)), "near-components")
    side = F.broadcast(label) if label.count() <= BROADCAST_ROWS else label
    salt = F.xxhash64(F.monotonically_increasing_id())  # of the place in the written table, so reruns of a task agree
    joined = all_sets.withColumn("_salt", salt).join(side, "node", "left")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "node")
    linked = joined.where(F.col("component").isNotNull()).groupBy(F.col("component").alias("_c"))
    least = linked.agg(F.min("doc_id").alias("component_id"), F.min(order).alias("_least"), F.count(F.lit(1)).alias("_n"))
    # A node without links is a component of its own, whatever the number of its rows.
    full = joined.withColumn("_alone", F.col("component").isNull()).withColumn("_c", F.coalesce("component", "node"))
    full = join_groups(full, stored(least, "near-least"), "_c", F.col("_salt"), "left")
    return full.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("_alone"), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
        (F.col("_alone") | (order == F.col("_least"))).alias("first"),
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, the first; repeated rows count as one. Columns are kept."""
    gone = near_duplicates(docs, width, percent).where(~F.col("first")).select(F.col("node").alias("_node")).distinct()
    gone = stored(gone, "near-gone")
    rows = with_nodes(docs)
    left = rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "_node", "left_anti")
    # Only rows of one node can still be repeated, and only ids that stand for several rows have such nodes.
    if not rows.where(~F.col("_node").eqNullSafe(F.col("doc_id").cast("long"))).isEmpty():
        left = left.dropDuplicates(["_node"])
    return left.drop("_node")
