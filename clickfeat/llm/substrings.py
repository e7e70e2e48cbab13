"""Removal of long repeated word spans, by compaction of the graph of word windows.

The edges of the graph are windows of ``window`` consecutive words. A window's anchor is the leftmost of its seeds of
``seed`` words with the smallest hash, so equal windows have equal anchors, and the windows that share one anchor place are
a path that is kept as one row: a run. Four joins and aggregations follow, none of which gathers a group:

1. Anchors that occur once cannot hold a repeated window; runs of the others are kept (join with the repeated anchors).
2. Equal runs are compacted to one path with its first place. A path whose anchor has no other path does not branch: all
   its places but the first are repeats.
3. Paths whose anchors branch are opened into their windows at the first place of the path; a window there is a repeat if
   it is found earlier.
4. Repeats that touch are compacted into spans of their document.

Paths and windows are told apart by 128-bit digests of all their words, next to the anchor: a repeat counts only against a
source place whose words have the same digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import BROADCAST_ROWS, semi_join, stored
from clickfeat.llm.words import Words, inside, mix, window_hashes, words_of

WINDOW, SEED = 20, 8
_BASES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_SALT = np.uint64(0x27D4EB2F165667C5)
KEY = ["doc", "sub"]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, sub, doc_id, text): ``doc`` orders documents (NULL ids first), ``sub`` tells rows of one id apart by their
    text and is 0 for an id of one row. Repeated rows are one document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    doc = F.coalesce("doc_id", F.lit(-(2**63)))
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = stored(again.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_again")), "span-ids")
    if again.isEmpty():
        return docs.select(doc.alias("doc"), F.lit(0).cast("long").alias("sub"), "doc_id", "text")
    joined = docs.join(again, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    sub = F.when(F.col("_again"), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("long"))
    return joined.select(doc.alias("doc"), sub.alias("sub"), "doc_id", "text")


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def runs(words: Words, window: int, seed: int, paths: bool) -> tuple[np.ndarray, ...]:
    """(row, start, count, anchor, path, check) of each run of a group: ``count`` windows from word ``start`` of the row on.
    ``path`` and ``check`` are hashes of all its words, or None unless asked for."""
    total = len(words.hashes) - window + 1
    if total <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, *[np.zeros(0, np.uint64)] * 3
    seeds = window_hashes(words.hashes, seed)
    width = window - seed + 1
    at = np.lib.stride_tricks.sliding_window_view(seeds, width)[:total].argmin(axis=1) + np.arange(total)
    places = np.flatnonzero(inside(words.bounds, window, total))
    row = np.repeat(np.arange(words.rows), words.counts())[places]
    at = at[places]
    new = np.ones(len(places), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(places)))
    begin, row = places[first], row[first]
    digests = [None, None]
    if paths:
        n, last = len(words.hashes), begin + count + window - 1
        for i, base in enumerate(_BASES):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * _powers(n, base), dtype=np.uint64)])
            digests[i] = mix((sums[last] - sums[begin]) * _powers(n, pow(base, -1, 1 << 64))[begin])
    return row, begin - words.bounds[row], count, seeds[at[first]], *digests


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def anchors(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """Anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                found, times = np.unique(runs(words, window, seed, False)[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(found), pa.array(times)], ["anchor", "n"])

    counts = docs.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return counts.where("n > 1").select("anchor")


def run_rows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """All runs: (anchor, path, check, doc, sub, start, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, sub = batch.column("doc").to_numpy(), batch.column("sub").to_numpy()
            for words in words_of(batch.column("text")):
                row, start, count, anchor, path, check = runs(words, window, seed, True)
                yield pa.RecordBatch.from_arrays(
                    [_signed(anchor), _signed(path), _signed(check), pa.array(doc[words.first + row]), pa.array(sub[words.first + row]),
                     pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                    ["anchor", "path", "check", *KEY, "start", "count"],
                )

    schema = "anchor long, path long, check long, doc long, sub long, start int, count int"
    return docs.select(*KEY, "text").mapInArrow(run, schema)


def with_places(docs: DataFrame, places: DataFrame, kind: str = "inner") -> DataFrame:
    """``docs`` plus ``places``, the sorted (start, count) pairs of each document. The lists are sent to every task when
    they are counted and few; a document has at most as many as it has words."""
    rows = places.count()
    lists = places.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "count"))).alias("places"))
    return docs.join(F.broadcast(lists) if rows <= BROADCAST_ROWS else lists, KEY, kind)


def _place_arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, counts) of each row of a batch."""
    column = batch.column("places")
    flat = column.flatten()
    start, count = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("start", "count"))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for a, b in zip(ends - lengths, ends):
        yield start[a:b], count[a:b]


def opened(docs: DataFrame, paths: DataFrame, window: int) -> DataFrame:
    """(window, check, doc, sub, start) of every window of ``paths`` (doc, sub, start, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, sub = batch.column("doc").to_numpy(), batch.column("sub").to_numpy()
            places = list(_place_arrays(batch))
            for words in words_of(batch.column("text")):
                found = window_hashes(words.hashes, window)
                check = window_hashes(mix(words.hashes ^ _SALT), window)
                row = np.repeat(np.arange(words.rows), [len(places[words.first + i][0]) for i in range(words.rows)])
                mine = places[words.first : words.first + words.rows]
                start, count = (np.concatenate([p[k] for p in mine]).astype(np.int64) for k in (0, 1))
                row = np.repeat(row, count)
                at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                here = words.bounds[row] + at
                yield pa.RecordBatch.from_arrays(
                    [_signed(found[here]), _signed(check[here]), pa.array(doc[words.first + row]),
                     pa.array(sub[words.first + row]), pa.array(at.astype(np.int32))],
                    ["window", "check", *KEY, "start"],
                )

    with_lists = with_places(docs, paths).select(*KEY, "text", "places")
    return with_lists.mapInArrow(run, "window long, check long, doc long, sub long, start int")


def spans(repeats: DataFrame) -> DataFrame:
    """Repeats (doc, sub, start, count) that touch or overlap in their document, as one row each."""
    order = Window.partitionBy(*KEY).orderBy("start")
    reach = F.max(F.col("start") + F.col("count")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = repeats.withColumn("_new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    marked = marked.withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.max(F.col("start") + F.col("count"))
    return marked.groupBy(*KEY, "_span").agg(
        F.min("start").alias("start"), (last - F.min("start")).cast("int").alias("count")
    ).drop("_span")


def _joined(words: Words) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each begins."""
    size = words.ends - words.starts + 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = np.full(offsets[-1], 32, np.uint8)
    at = np.arange(offsets[-1] - len(size))  # places of the words' bytes without the spaces
    number = np.repeat(np.arange(len(size)), size - 1)
    out[at + number] = words.data[at - (offsets[:-1] - np.arange(len(size)))[number] + words.starts[number]]
    return out.tobytes(), offsets


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc, sub, start, count): spans of ``count`` windows from word ``start`` on, each of which also starts earlier, for
    ``docs`` made by ``keyed``."""
    repeated = stored(anchors(docs, window, seed), "span-anchors")
    kept = stored(semi_join(run_rows(docs, window, seed), repeated, "anchor"), "span-runs")
    place, path = F.struct(*KEY, "start"), ["anchor", "path", "check"]
    paths = kept.groupBy(*path).agg(F.min(place).alias("source"), F.max("count").alias("count"))
    paths = stored(paths, "span-paths")
    later = kept.join(paths.select(*path, "source"), path).where(place != F.col("source")).select(*KEY, "start", "count")
    forks = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor")
    forked = paths.join(forks, "anchor", "left_semi").select("source.*", "count")
    windows = stored(opened(docs, stored(forked, "span-forks"), window), "span-windows")
    first = windows.groupBy("window", "check").agg(F.min(place).alias("source"))
    again = windows.join(first, ["window", "check"]).where(place != F.col("source"))
    return spans(later.unionByName(again.select(*KEY, "start", F.lit(1).alias("count"))))


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row of ``docs`` (doc_id, text) without the words that a repeated window
    covers, the kept words joined by one space.

    A window is ``window`` consecutive words of one document; it is repeated if the same words also start earlier: in a
    document of smaller id (NULL ids come first), or earlier in the same one. Windows are judged on the input. NULL text has
    no words. Repeated rows are one document and get equal results; rows of one id with different texts are ordered by a
    hash of the text. Texts shorter than a window are kept. Other columns are not read; an empty table gives no rows.
    """
    rows = keyed(docs)
    found = stored(repeated_spans(rows, window, seed), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places = batch.column("doc_id"), list(_place_arrays(batch))
            for words in words_of(batch.column("text")):
                edge = np.zeros(len(words.hashes) + 1, np.int64)
                for i in range(words.rows):
                    start, count = places[words.first + i]
                    np.add.at(edge, words.bounds[i] + start, 1)
                    np.add.at(edge, words.bounds[i] + start + count + window - 1, -1)
                removed = np.cumsum(edge[:-1]) > 0
                text, offsets = _joined(words)
                size = np.diff(offsets)
                keep = np.frombuffer(text, np.uint8)[np.repeat(~removed, size)].tobytes()
                ends = np.concatenate([[0], np.cumsum(np.where(removed, 0, size))])[words.bounds]
                gone = np.concatenate([[0], np.cumsum(removed)])[words.bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[words.first : words.first + words.rows],
                        pa.array(words.counts()),
                        pa.array(np.diff(gone)),
                        pa.array([keep[a : max(a, b - 1)].decode() for a, b in zip(ends[:-1], ends[1:])], pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    full = with_places(rows, found, "left").select("doc_id", "text", "places")
    return full.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
