"""Benchmark decontamination by greedy string tiling.

Every document is tiled with every test item it shares a seed of ``min_match`` words with: the longest match of words
that no tile covers yet is marked, again and again, until none of ``min_match`` words is left. Tiles may lie in any order,
so moved passages count. A document leaks an item when tiles cover at least ``coverage`` of the item's words.

The items are the query set: they go to the tasks in blocks of bounded size, one pass over the documents per block, and
each document is tiled where it lies; nothing is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import stored
from clickfeat.llm.near_duplicates import with_nodes
from clickfeat.llm.words import inside, window_hashes, words_of

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
PAIRS = 1 << 18
SCHEMA = "doc_id long, item_id long, tiles int, covered_words int, item_words int, coverage double"


@dataclass
class Items:
    """A block of test items: their word hashes, and where each seed (a rolling hash of ``k`` words) occurs in them."""

    k: int
    ids: list[int | None]
    words: list[np.ndarray]
    seeds: np.ndarray  # sorted, with the item and place of each below
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray  # a bitmap of the low 20 bits of all seeds
    hashes: np.ndarray  # the words of all items, one item after the other
    bounds: np.ndarray  # where each item begins, and the end

    @classmethod
    def of(cls, ids: list[int | None], texts: pa.Array, k: int) -> Items:
        words, seeds, item, place = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for group in words_of(pc.utf8_lower(texts)):
            for i in range(group.rows):
                own = group.hashes[group.bounds[i] : group.bounds[i + 1]]
                found = window_hashes(own, k)
                seeds.append(found)
                item.append(np.full(len(found), len(words)))
                place.append(np.arange(len(found)))
                words.append(own)
        seeds, item, place = map(np.concatenate, (seeds, item, place))
        order = np.argsort(seeds, kind="stable")
        present = np.zeros(1 << 20, bool)
        present[(seeds & np.uint64(0xFFFFF)).astype(np.int64)] = True
        hashes = np.concatenate([np.zeros(0, np.uint64), *words])
        bounds = np.cumsum([0, *map(len, words)])
        return cls(k, ids, words, seeds[order], item[order], place[order], present, hashes, bounds)


def tile(hits: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document place, item place, words) from the places where seeds of ``k`` words agree; seeds that follow
    each other on one diagonal make a match."""
    found = set(hits)
    begins = sorted((p - q, p) for p, q in found if (p - 1, q - 1) not in found)
    ends = sorted((p - q, p) for p, q in found if (p + 1, q + 1) not in found)
    return tile_matches([(p, p - d, last - p + k) for (d, p), (_, last) in zip(begins, ends)], k)


def tile_matches(matches: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles from maximal matches (document place, item place, words).

    Matches are taken longest first, ties by place; what earlier tiles cover is cut off, and the rest goes back while it
    still has ``k`` words. The marks of the document are kept for the places that matches reach.
    """
    if not matches:
        return []
    heap = [(-size, p, q) for p, q, size in matches]
    heapq.heapify(heap)
    first = min(p for p, _, _ in matches)
    open_doc = np.ones(max(p + n for p, _, n in matches) - first, bool)
    open_item = np.ones(max(q + n for _, q, n in matches), bool)
    left, tiles = len(open_item), []
    while heap and left >= k:
        size, p, q = heapq.heappop(heap)
        free = open_doc[p - first : p - first - size] & open_item[q : q - size]
        if free.all():
            open_doc[p - first : p - first - size] = False
            open_item[q : q - size] = False
            left += size
            tiles.append((p, q, -size))
            continue
        steps = np.flatnonzero(np.diff(free, prepend=False, append=False))
        for begin, end in zip(steps[::2].tolist(), steps[1::2].tolist()):
            if end - begin >= k:
                heapq.heappush(heap, (begin - end, p + begin, q + begin))
    return tiles


def _matches(items: Items, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, item, place in the row, place in the item, words) of all maximal matches of at least ``k`` words of the rows of
    one group, ordered by row and item.

    Pairs of places with one seed are made ``PAIRS`` at a time and their words compared; only pairs at which a match begins or
    ends are kept, so memory follows the matches and not the pairs of places inside them.
    """
    k = items.k
    seeds = window_hashes(hashes, k)
    maybe = np.flatnonzero(items.present[(seeds & np.uint64(0xFFFFF)).astype(np.int64)] & inside(bounds, k, len(seeds)))
    low = np.searchsorted(items.seeds, seeds[maybe], "left")
    high = np.searchsorted(items.seeds, seeds[maybe], "right")
    shared = high > low
    maybe, low, times = maybe[shared], low[shared], (high - low)[shared]
    row_of = np.searchsorted(bounds, maybe, "right") - 1
    upto = np.cumsum(times)
    begins, ends = [np.zeros((2, 0), np.int64)], [np.zeros((2, 0), np.int64)]
    i = 0
    while i < len(maybe):
        done = upto[i] - times[i]
        j = max(i + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        n = times[i:j]
        p = np.repeat(maybe[i:j], n)
        row = np.repeat(row_of[i:j], n)
        entry = np.repeat(low[i:j] - (upto[i:j] - n - done), n) + np.arange(n.sum())
        item = items.item[entry]
        q = items.bounds[item] + items.place[entry]
        same = np.ones(len(p), bool)
        for step in range(k):
            same &= hashes[p + step] == items.hashes[q + step]
        p, q, row, item = p[same], q[same], row[same], item[same]
        head = (p > bounds[row]) & (q > items.bounds[item])
        head[head] = hashes[p[head] - 1] == items.hashes[q[head] - 1]
        tail = (p + k < bounds[row + 1]) & (q + k < items.bounds[item + 1])
        tail[tail] = hashes[p[tail] + k] == items.hashes[q[tail] + k]
        begins.append(np.stack([p[~head], q[~head]]))
        ends.append(np.stack([p[~tail], q[~tail]]))
        i = j
    # On one diagonal matches do not overlap, so their begins and ends alternate.
    p, q = np.concatenate(begins, axis=1)
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    last, other = np.concatenate(ends, axis=1)
    size = last[np.lexsort((last, last - other))] - p + k
    row = np.searchsorted(bounds, p, "right") - 1
    item = np.searchsorted(items.bounds, q, "right") - 1
    order = np.lexsort((p, item, row))
    found = row, item, p - bounds[row], q - items.bounds[item], size
    return tuple(column[order] for column in found)


def _tiled(items: Items, hashes: np.ndarray, bounds: np.ndarray, coverage: float) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, tiles, covered words) for the rows of one group and the items they leak."""
    row, item, at, place, size = _matches(items, hashes, bounds)
    cut = np.flatnonzero((row[1:] != row[:-1]) | (item[1:] != item[:-1])) + 1
    for i, j in zip([0, *cut], [*cut, len(row)] if len(row) else []):
        of = int(item[i])
        need = coverage * len(items.words[of])
        if size[i:j].sum() < need:  # the matches cannot cover enough
            continue
        tiles = tile_matches(list(zip(at[i:j].tolist(), place[i:j].tolist(), size[i:j].tolist())), items.k)
        covered = sum(n for _, _, n in tiles)
        if covered >= need:
            yield int(row[i]), of, len(tiles), covered


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, min_match: int = MIN_MATCH) -> DataFrame:
    """(doc_id, item_id, tiles, covered_words, item_words, coverage): one row per document row and item it leaks.

    ``docs`` has (doc_id, text), ``items`` (item_id, text); other columns are not read. Words are compared without
    case. Texts of fewer than ``min_match`` words, NULL included, match nothing: such short items are common phrases, which
    clean documents hold as well; a smaller ``min_match`` finds them. Repeated rows give repeated
    results, NULL ids stay NULL. Empty tables give no rows.
    """
    spark = docs.sparkSession
    numbered = stored(items.select(F.col("item_id").cast("long"), "text"), "bench-items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for block in range(blocks):
        rows = numbered.where(spread == block).toArrow()
        given = spark.sparkContext.broadcast(
            Items.of(rows.column("item_id").to_pylist(), rows.column("text").combine_chunks(), min_match)
        )

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            known = given.value
            for batch in batches:
                ids, out = batch.column("doc_id"), []
                for group in words_of(pc.utf8_lower(batch.column("text"))):
                    for row, item, tiles, covered in _tiled(known, group.hashes, group.bounds, coverage):
                        need = len(known.words[item])
                        out.append((ids[group.first + row].as_py(), known.ids[item], tiles, covered, need, covered / need))
                columns = list(zip(*out)) or [[]] * 6
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                names = ["doc_id", "item_id", "tiles", "covered_words", "item_words", "coverage"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, min_match: int = MIN_MATCH) -> DataFrame:
    """``docs`` without the rows that leak an item. Rows are judged one by one (see ``with_nodes``), also where their id is
    NULL or repeated; only rows of equal id and text are judged together."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*docs.columns).alias("_row"))
    rows = with_nodes(rows)
    bad = leaks(rows.select(F.col("_node").alias("doc_id"), "text"), items, coverage, min_match)
    bad = stored(bad.select(F.col("doc_id").alias("_bad")).distinct(), "bench-leaks")
    return rows.join(bad, F.col("_node") == F.col("_bad"), "left_anti").select("_row.*")
