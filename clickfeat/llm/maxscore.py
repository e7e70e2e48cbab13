"""Exact top-k search by inner product over integer vectors, with MaxScore.

Components are the terms. Candidates are cut into shards; a shard keeps, for each term, its postings (the vectors where the
component is not zero) and the bounds of the component. For a query, terms are sorted by the largest score they can
give in the shard. The last ones, whose bounds together stay below the k-th best score so far, are non-essential:
vectors found in none of the other, essential postings need no look. Essential postings are added up, and the
non-essential terms are probed one by one for the vectors that could still reach the k-th best score. The results
of all shards are merged.

The queries are a stated set; they meet every shard in blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored

SCALE = 1024
SHARD, BLOCK = 8192, 256  # vectors of a shard, queries of a block
FIRST = 512  # vectors of a shard that are scored in full for a first bound


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a long; NULL if the vector or a component is NULL or not finite."""
    value = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(value(x) * scale).cast("long")))


def _packed(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """(block, ids, widths, cells): ``size`` rows of (vec_id, vector) in one row, of one task each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            vector = table.column("vector").combine_chunks()
            cells = vector.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            widths = vector.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = table.column("vec_id").to_numpy().astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (ids, widths, cells)], ["ids", "widths", "cells"]
            )

        waiting, count = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - count)
                waiting.append(part)
                count += part.num_rows
                batch = batch.slice(part.num_rows)
                if count == size:
                    yield block(waiting)
                    waiting, count = [], 0
        if count:
            yield block(waiting)

    packed = vectors.select("vec_id", "vector").mapInArrow(run, "ids binary, widths binary, cells binary")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), name)


def _matrix(ids: bytes, widths: bytes, cells: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block; shorter vectors are filled up with zeros."""
    ids, widths, cells = (np.frombuffer(x, np.int64) for x in (ids, widths, cells))
    width = int(widths.max(initial=0))
    out = np.zeros((len(ids), width), np.int64)
    row = np.repeat(np.arange(len(ids)), widths)
    out[row, np.arange(len(cells)) - np.repeat(np.cumsum(widths) - widths, widths)] = cells
    return ids, out


class Shard:
    """Postings and bounds of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, np.asfortranarray(vectors)
        self.high, self.low = vectors.max(axis=0, initial=0), vectors.min(axis=0, initial=0)
        self.postings = []
        for term in range(vectors.shape[1]):
            rows = np.flatnonzero(vectors[:, term])
            everywhere = len(rows) == len(ids)
            self.postings.append((slice(None) if everywhere else rows, self.vectors[rows, term]))

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best vectors other than ``own``; ties to the smaller id."""
        width = min(len(query), self.vectors.shape[1])
        query = query[:width]
        largest = np.abs(query).astype(float) @ np.maximum(self.high, -self.low)[:width].astype(float)
        if largest >= 2**62:
            raise OverflowError("inner products exceed 64-bit integers")
        bound = np.maximum(query * self.high[:width], query * self.low[:width])
        terms = np.argsort(-bound, kind="stable")
        terms = terms[query[terms] != 0]
        rest = np.concatenate([np.cumsum(bound[terms][::-1])[::-1], [0]])  # the most that terms[i:] can give
        others = np.flatnonzero(self.ids != own)
        head = others[:FIRST]
        scores = self.vectors[head, :width] @ query
        if len(head) < k:
            alive, worst = head, None
        else:
            worst = np.partition(scores, len(scores) - k)[len(scores) - k]
            split = int(np.argmax(rest < worst)) if (rest < worst).any() else len(terms)
            total = np.zeros(len(self.ids), np.int64)
            seen = np.full(len(self.ids), split == len(terms))
            for term in terms[:split]:
                rows, values = self.postings[term]
                total[rows] += query[term] * values
                seen[rows] = True
            seen &= self.ids != own
            seen[head] = False
            alive = np.flatnonzero(seen)
            alive = alive[total[alive] + rest[split] >= worst]
            for place in range(split, len(terms)):
                if not len(alive):
                    break
                total[alive] += query[terms[place]] * self.vectors[alive, terms[place]]
                alive = alive[total[alive] + rest[place + 1] >= worst]
            scores = np.concatenate([scores, total[alive]])
            alive = np.concatenate([head, alive])
        order = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive][order], scores[order]


def search(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each of ``queries``, both (vec_id, vector)
    with vectors of longs; a rank counts from 1.

    Rows whose vec_id is the query's own are not its candidates. Rows with a NULL id or vector take no part. Vectors of
    different lengths are compared on the shorter one. Equal query rows count once; repeated candidates each take a
    rank. Fewer than ``k`` candidates give fewer rows, none no rows. Products beyond 64 bits raise OverflowError.
    """
    real = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    shards = _packed(vectors.where(real), SHARD, "search-shards")
    asked = queries.where(real).select("vec_id", "vector").dropDuplicates()
    asked = _packed(asked.repartition(asked.count() // BLOCK + 1), BLOCK, "search-queries")
    # Shards are numbered from 0 on, so that a block of queries can be sent to each of them by number.
    numbers = shards.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("shard"))
    numbers = stored(numbers, "search-numbers")
    count = numbers.count()
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sent = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("shard"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "widths", "cells")],
    )
    pairs = sent.join(shards.join(numbers, "block").drop("block"), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = None
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if held is None or held[0] != row["shard"]:
                    held = row["shard"], Shard(*_matrix(row["ids"], row["widths"], row["cells"]))
                own, asking = _matrix(row["q_ids"], row["q_widths"], row["q_cells"])
                found = [held[1].top(q, vector, k) for q, vector in zip(own, asking)]
                sizes = [len(ids) for ids, _ in found]
                # Queries of one id with different vectors are told apart by the hash of the vector.
                which = [zlib.crc32(vector.tobytes()) for vector in asking]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, sizes)), pa.array(np.repeat(np.array(which, np.int64), sizes)),
                        pa.array(np.concatenate([ids for ids, _ in found])), pa.array(np.concatenate([x for _, x in found])),
                    ],
                    ["query_id", "which", "vec_id", "score"],
                )

    best = pairs.select("shard", "ids", "widths", "cells", "q_ids", "q_widths", "q_cells").mapInArrow(
        run, "query_id long, which long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
