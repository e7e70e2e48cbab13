"""Hard negatives of anchors from integer vectors: rotated one-bit codes propose, exact integer scores decide.

Vectors are turned by an orthogonal rotation and kept as a code, the signs of the turned components. Let b be the unit
vector along the signs. A vector x is then a * b + r with the alignment a = <x, b>, which is stored next to the code, and a rest
r at right angles to b. The rest is coded in the same way under the next rotation, ``LAYERS`` times; the length of the last
rest r is stored. For an anchor q, with t = <q, b> of each code, the score is

    <x, q> = sum of a * t + <r, q>,    |<r, q>| <= |r| * sqrt(|q|^2 - t^2) with the last t

by Cauchy and Schwarz, since r has no part along the last b. Each t is estimated from popcounts of the code with the bit
planes of the turned and rounded anchor; the rounding error has a fixed bound that widens the interval. So every score has
an interval that surely holds it. A candidate is dropped only where its
interval shows that enough others are better, or that it lies outside the wanted scores; all others are scored in integers.

Vectors are cut into shards, each one row, and anchors into blocks. A task holds one shard at a time and the blocks
stream past it. The best of all shards are merged by a window per anchor over a few rows of each shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored

SHARD, BLOCK = 8192, 128  # vectors of a shard, anchors of a block
TASKS = 20_000  # beyond so many shards a task takes several, one after the other
LAYERS = 4  # codes of a vector, each of what the ones before have left
PLANES = 8  # bits of a rounded anchor component
SEED = 13
# Floating point errors are far below this share of |x| * |q|.
SLACK = 1e-9


@lru_cache(maxsize=4 * LAYERS)
def rotation(width: int, layer: int) -> np.ndarray:
    """An orthogonal matrix made from the seed."""
    drawn = np.random.default_rng(SEED + layer).standard_normal((width, width))
    return np.linalg.qr(drawn)[0] if width else drawn


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    rows, width = bits.shape
    full = np.zeros((rows, -(-max(width, 1) // 64) * 64), bool)
    full[:, :width] = bits
    return np.packbits(full, axis=1).view(np.uint64)


@dataclass
class Layer:
    """Codes of one rotation and the alignment of what the layers before have left."""

    bits: np.ndarray
    ones: np.ndarray
    align: np.ndarray


class Codes:
    """One-bit codes of integer vectors with what the intervals need."""

    def __init__(self, cells: np.ndarray):
        self.cells, self.layers = cells, []
        self.width = max(cells.shape[1], 1)
        rest = cells.astype(float)
        self.length = np.sqrt((rest * rest).sum(axis=1))
        for layer in range(LAYERS):
            turned = rest @ rotation(cells.shape[1], layer).T
            signs = np.where(turned >= 0, 1.0, -1.0)
            align = np.abs(turned).sum(axis=1) / np.sqrt(self.width)
            bits = words(turned >= 0)
            self.layers.append(Layer(bits, np.bitwise_count(bits).sum(axis=1).astype(float), align))
            rest = (turned - align[:, None] * signs / np.sqrt(self.width)) @ rotation(cells.shape[1], layer)
        self.rest = np.sqrt((rest * rest).sum(axis=1))

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of every (anchor, vector)."""
        size = np.sqrt((anchors.astype(float) ** 2).sum(axis=1, keepdims=True))
        centre, radius = 0.0, SLACK * self.length * size
        for number, layer in enumerate(self.layers):
            turned = anchors.astype(float) @ rotation(anchors.shape[1], number).T
            low = turned.min(axis=1, initial=0, keepdims=True)
            step = np.maximum(turned.max(axis=1, initial=0, keepdims=True) - low, 1e-300) / (2**PLANES - 1)
            rounded = np.rint((turned - low) / step).astype(np.uint64)
            counted = np.zeros((len(anchors), len(layer.bits)))
            for plane in range(PLANES):
                asked = words((rounded >> np.uint64(plane)) & np.uint64(1) == 1)
                for word in range(layer.bits.shape[1]):
                    counted += float(2**plane) * np.bitwise_count(asked[:, word, None] & layer.bits[None, :, word])
            # Sum of the components under the ones of the code, then twice that less the sum of all.
            under = low * layer.ones + step * counted
            along = (2 * under - turned.sum(axis=1, keepdims=True)) / np.sqrt(self.width)
            off = step * np.sqrt(self.width)
            centre, radius = centre + layer.align * along, radius + layer.align * off
        # ``along`` is now the part of the anchor along the last code, which the rest has no part of.
        least = np.maximum(np.abs(along) - off, 0)
        radius = radius + self.rest * np.sqrt(np.maximum(size * size - least * least, 0))
        return centre - radius, centre + radius

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return self.cells[rows] @ anchor


def unbeaten(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Which intervals may hold one of the ``k`` highest values."""
    if len(low) <= k:
        return np.ones(len(low), bool)
    return high >= np.partition(low, len(low) - k)[len(low) - k]


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _blocks(df: DataFrame, size: int, width: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """``size`` rows of (vec_id, label, vector) in one row: ids, labels and cells as bytes, ``extra`` long arrays as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            vector = table.column("vector").combine_chunks()
            widths = vector.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            cells = np.zeros((table.num_rows, width), np.int64)
            row = np.repeat(np.arange(table.num_rows), widths)
            cells[row, np.arange(len(row)) - np.repeat(np.cumsum(widths) - widths, widths)] = vector.flatten().to_numpy(zero_copy_only=False)
            packed = [table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "label")] + [cells.tobytes()]
            arrays = [pa.array([x], pa.binary()) for x in packed]
            arrays += [pa.array([table.column(c).to_pylist()], pa.list_(pa.list_(pa.int64()))) for c in extra]
            return pa.RecordBatch.from_arrays(arrays, ["ids", "labels", "cells", *extra])

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

    schema = ", ".join(["ids binary, labels binary, cells binary", *[f"{c} array<array<bigint>>" for c in extra]])
    return df.select("vec_id", "label", "vector", *extra).mapInArrow(run, schema)


def _streamed(shards: DataFrame, blocks: DataFrame, count: int, width: int, look: Callable, schema: str) -> DataFrame:
    """``look(codes, ids, labels, row)`` for every shard and block; a shard is read once and the blocks follow it."""
    extra = [c for c in blocks.columns if c not in shards.columns]
    empty = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in extra]
    held = shards.select("shard", F.lit(0).alias("turn"), "ids", "labels", "cells", *empty)
    sent = blocks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("shard"), F.lit(1).alias("turn"), "ids", "labels", "cells", *extra
    )
    order = held.unionByName(sent).repartitionById(min(count, TASKS), F.col("shard").cast("int")).sortWithinPartitions("shard", "turn")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = ids = labels = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                here = [np.frombuffer(row[c].as_buffer(), np.int64) for c in ("ids", "labels", "cells")]
                cells = here[2].reshape(len(here[0]), width)
                if row["turn"].as_py() == 0:
                    (ids, labels), codes = [x.copy() for x in here[:2]], Codes(cells.copy())
                    continue
                found = look(codes, ids, labels, (here[0], here[1], cells, {c: row[c].as_py() for c in extra}))
                if found:
                    columns = [np.concatenate(x) for x in zip(*found)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return order.mapInArrow(run, schema)


def mine(vectors: DataFrame, anchors: Column, k: int = 3, positives: int = 5, window: tuple[int, int] = (50, 95)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, vector of longs).

    ``anchors`` says which rows are anchors. An anchor's positives are its first ``positives`` other rows of its label, its
    negatives for a positive the first ``k`` rows of another label whose score lies between the two percentages
    ``window`` of the positive's score, ends included. Scores are integer inner products, higher ones come first, ties by
    smaller vec_id; ``rank`` counts the negatives of a positive from 1. Fewer rows give fewer results; an empty
    table or one without anchors none.

    Rows with a NULL id, label or vector, or a NULL component, take no part; so do further columns. A row with an
    anchor's own id is never its positive or negative. Anchor rows that are equal count once, other repeated rows each take
    a place; repeated positives have the same negatives. Shorter vectors count as filled up with zeros. Scores that could
    exceed 64 bits raise OverflowError.
    """
    real = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector", F.coalesce(anchors, F.lit(False)).alias("_anchor")
    ).where(real)
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    most = rows.agg(
        F.max(F.size("vector")), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))), F.count(F.lit(1))
    ).first()
    if not most[2]:
        return spark.createDataFrame([], result)
    if most[1] >= 2.0**62:
        raise OverflowError("inner products may exceed 64-bit integers")
    width = most[0]

    packed = stored(_blocks(rows, SHARD, width).withColumn("_at", F.monotonically_increasing_id()), "negatives-shards")
    # Shards are numbered from 0 on, so that a block of anchors can be sent to each of them by number.
    numbers = packed.select("_at", (F.row_number().over(Window.orderBy("_at")) - 1).cast("long").alias("shard"))
    numbers = stored(numbers, "negatives-numbers")
    shards, count = packed.join(numbers, "_at").drop("_at"), numbers.count()
    # One key per anchor: equal rows once, rows of one id with other labels or vectors apart.
    asked = rows.where("_anchor").select("vec_id", "label", "vector").dropDuplicates()
    asked = stored(asked.withColumn("key", F.array(F.monotonically_increasing_id())), "negatives-anchors")
    blocks = asked.count() // BLOCK + 1

    def nearest(codes, ids, labels, row):
        own, label, cells, more = row
        low, high = codes.intervals(cells)
        found = []
        for i in range(len(own)):
            near = np.flatnonzero((labels == label[i]) & (ids != own[i]))
            near = near[unbeaten(low[i, near], high[i, near], positives)]
            scores = codes.scores(near, cells[i])
            best = first(ids[near], scores, positives)
            found.append((np.full(len(best), more["key"][i][0]), ids[near][best], scores[best]))
        return found

    sent = _blocks(asked.repartition(blocks), BLOCK, width, ("key",))
    best = _streamed(shards, sent, count, width, nearest, "key long, positive_id long, positive_score long")
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    chosen = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    chosen = stored(chosen, "negatives-positives")

    # The distinct scores of an anchor's positives, each one window of wanted scores.
    wanted = chosen.groupBy("key").agg(F.sort_array(F.collect_set("positive_score")).alias("wanted"))
    least, largest = window
    seeking = asked.withColumn("key", F.col("key")[0]).join(wanted, "key").withColumn("key", F.array("key"))

    def hardest(codes, ids, labels, row):
        own, label, cells, more = row
        low, high = codes.intervals(cells)
        found = []
        for i in range(len(own)):
            other = (labels != label[i]) & (ids != own[i])
            for score in more["wanted"][i]:
                bottom, top = -(-least * score // 100), largest * score // 100
                if bottom > top:
                    continue
                near = np.flatnonzero(other & (high[i] >= bottom) & (low[i] <= top))
                # Surely inside the window: only these can beat a candidate before it is scored.
                inside = near[(low[i, near] >= bottom) & (high[i, near] <= top)]
                if len(inside) > k:
                    near = near[high[i, near] >= np.partition(low[i, inside], len(inside) - k)[len(inside) - k]]
                scores = codes.scores(near, cells[i])
                fits = (scores >= bottom) & (scores <= top)
                near, scores = near[fits], scores[fits]
                here = first(ids[near], scores, k)
                made = np.ones(len(here), np.int64)
                found.append((made * more["key"][i][0], made * score, ids[near][here], scores[here]))
        return found

    sent = _blocks(seeking.repartition(blocks), BLOCK, width, ("key", "wanted"))
    hard = _streamed(shards, sent, count, width, hardest, "key long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = asked.select(F.col("key")[0].alias("key"), F.col("vec_id").alias("anchor_id"))
    out = chosen.join(ranked, ["key", "positive_score"]).join(named, "key")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
