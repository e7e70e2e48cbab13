"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets of about ``bucket_bytes`` by a seeded hash of the id; pass two shuffles
each bucket in memory (Spark's ``shuffle`` of an array is a Fisher-Yates shuffle) and writes it. The written buckets, one
after the other, are a random order of all rows, and the shards are equal cuts of that order, so their row counts differ
by at most one. Only built-in functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored, without

BUCKET_BYTES = 16 << 20
HOT_ROWS = 1000
HOT_PART = 16  # an id whose rows hold more than this part of a bucket is spread too
SEED = 81


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def external_shuffle(docs: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` (doc_id, text, ...) plus ``shard`` (int, from 0) and ``slot`` (long, from 0 in each shard).

    Law ``rows``: shard sizes differ by at most one row. The order depends on the rows and the seed only, but for hot ids:
    an id with more than ``HOT_ROWS`` rows (NULL included), or with several rows that hold more than a ``HOT_PART``-th of a
    bucket, is spread over the buckets by the row's text and place in the input, since one bucket could not hold it; where
    its rows go depends on how the input is partitioned, too. NULL text counts as empty. An empty table gives no rows. Columns already named ``shard``
    or ``slot`` are replaced. Columns must be sortable (no maps).
    """
    keep = without(docs, ["shard", "slot"])
    total = docs.agg(F.sum(text_size(docs["text"]))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    per_id = docs.groupBy(docs["doc_id"].alias("_hot"))
    hot = per_id.agg(F.count(F.lit(1)).alias("_n"), F.sum(text_size(docs["text"])).alias("_bytes"))
    large = (F.col("_n") > 1) & (F.col("_bytes") * HOT_PART > bucket_bytes)
    hot = hot.where((F.col("_n") > HOT_ROWS) | large)
    hot = stored(hot.select("_hot", F.lit(True).alias("_is_hot")), "shard-hot")
    rows = docs.select(F.struct(*keep).alias("_row"), docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    seeded = F.xxhash64(F.lit(seed), "_id")
    if not hot.isEmpty():
        rows = rows.withColumn("_at", F.monotonically_increasing_id())
        rows = rows.join(hot, F.col("_id").eqNullSafe(F.col("_hot")), "left")
        seeded = F.when(F.col("_is_hot"), F.xxhash64(F.lit(seed), "_id", "_text", "_at")).otherwise(seeded)
    scattered = rows.select(
        F.pmod(seeded, F.lit(buckets)).cast("int").alias("_bucket"),
        F.struct(F.xxhash64(F.lit(seed + 1), "_id").alias("h"), F.col("_row").alias("row")).alias("_item"),
    ).repartitionById(buckets, F.col("_bucket"))
    order = F.shuffle(F.sort_array(F.collect_list("_item")), F.lit(seed))
    shuffled = scattered.groupBy("_bucket").agg(order.alias("_items"))
    written = stored(
        shuffled.select("_bucket", F.posexplode("_items").alias("_pos", "_item")).select("_bucket", "_pos", "_item.row"),
        "shard-buckets",
    )
    counts = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.select(
            F.col("_bucket").alias("_of"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(Window.partitionBy()).alias("_total"),
        ),
        "shard-offsets",
    )
    # A row's place p in the whole order gives shard p * shards div total, which starts at ceil(shard * total / shards).
    return (
        written.join(offsets, F.col("_bucket") == F.col("_of"))
        .withColumn("shard", F.expr(f"cast((_offset + _pos) * {shards} div _total as int)"))
        .withColumn("slot", F.expr(f"_offset + _pos - (cast(shard as bigint) * _total + {shards - 1}) div {shards}"))
        .select("row.*", "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order: ``shard=<n>`` holds files sorted by slot ranges."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
