"""Small helpers of the operators in this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.session import ensure_checkpoint_dir

# One word: a run of characters other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# Sides below this many rows of a few numbers may be broadcast (about 100 MB); larger ones are joined by shuffling.
BROADCAST_ROWS = 2_000_000
# A group with more than this part of all rows, and more than ``HOT_GROUP_ROWS`` rows, is split: at most ``HOT_PARTS`` groups.
HOT_PARTS = 20_000
HOT_GROUP_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that every executor reaches."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def semi_join(left: DataFrame, keys: DataFrame, on: str, rows: int | None = None) -> DataFrame:
    """Rows of ``left`` whose ``on`` is in ``keys``; the keys are broadcast only when they are counted and few."""
    count = keys.count() if rows is None else rows
    side = F.broadcast(keys) if count <= BROADCAST_ROWS else keys
    return left.join(side, on, "left_semi")


def n_words(text: Column) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` other than ``names``, compared without case as Spark resolves them."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def join_groups(rows: DataFrame, groups: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``groups`` (``key`` unique, ``_n`` the rows of the group, ...), which should be written.

    Hot groups are split by ``spread``, a hash of the row, into as many parts as they are times too large, and their line
    of ``groups`` is repeated for each part. There are never more than ``HOT_PARTS`` of them, so the list is broadcast.
    """
    total = groups.agg(F.sum("_n")).first()[0] or 0
    limit = max(HOT_GROUP_ROWS, total // HOT_PARTS)
    parts = F.ceil(F.col("_n") / limit).cast("long")
    hot = groups.where(F.col("_n") > limit).select(F.col(key).alias("_hot"), parts.alias("_parts"))
    split = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").drop("_hot")
    split = split.withColumn("_part", F.pmod(spread, F.coalesce("_parts", F.lit(1).cast("long")))).drop("_parts")
    lines = groups.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_n")
    return split.join(lines, [key, "_part"], how).drop("_part")
