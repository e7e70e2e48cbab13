"""Reading click logs, and the click-log view of other event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.functions.timeparts import add_day_buckets, add_time_parts, epoch_micros
from clickfeat.naming import MICROS, ROW_ID, TIME

_KEYS = [
    T.StructField("ip", T.LongType()),
    T.StructField("app", T.IntegerType()),
    T.StructField("device", T.IntegerType()),
    T.StructField("os", T.IntegerType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("click_time", T.TimestampNTZType()),
]
TRAIN_SCHEMA = T.StructType(
    [*_KEYS, T.StructField("attributed_time", T.TimestampNTZType()), T.StructField("is_attributed", T.IntegerType())]
)
TEST_SCHEMA = T.StructType([T.StructField("click_id", T.LongType()), *_KEYS])
IMPRESSION_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("instance_id", "user_id", "item_id", "shop_id", "context_page_id", "context_timestamp")]
    + [T.StructField(n, T.IntegerType()) for n in ("shop_review_num_level", "shop_star_level", "item_sales_level")]
    + [
        T.StructField(n, T.DoubleType())
        for n in ("shop_review_positive_rate", "shop_score_service", "shop_score_delivery", "shop_score_description")
    ]
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Typed CSV scan of the chosen columns; ``limit`` is for trials on part of a file.

    A value that does not fit its type is NULL; ``positions.load_csv`` tells such lines apart and gives row ids.
    """
    return _chosen(csv_reader(spark, schema).csv(path), columns, limit)


def csv_reader(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    """Reader of CSV files with a header and the time format of the logs."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    return _chosen(spark.read.parquet(path), columns, limit)


def _chosen(df, columns, limit):
    df = df.select(*columns) if columns else df
    return df.limit(limit) if limit is not None else df


def prepare(df: DataFrame, timestamp: str = "click_time") -> DataFrame:
    """Add event time in microseconds, date, time parts and buckets."""
    timed = df.withColumns({TIME: epoch_micros(timestamp), "date": F.col(timestamp).cast("date")})
    return add_day_buckets(add_time_parts(timed, timestamp))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as a labelled click log."""
    e = _table(spark, sf_dir, "events")
    converted = F.col("value") >= 50
    clicks = e.select(
        F.col("event_id").alias(ROW_ID),
        F.col("user_id").alias("ip"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("app"),
        F.col("event_type").alias("channel"),
        (F.col("event_id") % 3).cast("int").alias("device"),
        (F.col("event_id") % 5).cast("int").alias("os"),
        F.col("ts").alias("click_time"),
        F.when(converted, 1).otherwise(0).alias("is_attributed"),
        F.when(converted, F.round(F.col("value") * MICROS).cast("long")).alias("_delay"),
    )
    return prepare(clicks).withColumn("attributed_t", F.col(TIME) + F.col("_delay")).drop("_delay")


def orders_as_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a log with many equal times (day grain)."""
    o = _table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias(ROW_ID),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
        epoch_micros("o_orderdate").alias(TIME),
    )


def orders_as_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the columns of the second schema, with levels and scores taken from their numbers."""
    o = _table(spark, sf_dir, "orders")
    key, user, cents = F.col("o_orderkey"), F.col("o_custkey"), F.floor("o_totalprice").cast("long")
    values = {
        "instance_id": key, "user_id": user, "item_id": key % 97, "shop_id": user % 31, "context_page_id": key % 13,
        "context_timestamp": F.floor(epoch_micros("o_orderdate") / MICROS), "shop_review_num_level": user % 5,
        "shop_star_level": key % 7, "item_sales_level": key % 11, "shop_review_positive_rate": cents % 101 / 100,
        "shop_score_service": cents % 53 / 50, "shop_score_delivery": cents % 29 / 25, "shop_score_description": cents % 17 / 20,
    }
    return o.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in IMPRESSION_SCHEMA])


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _table(spark, sf_dir, name)
