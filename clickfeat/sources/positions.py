"""Row ids from the place of a line in its files, and the lines that do not fit the schema.

A scan reads each file in splits, a split from its first line to its last in one task. So the rows of a split are numbered
by a counter of the task, and a small table with the number of rows of every split gives, as a sum over the splits before, where
its numbers begin. The log is read once for the counts (no columns) and once for the rows; it is neither sorted nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.naming import ROW_ID
from clickfeat.sources.clicklog import csv_reader
from clickfeat.sources.store import FeatureStore, write_parquet

REJECTED = "_rejected"
# The table of splits is sent to every task up to this many rows (some 50 MB), and joined by shuffling beyond.
SPLITS_CONF = "spark.clickfeat.broadcastSplits"
DEFAULT_SPLITS = 200_000


def _most_splits(scan: DataFrame) -> int:
    """At most how many splits the files of ``scan`` are read in."""
    conf, context = scan.sparkSession.conf, scan.sparkSession.sparkContext
    number = lambda key: context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(key))
    files = len(scan.inputFiles())
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    open_cost = number("spark.sql.files.openCostInBytes")
    per_core = (size + files * open_cost) // max(1, context.defaultParallelism)
    return files + size // max(1, min(number("spark.sql.files.maxPartitionBytes"), max(open_cost, per_core)))


def with_file_positions(scan: DataFrame, name: str = ROW_ID) -> DataFrame:
    """A direct scan of files with the 0-based place of each row: files by path, rows as they stand in their file.

    The place does not depend on how the files are split, so reading them again gives the same. Empty lines, which a CSV scan
    skips, have no place. Filters and limits belong after this step.
    """
    limit = int(scan.sparkSession.conf.get(SPLITS_CONF, str(DEFAULT_SPLITS)))
    few = _most_splits(scan) <= limit
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    counter = F.monotonically_increasing_id().alias("_nth")
    counted = scan.select(*split, counter).groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_rows"), F.min("_nth").alias("_first"))
    earlier = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    # What to add to the task's counter: rows before the split less the counter's value at its first row.
    shift = (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    offsets = counted.select("_file", "_start", shift)
    rows = scan.select("*", *split, counter).join(F.broadcast(offsets) if few else offsets, ["_file", "_start"])
    return rows.select((F.col("_nth") + F.col("_shift")).alias(name), *scan.columns)


def scan_lines(spark: SparkSession, path: str, schema: T.StructType, name: str = ROW_ID) -> DataFrame:
    """All lines of CSV files with their place; ``_rejected`` holds the text of a line that does not fit ``schema``, else NULL.

    Every line is read with all columns of the schema, so that what fits does not depend on the columns used later.
    """
    whole = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    reader = csv_reader(spark, whole).option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", False)
    return with_file_positions(reader.csv(path), name)


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, store: FeatureStore, name: str = "log", start: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The typed log of CSV files with a row id, and the lines that do not fit the schema as a written table (row id, line).

    A row id is the line's place among all lines, good or not, counted from ``start``; a second log begins where the first one
    ends (``next_row_id``), so that both can be put together. The log is written as Parquet, because features read it many
    times; both tables are those of ``store`` below ``name``.
    """
    lines = scan_lines(spark, path, schema)
    lines = lines.withColumn(ROW_ID, F.col(ROW_ID) + start)
    write_parquet(lines, store.path(f"{name}-lines"))
    lines = store.get(f"{name}-lines")
    bad = lines.where(F.col(REJECTED).isNotNull()).select(ROW_ID, F.col(REJECTED).alias("line"))
    write_parquet(bad, store.path(f"{name}-rejects"))
    return lines.where(F.col(REJECTED).isNull()).drop(REJECTED), store.get(f"{name}-rejects")


def next_row_id(*tables: DataFrame) -> int:
    """The first row id that no row of the tables has, be it of a log or of its rejected lines; 0 for empty ones."""
    found = [t.agg(F.max(ROW_ID)).first()[0] for t in tables]
    return max((x for x in found if x is not None), default=-1) + 1
