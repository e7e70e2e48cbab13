"""Writing tables, and a folder of named feature tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.session import ensure_checkpoint_dir


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True).csv(path)


@dataclass(frozen=True, order=True)
class InputFile:
    """A file as it was when it was listed; a file that was written again differs in its time."""

    path: str
    size: int
    changed: int


def manifest(spark: SparkSession, paths: Sequence[str]) -> list[InputFile]:
    """Path, length and modification time of input files (named as in ``inputFiles``)."""
    context = spark.sparkContext
    of_folder: dict[str, dict[str, str]] = {}
    for path in paths:
        found = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(path))
        of_folder.setdefault(found.getParent().toString(), {})[found.getName()] = path
    made = []
    for folder, names in of_folder.items():
        where = context._jvm.org.apache.hadoop.fs.Path(folder)
        for status in where.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(where):
            if (name := status.getPath().getName()) in names:
                # A scan writes an empty authority as file:/ in the metadata of a file and as file:/// in its list of files.
                made.append(InputFile(names[name].replace(":///", ":/"), status.getLen(), status.getModificationTime()))
    return sorted(made)


def identity(log: DataFrame, spec: object = "") -> str:
    """A short name for "this computation on this input": the input's plan, the files it reads with their lengths and times,
    and ``spec``. ``FeatureStore.drop`` removes old tables."""
    plan = log._jdf.queryExecution().optimizedPlan()
    parts = [plan.canonicalized().toString(), str(log.semanticHash()), repr(manifest(log.sparkSession, log.inputFiles())), repr(spec)]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]


def spec_name(source: str, spec: object) -> str:
    """``source`` (an ``identity``) narrowed to one computation on it."""
    return hashlib.sha256(f"{source}\n{spec!r}".encode()).hexdigest()[:16]


# Aggregates of a part of the rows, and how those of several parts become that of all.
MERGED = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}
# Lists of up to so many files are sent to every task.
LISTED = 100_000


class FeatureStore:
    """Feature tables by name below one folder that all executors can reach.

    A table counts as present once its write has committed (``_SUCCESS``), so a job lost half-way is computed again. A
    name stands for one computation only; ``made_of`` tells computations of one name apart.
    """

    def __init__(self, spark: SparkSession, root: str, reuse: bool = True):
        self.spark, self.root, self.reuse = spark, root.rstrip("/"), reuse

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _hadoop(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), found

    def has(self, name: str) -> bool:
        files, done = self._hadoop(f"{self.path(name)}/_SUCCESS")
        return files.exists(done)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def get_or_compute(self, name: str, compute: Callable[[], DataFrame], made_of: str = "", partition_by: Sequence[str] = ()) -> DataFrame:
        """The stored table; computed and written first when absent or when ``reuse`` is off.

        ``made_of`` (see ``identity``) becomes part of the name, so another input or another spec misses.
        """
        name = f"{name}-{made_of}" if made_of else name
        if not (self.reuse and self.has(name)):
            write_parquet(compute(), self.path(name), partition_by)
        return self.get(name)

    def merged(
        self, name: str, paths: Sequence[str], read: Callable[[list[str]], DataFrame], keys: Sequence[str], sums: dict[str, tuple[str, Column]]
    ) -> DataFrame:
        """Aggregates by ``keys`` over files of a log that grows: each file is read once and its own aggregates are kept.

        ``sums`` names ``(how, column)`` with ``how`` one of ``MERGED``; NULL keys form a group. A call reads only the files that
        are new or were written again since (other length or time), adds their aggregates as a batch of their own, and
        merges those of all files in ``paths``; files that are gone or replaced no longer count. ``read`` is a direct scan
        of the files it is given. A batch counts once its list of files is written, so a call that was lost is done again.
        """
        folder = f"{self.path(name)}/{spec_name('merged', (list(keys), {n: (how, str(c)) for n, (how, c) in sums.items()}))}"
        present = manifest(self.spark, paths)
        now = self.spark.createDataFrame([(f.path, f.size, f.changed) for f in present], "_path string, _size long, _changed long")
        files, at = self._hadoop(f"{folder}/*/files/_SUCCESS")
        batches = [status.getPath().getParent().getParent().toString() for status in files.globStatus(at) or []]
        known = self.spark.read.parquet(*[f"{b}/files" for b in batches]) if batches else now.limit(0)
        # As many rows as files; the paths to read must be known to the driver, as in any scan.
        new = now.join(known, now.columns, "left_anti").collect()
        if new:
            context = self.spark.sparkContext._jvm.org.apache.hadoop.fs
            batch, told = f"{folder}/{uuid.uuid4().hex}", {r["_path"] for r in new}
            fresh = [f for f in present if f.path in told]
            listed = self.spark.createDataFrame([(f.path, f.size, f.changed) for f in fresh], now.schema)
            plain = [context.Path(self.spark.sparkContext._jvm.java.net.URI(f.path)).toString() for f in fresh]
            rows = read(plain).select("*", F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/")).alias("_path"))
            parts = rows.groupBy("_path", *keys).agg(*[MERGED[how][0](c).alias(n) for n, (how, c) in sums.items()])
            write_parquet(parts.join(F.broadcast(listed) if len(fresh) <= LISTED else listed, "_path"), f"{batch}/sums")
            write_parquet(listed, f"{batch}/files")
            batches.append(batch)
        every = self.spark.read.parquet(*[f"{b}/sums" for b in batches])
        kept = every.join(F.broadcast(now) if len(present) <= LISTED else now, now.columns, "left_semi")
        return kept.groupBy(*keys).agg(*[MERGED[how][1](n).alias(n) for n, (how, _) in sums.items()])

    def bucketed(self, name: str, df: DataFrame, key: str, order: Sequence[str], buckets: int) -> DataFrame:
        """``df`` written once into ``buckets`` by ``key``, sorted by ``key`` and ``order`` in each, and read back as such.

        Windows, groups and joins whose keys contain ``key`` then need no exchange of the rows. The table is known to this
        session's catalog; its files are those of the store.
        """
        table = f"clickfeat_{uuid.uuid4().hex}"
        # One task writes a bucket, so that a bucket is one file.
        rows = df.repartition(buckets, F.col(key))
        rows.write.bucketBy(buckets, key).sortBy(key, *order).option("path", self.path(name)).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, name: str = "") -> None:
        """Delete the tables whose name starts with ``name``; without one, the whole folder."""
        files, found = self._hadoop(f"{self.root}/{name}*" if name else self.root)
        for status in files.globStatus(found) or []:
            files.delete(status.getPath(), True)


def run_store(spark: SparkSession) -> FeatureStore:
    """A store of its own for one run, in the shared checkpoint folder."""
    return FeatureStore(spark, f"{ensure_checkpoint_dir(spark)}/features-{uuid.uuid4().hex}")
