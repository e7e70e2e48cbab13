"""Allow and block lists of urls, held as a trie over reversed host labels and path segments.

An entry is (host, path, verdict). It fits a url when its host is the url's host or a parent domain of it, and the url's
path starts with its path. In the trie the labels of an entry's host come first, last label first (``net``,
``example``), then the whole segments of its path; what follows the last slash of its path is compared with the start of the
url's next segment. A url walks down its host labels and, from every label on the way, down its path segments. Of the
entries it meets the one with the most host labels wins, then the one with the longest path; a block entry wins over an
allow entry of the same host and path.

The lists are cut into parts of at most ``PART_BYTES`` of text. Each part makes one trie that is broadcast; the urls pass
the tries one after the other and keep the best entry so far, so lists of any length need a fixed amount of memory and
no shuffle of the urls. Lists of usual length are one part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import stored, without

ALLOW, BLOCK = "allow", "block"
# Text of the entries in one broadcast trie.
PART_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Entries by reversed host labels and path segments, in flat tables of numbered nodes."""

    def __init__(self) -> None:
        self.labels: dict[tuple[int, str], int] = {}
        self.segments: dict[tuple[int, str], int] = {}
        # Per node the entries that end in it, by the length of the start of the next segment: start -> (path length, verdict).
        self.ends: dict[int, dict[int, dict[str, tuple[int, str]]]] = {}
        self.nodes = 1

    def _step(self, table: dict[tuple[int, str], int], node: int, word: str) -> int:
        found = table.get((node, word))
        if found is None:
            found = table[node, word] = self.nodes
            self.nodes += 1
        return found

    def add(self, host: str, path: str, verdict: str) -> None:
        node = 0
        for label in reversed(host.split(".")) if host else ():
            node = self._step(self.labels, node, label)
        *whole, start = path.split("/")
        for segment in whole:
            node = self._step(self.segments, node, segment)
        ends = self.ends.setdefault(node, {}).setdefault(len(start), {})
        if ends.get(start, (0, ALLOW))[1] != BLOCK:
            ends[start] = (len(path), verdict)

    def _longest(self, node: int, segments: list[str]) -> tuple[int, str] | None:
        """(path length, verdict) of the longest path below a host node that fits."""
        best = None
        for segment in segments:
            for size, ends in self.ends.get(node, {}).items():
                end = ends.get(segment[:size])
                if end and (best is None or end[0] > best[0]):
                    best = end
            node = self.segments.get((node, segment), -1)
            if node < 0:
                break
        return best

    def best(self, host: str, path: str) -> tuple[int, int, str] | None:
        """(host labels, path length, verdict) of the winning entry."""
        segments, found, node = path.split("/"), None, 0
        labels = host.split(".")
        for depth in range(len(labels) + 1):
            longest = self._longest(node, segments)
            if longest:
                found = (depth, *longest)
            node = self.labels.get((node, labels[-1 - depth]), -1) if depth < len(labels) else -1
            if node < 0:
                break
        return found


def rules(spark: SparkSession, entries: list[tuple[str, str, str]]) -> DataFrame:
    """A table of (host, path, verdict)."""
    return spark.createDataFrame(entries, "host string, path string, verdict string")


def _parts(entries: DataFrame) -> Iterator[Trie]:
    """One trie after the other; each holds the entries of one hash part."""
    clean = entries.where(F.col("verdict").isin(ALLOW, BLOCK)).select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    size = clean.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
    count = int(size // PART_BYTES) + 1
    # Hash parts are uneven by chance, so they are taken a little smaller than the bound.
    count = count if count == 1 else count + count // 4 + 1
    for part in range(count):
        trie = Trie()
        chosen = clean if count == 1 else clean.where(F.pmod(F.xxhash64("host", "path"), F.lit(count)) == part)
        for entry in chosen.distinct().toLocalIterator():
            trie.add(*entry)
        yield trie


def _walk(spark: SparkSession, trie: Trie):
    """A function from host and path to the winning entry of one trie."""
    sent = spark.sparkContext.broadcast(trie)

    @F.pandas_udf("hosts int, length int, verdict string")
    def walk(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [sent.value.best(host, path) or (None, None, None) for host, path in zip(hosts, paths)]
        table = pd.DataFrame(found, columns=["hosts", "length", "verdict"])
        return table.astype({"hosts": "Int32", "length": "Int32"})

    return walk


def judge(urls: DataFrame, entries: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` by the ``entries`` (host, path, verdict).

    ``rule`` is the winning entry's host and path as one text, NULL where none fits; ``verdict`` is then ``default``.
    Every row stays, repeated ones too. A NULL url, and one without ``://``, has an empty host and path. An entry with
    an empty or NULL host fits every host, one with an empty or NULL path every path; entries whose verdict is neither
    ``allow`` nor ``block`` are left out, repeated ones count once; without entries every row gets ``default``. Columns of
    ``urls`` with one of the new names are replaced.
    """
    spark = urls.sparkSession
    keep = without(urls, ["host", "path", "rule", "verdict"])
    made = urls.select(
        *[F.col(f"`{c}`") for c in keep], url_host(F.col(url)).alias("_host"), url_path(F.col(url)).alias("_path"),
        F.lit(None).cast("struct<hosts:int,length:int,verdict:string>").alias("_best"),
    )
    for number, trie in enumerate(_parts(entries)):
        # One trie at a time is in the executors' memory.
        made = stored(made, f"urls-{number}") if number else made
        here = _walk(spark, trie)("_host", "_path")
        better = F.struct("_here.hosts", "_here.length") > F.struct("_best.hosts", "_best.length")
        taken = F.when(F.col("_here.hosts").isNull(), F.col("_best")).when(
            F.col("_best.hosts").isNull() | better, F.col("_here")
        ).otherwise(F.col("_best"))
        made = made.withColumn("_here", here).withColumn("_best", taken).drop("_here")
    labels = F.slice(F.split("_host", r"\."), -F.greatest(F.col("_best.hosts"), F.lit(1)), F.greatest(F.col("_best.hosts"), F.lit(1)))
    fitting = F.when(F.col("_best.hosts") > 0, F.array_join(labels, ".")).otherwise(F.lit(""))
    rule = F.concat(fitting, F.substring("_path", F.lit(1), F.col("_best.length")))
    return made.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.when(F.col("_best.hosts").isNotNull(), rule).alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )


def allowed(urls: DataFrame, entries: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``urls`` that no list blocks, with their own columns."""
    judged = judge(urls.withColumn("_url", F.col(url)).select("_url", F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("_row")), entries, "_url", default)
    return judged.where(F.col("verdict") == ALLOW).select("_row.*")
