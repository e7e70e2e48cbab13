"""Spreading hot keys over several tasks.

``Window.partitionBy(key)`` and a join on ``key`` send all rows of one key to one task, so a key with a third of
the log would stop the job. The helpers here cut such keys into slices of about ``spark.clickfeat.sliceRows`` rows:

* ``hot_keys`` and ``salted_join`` spread the row side of a key join;
* ``SlicedRows`` cuts a key into order-preserving slices, lets a window run inside each slice, and corrects the
  result with one small row per slice ("carry").

Cut positions come from a hash sample of the rows. The sample only decides where slices end: every row is kept and
results are exact for any choice of cuts. Their number follows the log: one per ``sliceRows`` rows. The sample is a
function of the row, so every pass over the same log finds the same cuts; a log that changes between passes (a ``limit``
without order) must be written out first.

A row finds its slice in three levels. The cuts of a key are grouped by the cube root of their number, twice; a level
tells the row which group it belongs to, and only that group's few cuts meet the row at the next level. Cuts and
carried rows are broadcast when the log's size says that there are at most ``spark.clickfeat.broadcastCuts`` of them,
and joined by shuffling otherwise; the groups of the last level are even, so that join has no hot key.

A table that Spark estimates below the size of one slice is not cut: its plan is the plain window or join.

Rows that were cut are exchanged into as many tasks as their number asks for (``spread``), so what a task holds does not
grow with the log. Where one row of the log becomes several, ``per_row`` says how many; slices and tasks follow it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

SLICE = "_slice"
SPLIT = "_split"
CUTS = "_cuts"
SALT = "_salt"
FAN = "_fan"
GROUP = "_group"

SLICE_ROWS_CONF = "spark.clickfeat.sliceRows"
BROADCAST_CUTS_CONF = "spark.clickfeat.broadcastCuts"
DEFAULT_SLICE_ROWS = 1_000_000
DEFAULT_BROADCAST_CUTS = 500_000
# Narrow rows take at least this much in a scan; used to tell tables smaller than a slice.
SMALL_ROW_BYTES = 16
# A table of unknown size is given more than this.
UNKNOWN_BYTES = 1 << 60
# About so many rows are to reach a task of an exchange by key.
TASK_ROWS = 500_000
# Up to so many cuts of a group are compared with a row one by one in generated code.
FEW_CUTS = 8


def slice_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(SLICE_ROWS_CONF, str(DEFAULT_SLICE_ROWS)))


def _size_estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _read_bytes(df: DataFrame) -> int:
    """What the tables below ``df`` take, as far as Spark knows; unlike the estimate of a join, this follows the input."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def fits_one_slice(df: DataFrame) -> bool:
    """Whether Spark's size estimate puts the whole table below one slice."""
    return _size_estimate(df) <= slice_rows(df.sparkSession) * SMALL_ROW_BYTES


def few_cuts(df: DataFrame, per_row: int = 1) -> bool:
    """Whether the cuts of the table are few enough to be sent to every task."""
    limit = int(df.sparkSession.conf.get(BROADCAST_CUTS_CONF, str(DEFAULT_BROADCAST_CUTS)))
    return _size_estimate(df) * per_row <= limit * slice_rows(df.sparkSession) * SMALL_ROW_BYTES


def spread(rows: DataFrame, by: Sequence[str], log: DataFrame, per_row: int = 1, task_rows: int | None = None) -> DataFrame:
    """``rows`` exchanged on ``by`` into one task per about ``task_rows`` rows, by the size of ``log`` with ``per_row`` rows for
    each of its own. Logs for which the session's shuffle partitions are enough are left to the operator that needs the exchange."""
    tasks = _read_bytes(log) * per_row // ((task_rows or TASK_ROWS) * SMALL_ROW_BYTES) + 1
    return rows.repartition(tasks, *by) if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def _sent(table: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(table) if few else table


def null_key_spread(spark: SparkSession) -> int:
    """Rows with a NULL key belong to no group; they only need an even spread over the partitions of a shuffle."""
    return 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have a group at all."""
    return df.where(~any_null(keys)) if keys else df


def _sampled(df: DataFrame, keys: Sequence[str], unique: Sequence[str], also: Sequence[str] = (), per_row: int = 1) -> DataFrame:
    """About one row in ``sliceRows`` divided by ``per_row``."""
    columns = list(dict.fromkeys([*keys, *also, *unique]))
    chosen = F.pmod(F.xxhash64(*unique), F.lit(max(1, slice_rows(df.sparkSession) // per_row))) == 0
    return with_keys(df, keys).where(chosen).select(*columns)


def hot_keys(df: DataFrame, keys: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """Keys with many rows and the number of extra tasks each should get; at most one per ``sliceRows`` rows."""
    return _sampled(df, keys, unique).groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias(FAN))


def salted_join(
    rows: DataFrame, one_per_key: DataFrame, keys: Sequence[str], unique: Sequence[str], base: DataFrame | None = None
) -> DataFrame:
    """Left join of a table with one row per key, with the rows of hot keys spread over several tasks.

    The key table grows by at most one row per ``sliceRows`` rows. ``unique`` identifies a row and drives the spread. When ``rows``
    is costly to compute, ``base`` may name a cheaper table with the same keys and row ids to find hot keys in.
    """
    keys, base = list(keys), rows if base is None else base
    made = [c for c in one_per_key.columns if c not in keys]
    if fits_one_slice(base):
        return rows.join(one_per_key, keys, "left").select(*rows.columns, *made)
    hot = _sent(hot_keys(base, keys, unique), few_cuts(base))
    spread = F.pmod(F.xxhash64(*unique), F.coalesce(FAN, F.lit(0)) + 1).cast("int")
    loose = F.pmod(F.xxhash64(*unique), F.lit(null_key_spread(rows.sparkSession))).cast("int")
    left = rows.join(hot, keys, "left").withColumn(SALT, F.when(any_null(keys), loose).otherwise(spread)).drop(FAN)
    right = (
        one_per_key.join(hot, keys, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(FAN, F.lit(0)))))
        .drop(FAN)
    )
    return left.join(right, [*keys, SALT], "left").select(*rows.columns, *made)


class SlicedRows:
    """Rows of each key cut into consecutive slices of the order given by ``order``.

    ``order`` must be unique within a key. Empty ``keys`` means one order over the whole table.

    Cuts and carried rows are separate passes over the input. When ``df`` is costly to compute, ``base`` names the
    cheap log it was derived from row by row; both passes then read that log, so a chain of features stays linear.
    ``sample`` replaces the base for the cuts only; ``unique`` are its unique columns, and ``per_row`` is the number of rows
    in ``df`` for each of its rows.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        base: DataFrame | None = None,
        sample: DataFrame | None = None,
        unique: Sequence[str] | None = None,
        per_row: int = 1,
    ):
        self.keys, self.order = list(keys), list(order)
        self.columns = df.columns
        sample = sample if sample is not None else base if base is not None else df
        self.is_cut = not fits_one_slice(sample)
        if not self.is_cut:
            self.rows = self.base_rows = df
            return
        self.few = few_cuts(sample, per_row)
        levels = self._levels(_sampled(sample, self.keys, unique or [*self.keys, *self.order], self.order, per_row))
        cut = self._cut(df, levels)
        self.rows = spread(cut, [*self.keys, SLICE], sample, per_row)
        self.base_rows = cut if base is None else self._cut(base, levels)

    def _levels(self, cuts: DataFrame) -> list[DataFrame]:
        """Of each level the sorted cuts of every group. A group is numbered by the cuts before it: the first level has
        one group per key, the second about the cube root of the key's cuts, the third its square."""
        of_key = Window.partitionBy(*self.keys)
        place = (F.row_number().over(of_key.orderBy(*self.order)) - 1).cast("long")
        count = F.count(F.lit(1)).over(of_key)
        numbered = cuts.withColumns({"_i": place, "_fan": F.ceil(F.cbrt(count)).cast("long")})
        position, i, fan = F.struct(*self.order), F.col("_i"), F.col("_fan")
        found = []
        for step, group in ((fan * fan, F.lit(0)), (fan, i - i % (fan * fan)), (F.lit(1), i - i % fan)):
            named = numbered.where(i % step == 0).withColumns({GROUP: group.cast("long"), "_step": step.cast("long")})
            packed = named.groupBy(*self.keys, GROUP).agg(
                F.sort_array(F.collect_list(position)).alias("at"), F.max("_step").alias("step")
            )
            found.append(packed.select(*self.keys, GROUP, F.struct("at", "step").alias(CUTS)))
        return found

    def _cut(self, df: DataFrame, levels: Sequence[DataFrame]) -> DataFrame:
        """The number of cuts at or before each row, level by level; NULL where the key has no cuts."""
        position = F.struct(*self.order)
        located = df
        for depth, level in enumerate(levels):
            if depth == 0 and not self.keys:
                located = located.withColumn(CUTS, level.select(CUTS).scalar())
            elif depth == 0:
                located = located.join(F.broadcast(level.drop(GROUP)) if self.few else level.drop(GROUP), self.keys, "left")
            else:
                located = located.join(_sent(level, self.few), [*self.keys, GROUP], "left")
            here = _cuts_up_to(position)
            before = F.lit(0).cast("long") if depth == 0 else F.col(GROUP)
            last = depth == len(levels) - 1
            # Of the groups whose first cut lies at or before the row the last one is the row's; without one it is the first.
            at = before + (here if last else F.greatest(here - 1, F.lit(0)) * F.col(CUTS)["step"])
            located = located.withColumn("_next", F.when(F.col(CUTS).isNotNull(), at))
            located = located.drop(CUTS, GROUP).withColumnRenamed("_next", GROUP)
        number = F.coalesce(GROUP, F.lit(0))
        if self.keys:
            loose = F.pmod(F.xxhash64(*self.order), F.lit(null_key_spread(df.sparkSession)))
            number = F.when(any_null(self.keys), loose).otherwise(number)
        return located.withColumns({SLICE: number, SPLIT: F.col(GROUP).isNotNull()}).drop(GROUP)

    def window(self) -> WindowSpec:
        """All rows of the slice."""
        return Window.partitionBy(*self.keys, *([SLICE] if self.is_cut else []))

    def ordered(self) -> WindowSpec:
        return self.window().orderBy(*self.order)

    def carry(
        self,
        onto: DataFrame,
        parts: dict[str, Column],
        *stages: Callable[[WindowSpec], dict[str, Column]],
        source: DataFrame | None = None,
    ) -> DataFrame:
        """Join onto every row what the other slices of its key contribute.

        ``parts`` are aggregates of one slice. Each of ``stages`` combines them over the slices of a key, in order;
        the results of the last stage are joined. Only keys that were cut appear, so the table has at most two
        rows per cut. Keys and tables that were not cut get NULL.
        """
        over_slices = Window.partitionBy(*self.keys).orderBy(SLICE)
        made = stages[-1](over_slices)
        if not self.is_cut:
            return onto.withColumns({n: F.lit(None) for n in made})
        split = (self.base_rows if source is None else source).where(F.col(SPLIT))
        table = split.groupBy(*self.keys, SLICE).agg(*[c.alias(n) for n, c in parts.items()])
        for stage in stages[:-1]:
            table = table.withColumns(stage(over_slices))
        table = table.select(*self.keys, SLICE, *[c.alias(n) for n, c in made.items()])
        return onto.join(_sent(table, self.few), [*self.keys, SLICE], "left")

    def finish(self, df: DataFrame, features: dict[str, Column]) -> DataFrame:
        """Input columns plus ``features``, which are NULL for rows without a full key."""
        if self.keys:
            features = {n: F.when(~any_null(self.keys), c) for n, c in features.items()}
        return df.select(*self.columns, *[c.alias(n) for n, c in features.items()])


def all_slices(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def earlier_slices(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _cuts_up_to(position: Column) -> Column:
    """How many of the group's cuts lie at or before ``position``; a group has few."""
    at = F.col(CUTS)["at"]
    # Function calls per element cost a row more than all else, so up to FEW_CUTS cuts are compared without them.
    before = [F.coalesce((F.get(at, F.lit(i)) <= position).cast("long"), F.lit(0)) for i in range(FEW_CUTS)]
    counted = F.size(F.filter(at, lambda cut: cut <= position)).cast("long")
    return F.when(F.size(at) <= FEW_CUTS, reduce(lambda a, b: a + b, before)).otherwise(counted)
