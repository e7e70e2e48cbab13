"""Many features on one log with few shuffles.

Features whose key contains the ``lead`` column (``ip``) are windows over one exchange on that column. Keys are
arranged in nested chains, so that one sort serves all windows of a chain. Rows of hot lead values leave this path:
they go through the sliced operators, and the two parts are put together again.

All other features are small or large tables by key. They are written to the store once; a table is broadcast when
its written row count is below ``spark.clickfeat.broadcastRows`` and otherwise joined with salted keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickfeat.functions.stats import stat
from clickfeat.functions.timeparts import epoch_seconds, seconds_field, whole_seconds
from clickfeat.naming import MICROS, ROW_ID, TIME
from clickfeat.operators.groups import group_table
from clickfeat.operators.history import PRIOR_CLICKS
from clickfeat.operators.ordered import NO_NEXT_CLICK_SECOND
from clickfeat.operators.slices import any_null, few_cuts, fits_one_slice, hot_keys, salted_join, slice_rows, spread
from clickfeat.plans.features import ORDER_KINDS, Feature, add_features
from clickfeat.sources.store import FeatureStore, identity, spec_name

BROADCAST_ROWS_CONF = "spark.clickfeat.broadcastRows"
DEFAULT_BROADCAST_ROWS = 200_000
TABLES_AT_ONCE = 4
# Rows of a task of the wide windows, which holds the sorts and windows of all chains at once.
WIDE_TASK_ROWS = 100_000


def key_sets(feature: Feature) -> list[frozenset[str]]:
    """Partitionings the feature's windows use, coarse to fine."""
    sets = [frozenset(feature.keys)]
    if feature.kind in ("distinct", "two_level"):
        sets.append(frozenset(feature.of))
    if feature.kind == "last_day_ratio":
        sets.append(frozenset([*feature.keys, "date"]))
    return sets


@dataclass
class Chain:
    """Nested keys, coarse to fine, that one sort order serves."""

    sets: list[frozenset[str]]
    members: list[Feature]

    def order(self, lead: str) -> list[str]:
        columns = [lead]
        for group in self.sets:
            columns += sorted(group - set(columns))
        return columns

    def takes(self, feature: Feature) -> bool:
        merged = sorted({*self.sets, *key_sets(feature)}, key=len)
        nested = all(a < b for a, b in zip(merged, merged[1:]))
        # The sort ends in time order only behind the finest key.
        timed = [m for m in [*self.members, feature] if m.kind in ORDER_KINDS]
        return nested and all(frozenset(m.keys) == merged[-1] for m in timed)

    def add(self, feature: Feature) -> None:
        self.sets = sorted({*self.sets, *key_sets(feature)}, key=len)
        self.members.append(feature)


def nested_chains(features: Sequence[Feature]) -> list[Chain]:
    chains: list[Chain] = []
    for feature in sorted(features, key=lambda f: (f.kind not in ORDER_KINDS, -len(key_sets(f)[-1]))):
        for chain in chains:
            if chain.takes(feature):
                chain.add(feature)
                break
        else:
            chains.append(Chain(sorted(set(key_sets(feature)), key=len), [feature]))
    return chains


def _helper(f: Feature, what: str) -> str:
    return f"_{f.name}_{what}"


def _first_of(order: Sequence[str], size: int) -> Column:
    """Whether the row is the first of its key, the first ``size`` columns of the sort order."""
    same = [F.col("_prev")[c].eqNullSafe(F.col(c)) for c in order[:size]]
    return F.col("_prev").isNull() | ~reduce(lambda a, b: a & b, same)


def _helpers(f: Feature, order: list[str]) -> list[dict[str, Column]]:
    """Columns a feature needs before its value, in two steps."""
    fine = Window.partitionBy(*order[: len(key_sets(f)[-1])])
    if f.kind in ("distinct", "two_level"):
        complete = ~any_null([c for c in f.of if c not in f.keys])
        first = {_helper(f, "first"): F.when(_first_of(order, len(f.of)) & complete, 1)}
        sized = {_helper(f, "size"): F.when(F.col(_helper(f, "first")) == 1, F.count(F.lit(1)).over(fine))}
        return [first, sized] if f.kind == "two_level" else [first]
    if f.kind == "last_day_ratio":
        clicks, converted = F.count(F.lit(1)).over(fine).alias("n"), F.sum("is_attributed").over(fine).alias("c")
        return [{_helper(f, "day"): F.struct(F.col("date").alias("d"), clicks, converted)}]
    return []


def _value(f: Feature, order: list[str]) -> Column:
    """The feature as a window column."""
    part = Window.partitionBy(*order[: len(f.keys)])
    timed = part.orderBy(TIME, ROW_ID)
    if f.kind == "ordinal":
        place = F.row_number().over(timed)
        return (place - 1 if f.how == "first" else F.count(F.lit(1)).over(part) - place).cast("long")
    if f.kind == "gap":
        return whole_seconds(F.lead(TIME).over(timed) - F.col(TIME) if f.how == "next" else F.col(TIME) - F.lag(TIME).over(timed))
    if f.kind == "delta":
        return seconds_field(F.lead(TIME).over(timed) - F.col(TIME))
    if f.kind == "sentinel":
        return F.coalesce(epoch_seconds(F.lead(TIME).over(timed)), F.lit(NO_NEXT_CLICK_SECOND)) - epoch_seconds(TIME)
    if f.kind == "distinct":
        return F.count(_helper(f, "first")).over(part)
    if f.kind == "two_level":
        return stat(f.how, _helper(f, "size")).over(part)
    if f.kind == "last_day_ratio":
        # The latest earlier day of the key; a value only if that is the day before.
        earlier = part.orderBy(F.unix_date("date")).rangeBetween(Window.unboundedPreceding, -1)
        latest = F.max(_helper(f, "day")).over(earlier)
        ratio = F.coalesce(latest["c"], F.lit(0)) / (latest["n"] + PRIOR_CLICKS)
        return F.when(latest["d"] == F.date_sub("date", 1), ratio)
    if f.kind == "span":
        return (F.max(TIME).over(part) - F.min(TIME).over(part)) / F.lit(float(MICROS))
    if f.kind == "mean_gap":
        return (F.max(TIME).over(part) - F.min(TIME).over(part)) / F.lit(float(MICROS)) / F.count(F.lit(1)).over(part)
    return f.aggregate().over(part)


def partitioned_by(df: DataFrame, lead: str) -> bool:
    """Whether the scan itself brings equal values of ``lead`` together, as that of a bucketed table does."""
    return str(df._jdf.queryExecution().sparkPlan().outputPartitioning()).startswith(f"hashpartitioning({lead}#")


def window_features(df: DataFrame, features: Sequence[Feature], lead: str) -> DataFrame:
    """Features on rows without hot lead values: one exchange, one sort per chain, one window per key and order.
    A log that is stored in buckets of the lead needs no exchange.

    A key that several chains share gets its values in the last of them, when all helper columns exist.
    """
    chains = nested_chains(features)
    last = {group: number for number, chain in enumerate(chains) for group in chain.sets}
    wide = df
    if not partitioned_by(df, lead):
        wide = spread(df, [lead], df, task_rows=WIDE_TASK_ROWS)
        wide = df.repartition(lead) if wide is df else wide
    for number, chain in enumerate(chains):
        order = chain.order(lead)
        wide = wide.sortWithinPartitions(*order, TIME, ROW_ID)
        if any(f.kind in ("distinct", "two_level") for f in chain.members):
            whole_lead = Window.partitionBy(lead).orderBy(*order[1:], TIME, ROW_ID)
            wide = wide.withColumn("_prev", F.lag(F.struct(*order)).over(whole_lead))
        steps = [_helpers(f, order) for f in chain.members]
        for depth in range(max(map(len, steps))):
            wide = wide.withColumns({n: c for s in steps if len(s) > depth for n, c in s[depth].items()})
        here = [f for f in chain.members if f.kind in ORDER_KINDS]
        here += [f for f in features if f.kind not in ORDER_KINDS and last[frozenset(f.keys)] == number]
        if here:
            wide = wide.withColumns({f.name: _value(f, order) for f in here})
    # Features of rows without a full key are empty. Helper columns are pruned right after their last use.
    return wide.select(*df.columns, *[F.when(~any_null(f.keys), F.col(f.name)).alias(f.name) for f in features])


def lead_features(
    log: DataFrame, features: Sequence[Feature], lead: str, columns: Sequence[str], store: FeatureStore, name: str
) -> DataFrame:
    """``columns`` of the log plus all ``features``, whose keys contain ``lead``.

    Hot lead values and their rows are written to the store once; all sliced operators then read those rows only.
    """
    needed = dict.fromkeys([*columns, ROW_ID, TIME, lead, *_inputs(features)])
    narrow = log.select(*[c for c in needed if c in log.columns])
    present = narrow.where(F.col(lead).isNotNull())
    made_of = identity(narrow, (lead, slice_rows(log.sparkSession)))
    found = lambda: hot_keys(present, [lead], [ROW_ID]).select(lead)
    hot = None if fits_one_slice(log) else store.get_or_compute(f"{name}-hot-{lead}", found, made_of)
    if hot is None or hot.isEmpty():
        wide = window_features(present, features, lead)
    else:
        listed = F.broadcast(hot) if few_cuts(log) else hot
        cold = present.join(listed, lead, "left_anti").select(*narrow.columns)
        theirs = lambda: present.join(listed, lead, "left_semi").select(*narrow.columns)
        apart = store.get_or_compute(f"{name}-rows-of-hot-{lead}", theirs, made_of)
        warm = add_features(apart, features)
        wide = window_features(cold, features, lead)
        wide = wide.unionByName(warm.select(*wide.columns))
    # Rows without a lead have no group; they stay where they are.
    absent = narrow.where(F.col(lead).isNull())
    absent = absent.select("*", *[F.lit(None).cast(wide.schema[f.name].dataType).alias(f.name) for f in features])
    return wide.unionByName(absent).select(*columns, *[f.name for f in features])


def _inputs(features: Sequence[Feature]) -> list[str]:
    found: dict[str, None] = {}
    for f in features:
        found.update(dict.fromkeys([*f.keys, *f.of, *([f.value] if f.value else [])]))
        if f.kind == "last_day_ratio":
            found.update(dict.fromkeys(["date", "is_attributed"]))
    return list(found)


def broadcast_rows(spark: SparkSession) -> int:
    """Rows up to which a counted key table is sent to every task."""
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def attach_checked(df: DataFrame, table: DataFrame, keys: Sequence[str], base: DataFrame, rows: int | None = None) -> DataFrame:
    """Left join of a written one-row-per-key table: broadcast when it is small, salted otherwise. ``rows`` is its size if counted."""
    if (table.count() if rows is None else rows) <= broadcast_rows(df.sparkSession):
        return df.join(F.broadcast(table), list(keys), "left").select(*df.columns, *[c for c in table.columns if c not in keys])
    return salted_join(df, table, keys, [ROW_ID], base)


def key_tables(log: DataFrame, features: Sequence[Feature], store: FeatureStore, prefix: str) -> list[tuple[list[str], DataFrame]]:
    """Written tables by key; features of the same key that are plain aggregates share one pass."""
    plain: dict[tuple[str, ...], list[Feature]] = {}
    single: list[Feature] = []
    for f in features:
        if f.is_plain():
            plain.setdefault(f.keys, []).append(f)
        else:
            single.append(f)
    source = identity(log)
    wanted = [
        (
            list(keys),
            f"{prefix}-{'-'.join(keys)}",
            partial(group_table, log, keys, {f.name: f.aggregate() for f in members}),
            members,
        )
        for keys, members in plain.items()
    ]
    wanted += [(f.table_keys(), f"{prefix}-{f.name}", partial(f.table, log), [f]) for f in single]
    # The tables are independent jobs; a few at a time keep the executors busy while one of them finishes.
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        tables = list(pool.map(lambda w: store.get_or_compute(w[1], w[2], spec_name(source, w[3])), wanted))
    return [(keys, table) for (keys, _, _, _), table in zip(wanted, tables)]


def build(
    log: DataFrame,
    features: Sequence[Feature],
    store: FeatureStore,
    name: str,
    lead: str = "ip",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The log's ``columns`` plus all ``features``. ``name`` prefixes what is written to the store."""
    columns = list(columns or log.columns)
    led = [f for f in features if lead in f.keys and f.kind != "ratio"]
    others = [f for f in features if f not in led]
    tables = [f for f in others if f.kind not in ORDER_KINDS]
    carried = list(dict.fromkeys([*columns, *[k for f in others for k in [*f.table_keys(), TIME, ROW_ID]]]))
    wide = lead_features(log, led, lead, carried, store, name) if led else log.select(*carried)
    for keys, table in key_tables(log, tables, store, name):
        wide = attach_checked(wide, table, keys, log)
    wide = add_features(wide, [f for f in others if f.kind in ORDER_KINDS], log)
    return wide.select(*columns, *[f.name for f in features])
