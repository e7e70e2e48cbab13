"""A feature as data: what to compute, for which key, under which name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.stats import stat
from clickfeat.functions.timeparts import epoch_seconds, gap_seconds, seconds_field, whole_seconds
from clickfeat.naming import TIME
from clickfeat.operators import groups, history, ordered

# Kinds that depend on the row's place in time; all others have one value per key.
ORDER_KINDS = ("ordinal", "gap", "sentinel", "delta")


@dataclass(frozen=True)
class Feature:
    kind: str
    keys: tuple[str, ...]
    name: str
    of: tuple[str, ...] = ()  # the finer key of distinct and two_level, the denominator's key of ratio
    value: str | None = None
    how: str | None = None

    def from_timeline(self) -> Column:
        """Value of an ordered feature on the columns of ``ordered.timeline``."""
        if self.kind == "ordinal":
            return (F.col("_at") if self.how == "first" else F.col("_of") - 1 - F.col("_at")).cast("long")
        if self.kind == "gap":
            return whole_seconds(F.col("_next_t") - F.col(TIME) if self.how == "next" else F.col(TIME) - F.col("_prev_t"))
        if self.kind == "delta":
            return seconds_field(F.col("_next_t") - F.col(TIME))
        if self.kind == "sentinel":
            last = F.lit(ordered.NO_NEXT_CLICK_SECOND)
            gap = F.coalesce(epoch_seconds("_next_t"), last) - epoch_seconds(TIME)
            return F.when(F.col("_at").isNotNull(), gap)
        raise ValueError(f"{self.kind} does not depend on order")

    def table_keys(self) -> list[str]:
        if self.kind == "ratio":
            return list(dict.fromkeys([*self.keys, *self.of]))
        return [*self.keys, "date"] if self.kind == "last_day_ratio" else list(self.keys)

    def table(self, log: DataFrame) -> DataFrame:
        """One row per key with the feature's value."""
        keys = list(self.keys)
        if self.kind == "distinct":
            return groups.distinct_table(log, keys, [c for c in self.of if c not in keys], self.name)
        if self.kind == "two_level":
            return groups.two_level_table(log, self.of, keys, [self.how], {self.how: self.name})
        if self.kind == "ratio":
            # Size of the ``keys`` group over the size of the ``of`` group, for every pair of them that occurs.
            pairs = groups.group_table(log, self.table_keys(), {"_pairs": F.count(F.lit(1))})
            for part, size in ((self.keys, "_over"), (self.of, "_under")):
                sizes = groups.group_table(log, list(part), {size: F.count(F.lit(1))})
                pairs = groups.salted_join(pairs, sizes, list(part), self.table_keys())
            return pairs.select(*self.table_keys(), (F.col("_over") / F.col("_under")).alias(self.name))
        if self.kind == "last_day_ratio":
            lagged = history.daily_table(log, keys).withColumn("date", F.date_add("date", 1))
            ratio = F.col("_converted") / (F.col("_clicks") + history.PRIOR_CLICKS)
            return lagged.select(*keys, "date", ratio.alias(self.name))
        if self.kind == "stat" and self.how == "median":
            return groups.median_table(log, keys, self.value, self.name)
        return groups.group_table(log, keys, {self.name: self.aggregate()})

    def is_plain(self) -> bool:
        return self.kind in ("size", "count", "span", "mean_gap") or (self.kind == "stat" and self.how != "median")

    def aggregate(self) -> Column:
        if self.kind == "size":
            return F.count(F.lit(1))
        if self.kind == "count":
            return F.count(self.value)
        if self.kind == "stat":
            return stat(self.how, self.value)
        if self.kind == "span":
            return gap_seconds(F.max(TIME), F.min(TIME))
        if self.kind == "mean_gap":
            return gap_seconds(F.max(TIME), F.min(TIME)) / F.count(F.lit(1))
        raise ValueError(f"{self.kind} is not a plain aggregate")


def add_features(df: DataFrame, features: Sequence[Feature], base: DataFrame | None = None) -> DataFrame:
    """The log with all features; ``base`` is the log ``df`` was derived from row by row.

    Features of the same key share one pass.
    """
    base = df if base is None else base
    columns = df.columns
    by_order: dict[frozenset[str], list[Feature]] = {}
    by_table: dict[tuple[str, ...], list[Feature]] = {}
    for f in features:
        if f.kind in ORDER_KINDS:
            by_order.setdefault(frozenset(f.keys), []).append(f)
        else:
            by_table.setdefault(tuple(f.table_keys()), []).append(f)
    for members in by_order.values():
        timed = ordered.timeline(df, members[0].keys, base=base)
        df = timed.select(*df.columns, *[f.from_timeline().alias(f.name) for f in members])
    for keys, members in by_table.items():
        plain = {f.name: f.aggregate() for f in members if f.is_plain()}
        tables = [groups.group_table(base, keys, plain)] if plain else []
        tables += [f.table(base) for f in members if not f.is_plain()]
        joined = reduce(lambda a, b: a.join(b, list(keys), "full"), tables)
        df = groups.attach(df, joined, keys, base=base)
    return df.select(*columns, *[f.name for f in features])


def _join(*parts) -> str:
    return "_".join(parts)


def size(*keys: str, name: str | None = None) -> Feature:
    return Feature("size", keys, name or _join(*keys, "count"))


def count(value: str, *keys: str, name: str) -> Feature:
    return Feature("count", keys, name, value=value)


def distinct(*of: str, by: tuple[str, ...] | None = None, name: str | None = None) -> Feature:
    keys = by or of[:-1]
    return Feature("distinct", keys, name or _join(*of, "count", *keys), of=of)


def statistic(how: str, value: str, *keys: str, name: str | None = None) -> Feature:
    return Feature("stat", keys, name or _join(*keys, value, how), value=value, how=how)


def two_level(how: str, *of: str, by: tuple[str, ...] | None = None) -> Feature:
    keys = by or of[-1:]
    return Feature("two_level", keys, _join(*of, *keys, "2level" + how), of=of, how=how)


def first_place(*keys: str, name: str | None = None) -> Feature:
    return Feature("ordinal", keys, name or _join(*keys, "rank_True"), how="first")


def last_place(*keys: str, name: str | None = None) -> Feature:
    return Feature("ordinal", keys, name or _join(*keys, "rank_False"), how="last")


def gap(which: str, *keys: str) -> Feature:
    return Feature("gap", keys, _join(*keys, "next_click", which), how=which)


def sentinel_gap(*keys: str, name: str | None = None) -> Feature:
    return Feature("sentinel", keys, name or _join(*keys, "hash_click"))


def delta(*keys: str) -> Feature:
    return Feature("delta", keys, _join(*keys, "delta"))


def span(*keys: str) -> Feature:
    return Feature("span", keys, _join(*keys, "time_span"))


def mean_gap(*keys: str) -> Feature:
    return Feature("mean_gap", keys, _join(*keys, "timespan_average"))


def ratio(*keys: str, of: tuple[str, ...], name: str) -> Feature:
    """Size of the ``keys`` group over that of the ``of`` group; either may be the finer one."""
    return Feature("ratio", keys, name, of=of)


def last_day_ratio(*keys: str) -> Feature:
    return Feature("last_day_ratio", keys, _join(*keys, "last_day_ratio"))
