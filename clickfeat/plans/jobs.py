"""The feature runs from log to table."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.functions.scalars import MISSING_GAP, add_all_interactions, fill_missing
from clickfeat.functions.timeparts import add_time_parts, shift_zone
from clickfeat.naming import ROW_ID, TIME
from clickfeat.operators import groups, history, ordered, ranges, relational
from clickfeat.plans import catalog, wide
from clickfeat.sources.clicklog import TEST_SCHEMA, TRAIN_SCHEMA, prepare
from clickfeat.sources.positions import load_csv, next_row_id
from clickfeat.sources.store import FeatureStore, identity, write_parquet


def training_table(log: DataFrame, store: FeatureStore, name: str = "training") -> DataFrame:
    """The wide table: all listed features, gaps filled, and the two features that need the table itself."""
    base = store.get_or_compute(
        f"{name}-wide",
        lambda: fill_missing(
            wide.build(log, catalog.WIDE, store, f"{name}-key"), [f.name for f in catalog.GAPS], MISSING_GAP
        ),
        identity(log, catalog.WIDE),
    )
    return wide.build(base, catalog.DERIVED, store, f"{name}-derived", lead="ip")


def counts_of_both(train: DataFrame, test: DataFrame, store: FeatureStore, name: str = "counts") -> tuple[DataFrame, DataFrame]:
    """Counts over labelled and unlabelled rows in local time, returned as the two parts."""
    log = relational.union_logs(train, test)
    local = add_time_parts(log.withColumn("click_time", shift_zone("click_time")), parts=["day", "hour"])
    keep = [ROW_ID, "is_attributed", "click_id"]
    made = wide.build(local, catalog.COUNTS_ALL_ROWS, store, name, columns=keep)
    train_part = relational.labelled(made).drop("is_attributed", "click_id")
    test_part = relational.unlabelled(made).drop("is_attributed", "click_id")
    return train_part, test_part


def selected_features(log: DataFrame, store: FeatureStore, name: str = "selected", columns: Sequence[str] = (ROW_ID,)) -> DataFrame:
    """The second training table, with the next-click gap of the row before."""
    made = store.get_or_compute(f"{name}-rows", lambda: wide.build(log, catalog.SELECTED, store, f"{name}-key", columns=columns), identity(log, (catalog.SELECTED, columns)))
    return ordered.previous_in_file(made, "nextClick")


def deltas_and_places(log: DataFrame, store: FeatureStore, name: str = "deltas") -> DataFrame:
    """Gaps to the next click and running ordinals of every listed key."""
    features = [*catalog.DELTAS, *catalog.RUNNING]
    made = wide.build(log, features, store, name, columns=[ROW_ID])
    shifted = ordered.shifted_group_difference(log, catalog.SHIFTED_DELTA)
    return made.join(shifted.select(ROW_ID, shifted.columns[-1]), ROW_ID)


def logs_from_csv(
    spark: SparkSession, train: str, test: str, store: FeatureStore, schemas: tuple[T.StructType, T.StructType] = (TRAIN_SCHEMA, TEST_SCHEMA)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled and unlabelled clicks of CSV files with time columns and row ids, the test rows numbered behind the train rows,
    and the lines of both that do not fit their schema (``part``, row id, line)."""
    first, bad_first = load_csv(spark, train, schemas[0], store, "train")
    then, bad_then = load_csv(spark, test, schemas[1], store, "test", next_row_id(first, bad_first))
    bad = [b.select(F.lit(part).alias("part"), ROW_ID, "line") for part, b in (("train", bad_first), ("test", bad_then))]
    return prepare(first), prepare(then), relational.union_like(*bad)


def bucketed_log(log: DataFrame, store: FeatureStore, lead: str = "ip", buckets: int | None = None, name: str = "bucketed") -> DataFrame:
    """The log written once in buckets of its lead key, for the runs that use that key again and again."""
    buckets = buckets or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store.bucketed(name, log, lead, [TIME, ROW_ID], buckets)


def impression_statistics(log: DataFrame, rid: str = ROW_ID) -> DataFrame:
    """The listed statistics of impressions, and the interactions of every pair of scores."""
    made = groups.group_statistics(log, catalog.IMPRESSION_STATISTICS, rid)
    return add_all_interactions(made, list(catalog.SCORES))


def write_counts_of_both(train: DataFrame, test: DataFrame, store: FeatureStore, name: str = "counts") -> dict[str, DataFrame]:
    """``counts_of_both`` with each part written as a table of its own, read back."""
    parts = dict(zip(("train", "test"), counts_of_both(train, test, store, name)))
    for part, made in parts.items():
        write_parquet(made, store.path(f"{name}-{part}"))
    return {part: store.get(f"{name}-{part}") for part in parts}


def history_features(log: DataFrame, store: FeatureStore, name: str = "history") -> DataFrame:
    """Clicks, conversion rate and conversions over all earlier days for every listed key.

    One pass over the log makes the table by key and day of all key sets; its small parts then meet the log by broadcast, so
    the log itself is shuffled for the large ones only.
    """
    key_sets = catalog.HISTORY_KEYS
    lattice = store.get_or_compute(
        name, lambda: history.history_lattice(log, key_sets), identity(log, ("history", key_sets)), [history.KEY_SET]
    )
    sizes = {r[history.KEY_SET]: r["count"] for r in lattice.groupBy(history.KEY_SET).count().collect()}
    made = log
    for place, keys in enumerate(key_sets):
        made = wide.attach_checked(made, history.history_of_set(lattice, place, keys), [*keys, "date"], log, sizes.get(place, 0))
    return made


def recent_features(log: DataFrame, keys: Sequence[str], runner: Sequence[str] = ()) -> DataFrame:
    """Earlier clicks of the key within the listed seconds; ``runner`` restarts the count when it changes."""
    widths = catalog.recent_widths()
    if runner:
        return ranges.recent_counts_in_run(log, keys, runner, widths)
    return ranges.recent_counts(log, keys, widths)


def rolling_features(parts: Sequence[DataFrame], keys: Sequence[str], forward: bool = False) -> DataFrame:
    """Rolling counts of each part by itself, all parts below each other."""
    count = ranges.forward_rolling_counts if forward else ranges.rolling_counts
    widths = catalog.rolling_widths(keys, "future_click" if forward else "last_time_click")
    return relational.union_like(*[count(p, keys, widths).select(ROW_ID, *widths) for p in parts])


def user_item_features(log: DataFrame, user: str, item: str) -> DataFrame:
    """Earlier clicks of the same user and item, and later clicks of the same user."""
    recent = {f"recent_{user}_{item}_{s}": s for s in catalog.USER_ITEM_SECONDS}
    future = {f"real_feature_{user}_timerange_{s}": s for s in catalog.USER_FIELD_SECONDS}
    counted = ranges.recent_counts(log, [user, item], recent)
    return ranges.future_counts(counted, [user], future, base=log)
