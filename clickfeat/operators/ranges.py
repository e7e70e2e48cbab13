"""How many rows of the same key lie near a row in time.

A sliding frame re-reads all rows of the frame for each row. Here each row instead marks where it starts to be seen and
where it ends: +1 and -1 in the order of times. A running sum of the marks is the count, in time linear in the rows. The
rows travel with their own marks, so the counts are on the rows after one exchange, and a hot key is cut into slices,
between rows of one time as well.

``base`` is the log ``df`` was derived from row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.naming import MICROS, ROW_ID, TIME
from clickfeat.operators.slices import SlicedRows, any_null, earlier_slices, with_keys


class Mark(NamedTuple):
    """A change of the count ``offset`` microseconds from the row. Marks apply before all rows of their time, or, with
    ``beside``, right before (-1) or right after (1) the row itself in the order of row ids."""

    offset: int
    change: int
    beside: int = 0


def _marked(df: DataFrame, keys: Sequence[str], marks: dict[str, Sequence[Mark]], t: str, rid: str, row: Column) -> DataFrame:
    """One row per input row ("home", which carries ``row``) and mark; marks at one place are one."""
    places: dict[tuple[int, int], dict[str, int]] = {}
    for name, own in marks.items():
        for mark in own:
            at = places.setdefault((mark.offset, mark.beside), {})
            at[name] = at.get(name, 0) + mark.change
    zeros = [F.lit(0).cast("long").alias(n) for n in marks]
    order = lambda late, number: (F.lit(late).alias("late"), F.lit(number).alias("number"))
    entries = [F.struct(F.col(t).alias("at"), *order(1, 0), row.alias("row"), *zeros)]
    for number, ((offset, beside), changes) in enumerate(sorted(places.items())):
        late = (1, beside) if beside else (0, number)
        values = [F.lit(changes.get(n, 0)).cast("long").alias(n) for n in marks]
        entries.append(F.struct((F.col(t) + offset).alias("at"), *order(*late), F.lit(None).alias("row"), *values))
    # A row without a full key or a time has no group; only the row itself stays.
    entered = F.when(any_null([*keys, t]), F.array(entries[0])).otherwise(F.array(*entries))
    exploded = df.select(*keys, F.col(rid).alias("_rid"), F.explode(entered).alias("_m"))
    return exploded.select(
        *keys,
        F.col("_m.at").alias("_at"),
        F.col("_m.late").alias("_late"),
        "_rid",
        F.col("_m.number").alias("_number"),
        F.col("_m.row").alias("_row"),
        *[F.col(f"_m.{n}").alias(f"_change_{n}") for n in marks],
    )


def counted(
    df: DataFrame, keys: Sequence[str], marks: dict[str, Sequence[Mark]], t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """``df`` plus, for each name of ``marks``, the sum of the marks of all rows of the key that apply before the row."""
    base, keys = df if base is None else base, list(keys)
    names = [f"_change_{n}" for n in marks]
    # The key columns of the marks get names of their own, so that the row's columns can follow them.
    own = {k: f"_key_{i}" for i, k in enumerate(keys)}
    renamed = lambda log: log.withColumns({own[k]: F.col(k) for k in keys})
    grouped, order = list(own.values()), ["_at", "_late", "_rid", "_number"]
    payload = F.struct(*df.columns)
    rows = _marked(renamed(df), grouped, marks, t, rid, payload)
    other = rows if base is df else _marked(renamed(base), grouped, marks, t, rid, F.lit(None))
    sample = with_keys(renamed(base), [*grouped, t]).select(
        *grouped, F.col(t).alias("_at"), F.lit(0).alias("_late"), F.col(rid).alias("_rid"), F.lit(0).alias("_number")
    )
    # A row of the log is itself and its marks; slices are half as long again, since several may meet in one task.
    per_row = 1 + len({(m.offset, m.beside) for own_marks in marks.values() for m in own_marks})
    sliced = SlicedRows(rows, grouped, order, other, sample=sample, unique=["_rid"], per_row=2 * per_row)
    upto = sliced.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sliced.rows.withColumns({f"_run{n}": F.sum(n).over(upto) for n in names})
    run = sliced.carry(
        run,
        {f"_part{n}": F.sum(n) for n in names},
        lambda w: {f"_before{n}": F.sum(f"_part{n}").over(earlier_slices(w)) for n in names},
    )
    home = run.where(F.col("_row").isNotNull())
    total = lambda n: F.col(f"_run_change_{n}") + F.coalesce(f"_before_change_{n}", F.lit(0))
    missing = any_null(grouped) | F.col("_at").isNull()
    return home.select("_row.*", *[F.when(~missing, total(n)).alias(n) for n in marks])


def rolling_counts(
    df: DataFrame, keys: Sequence[str], widths: dict[str, int], t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Rows of the key in ``(t - width, t]``, this row and its ties included. ``widths``: name -> seconds."""
    return counted(df, keys, {n: (Mark(0, 1), Mark(w * MICROS, -1)) for n, w in widths.items()}, t, rid, base)


def forward_rolling_counts(
    df: DataFrame, keys: Sequence[str], widths: dict[str, int], t: str = TIME, rid: str = ROW_ID, base: DataFrame | None = None
) -> DataFrame:
    """Rows of the key in ``[t, t + width)``, this row and its ties included. ``widths``: name -> seconds."""
    return counted(df, keys, {n: (Mark(1 - w * MICROS, 1), Mark(1, -1)) for n, w in widths.items()}, t, rid, base)


def _one_sided(df, keys, widths, forward, mark_edge, t, rid, base):
    base = df if base is None else base

    def marks(width: int) -> tuple[Mark, Mark]:
        # Of the rows of one time, a trailing count sees those before the row and a forward count those after it.
        return (Mark(-width, 1), Mark(0, -1, -1)) if forward else (Mark(0, 1, 1), Mark(width + 1, -1))

    made = counted(df, keys, {n: marks(r * MICROS) for n, r in widths.items()}, t, rid, base)
    if not mark_edge:
        return made
    place = F.struct(*keys, t, rid)
    edge = with_keys(base, keys).agg((F.max if forward else F.min)(place)).scalar()
    return made.select(*df.columns, *[F.when(place == edge, F.lit(-1).cast("long")).otherwise(F.col(n)).alias(n) for n in widths])


def recent_counts(
    df: DataFrame,
    keys: Sequence[str],
    widths: dict[str, int],
    mark_edge: bool = False,
    t: str = TIME,
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Earlier rows of the key in ``[t - width, t]``, without this row. ``widths``: name -> seconds.

    ``mark_edge`` gives -1 to the very first row of the (keys, t, rid) order.
    """
    return _one_sided(df, keys, widths, False, mark_edge, t, rid, base)


def future_counts(
    df: DataFrame,
    keys: Sequence[str],
    widths: dict[str, int],
    mark_edge: bool = False,
    t: str = TIME,
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """Later rows of the key in ``[t, t + width]``, without this row. ``widths``: name -> seconds.

    ``mark_edge`` gives -1 to the very last row of the (keys, t, rid) order.
    """
    return _one_sided(df, keys, widths, True, mark_edge, t, rid, base)


def place_in_run(
    df: DataFrame,
    keys: Sequence[str],
    runner: Sequence[str],
    name: str = "run_place",
    t: str = TIME,
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """0-based place of the row in its run: the stretch of equal ``runner`` values, in time order within ``keys``.

    A run may cross slices. Places are global, so the start of the open run is the largest start seen so far.
    """
    sliced = SlicedRows(df, keys, [t, rid], base)
    here = F.struct(*runner)

    def placed(rows: DataFrame) -> DataFrame:
        local = rows.withColumns(
            {"_at": F.row_number().over(sliced.ordered()) - 1, "_near": F.lag(here).over(sliced.ordered())}
        )
        changed = (F.col("_at") > 0) & ~F.col("_near").eqNullSafe(here)
        return local.withColumn("_start", F.when(changed, F.col("_at")))

    rows = placed(sliced.rows)
    upto = sliced.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_start", F.max("_start").over(upto))
    order = F.struct(t, rid)
    rows = sliced.carry(
        rows,
        {
            "_n": F.count(F.lit(1)),
            "_first": F.min(F.struct(order.alias("at"), here.alias("v"))),
            "_last": F.max(F.struct(order.alias("at"), here.alias("v"))),
            "_changed": F.max("_start"),
        },
        lambda w: {
            "_before": F.coalesce(F.sum("_n").over(earlier_slices(w)), F.lit(0)),
            "_goes_on": F.coalesce(F.lag("_last").over(w)["v"].eqNullSafe(F.col("_first.v")), F.lit(False)),
        },
        lambda w: {"_opened": F.greatest(F.when(~F.col("_goes_on"), F.col("_before")), F.col("_before") + F.col("_changed"))},
        lambda w: {
            "_before": F.col("_before"),
            "_open": F.when(F.col("_goes_on"), F.max("_opened").over(earlier_slices(w))).otherwise(F.col("_before")),
        },
        source=placed(sliced.base_rows),
    )
    before = F.coalesce("_before", F.lit(0))
    start = F.coalesce(F.col("_start") + before, "_open", F.lit(0))
    return sliced.finish(rows, {name: F.col("_at") + before - start})


def recent_counts_in_run(
    df: DataFrame,
    keys: Sequence[str],
    runner: Sequence[str],
    widths: dict[str, int],
    mark_edge: bool = False,
    t: str = TIME,
    rid: str = ROW_ID,
    base: DataFrame | None = None,
) -> DataFrame:
    """As ``recent_counts``, but another ``runner`` value in between starts the count anew.

    Both the rows in range and the rows of the run end right before this row, so the smaller number counts.
    """
    base = df if base is None else base
    counted = recent_counts(df, keys, widths, mark_edge, t, rid, base)
    placed = place_in_run(counted, keys, runner, "_in_run", t, rid, base)
    return placed.select(*df.columns, *[F.least(n, "_in_run").cast("long").alias(n) for n in widths])
