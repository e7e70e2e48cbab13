"""Mixing sources to target weights: hash-random order inside each source, prefix sums, exact budgets, epochs.

Every row gets a key that is a seeded hash of its id. A source is cut into slices of about ``SLICE_ROWS`` rows by key
range (the keys are uniform, so the bounds need no sampling). A source's budget is its target rounded down; it takes whole
epochs of the source, then rows in key order until the budget is met, the last one in part.

Prefix sums over the slices tell in which of them a budget ends; only the rows of that slice are sorted, as one line per
id and size with its sum, and where many rows share id and size the same is done once more over a hash of the row. So a hot
source, or an id that many rows share, is never sorted in one task, and texts are not shuffled: every row compares its
place with the end of its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored, without

SLICE_ROWS = 10_000
MAX_EPOCHS = 3
SEED = "mix-1"


def order_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, weight, source_size) plus ``target``: shares of the whole by weight, each at most
    ``max_epochs`` times the source's size, what is cut off going to the others by weight.

    Sources sorted by the size a unit of weight could give fill up in that order; the first one that need not be cut
    fixes the share of a unit of weight for itself and all later ones. All sums are exact integers. The table has one
    row per source, so its order is one small task.
    """
    exact = "decimal(38,0)"
    before = Window.orderBy("_ratio", "_place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("_ratio", "_place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    ranked = (
        sources.withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(after))
        .withColumn("_free", F.col("_left").cast(exact) * F.col("weight") <= F.col("_cap").cast(exact) * F.col("_weights"))
        .withColumn("_first", F.min(F.when(F.col("_free"), F.struct("_ratio", "_place", "_left", "_weights"))).over(every))
    )
    cut = F.struct("_ratio", "_place") < F.struct(F.col("_first._ratio"), F.col("_first._place"))
    share = (F.col("weight") * F.col("_first._left")).cast("double") / F.col("_first._weights")
    target = F.when(cut, F.col("_cap").cast("double")).otherwise(share)
    return ranked.withColumn("target", target).select("source", "weight", "source_size", "target")


def cycle_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, over the sources by code point, NULL last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", ((place - 1) % 3 + 1).cast("long"))


def _cut(groups: DataFrame, order: list[str]) -> DataFrame:
    """The row of each source in which its budget ends, of ``groups`` (_source, *order, _sum, _rest): the first in order
    at which the running sum exceeds ``_rest``. What earlier rows of the source take is subtracted from ``_rest``."""
    upto = Window.partitionBy("_source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = groups.withColumn("_upto", F.sum("_sum").over(upto))
    ends = ran.where((F.col("_rest") < F.col("_upto")) & (F.col("_rest") >= F.col("_upto") - F.col("_sum")))
    return ends.select("_source", *order, (F.col("_rest") - F.col("_upto") + F.col("_sum")).alias("_rest"))


def mix(docs: DataFrame, size: Column, weigh=cycle_weights, seed: str = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` (doc_id, source, ...) plus ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes.

    ``weigh`` maps the table (source, source_size, source_rows) to one with a ``weight``. NULL source is a source of its
    own; NULL ids share one place in the order, and rows of one id follow each other by size, then by a hash of all
    columns. Rows of size 0 take 0. An empty table gives an empty result. Columns already named like one of the four are
    replaced. Columns must be sortable (no maps).
    """
    added = ["size", "source_size", "target", "taken"]
    keep = without(docs, added)
    rows = docs.select(F.struct(*keep).alias("_row"), docs["doc_id"].alias("_id"), docs["source"].alias("source"), size.alias("size"))
    rows = rows.withColumn("_key", order_key(F.col("_id"), seed)).withColumn("_tie", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_row"), 1))
    narrow = stored(rows.select("source", "_key", "size", "_tie"), "mix-sizes")
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    weighed = stored(weigh(sums), "mix-weights")
    budget = F.floor("target").cast("long")
    slices_of = weighed.select(F.col("source").alias("_of"), F.ceil(F.col("source_rows") / SLICE_ROWS).alias("_slices"))
    plan = targets(weighed, max_epochs).join(slices_of, F.col("source").eqNullSafe(F.col("_of")))
    plan = stored(
        plan.select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            F.greatest(F.lit(1), "_slices").cast("long").alias("_slices"),
            F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long").alias("_epochs"),
            F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).alias("_rest"),
        ),
        "mix-plan",
    )
    sourced = F.col("source").eqNullSafe(F.col("_source"))
    high = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    sliced = narrow.join(plan.select("_source", "_slices"), sourced).withColumn("_slice", F.shiftright(high * F.col("_slices"), 32))

    # 1: the slice of keys in which a source's budget ends.
    by_slice = sliced.groupBy("_source", "_slice").agg(F.sum("size").alias("_sum"))
    rests = plan.select(F.col("_source").alias("_of"), "_rest")
    end = _cut(by_slice.join(rests, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of"), ["_slice"])
    end = stored(end.select(F.col("_source").alias("_of"), F.col("_slice").alias("_end_slice"), "_rest"), "mix-end-slices")
    # 2: the id and size in that slice.
    here = sliced.join(end, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_end_slice")))
    here = stored(here.select("_source", "_key", "size", "_tie", "_rest"), "mix-end-rows")
    classes = here.groupBy("_source", "_key", "size").agg(
        F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"), F.first("_rest").alias("_rest")
    )
    classes = stored(classes, "mix-end-classes")
    named = [F.col(c).alias(f"_end{c}") for c in ("_source", "_key")] + [F.col("size").alias("_end_size")]
    end = stored(_cut(classes.drop("_n"), ["_key", "size"]).select(*named, "_rest"), "mix-end-class")
    same_class = (
        F.col("_source").eqNullSafe(F.col("_end_source")) & (F.col("_key") == F.col("_end_key")) & (F.col("size") == F.col("_end_size"))
    )
    # 3: of its rows, which may be a third of the source, the slice of hashes, 4: the hash.
    counts = classes.join(end.drop("_rest"), same_class).select(
        "_end_source", "_end_key", "_end_size", F.ceil(F.col("_n") / SLICE_ROWS).cast("long").alias("_slices")
    )
    tied = here.drop("_rest").join(end, same_class).drop("_source", "_key", "size")
    tied = tied.join(counts.select(F.col("_end_source").alias("_of"), "_slices"), F.col("_end_source").eqNullSafe(F.col("_of")))
    bits = F.shiftright(F.col("_tie"), 32)
    tied = tied.withColumn("_slice", F.shiftright(bits * F.col("_slices"), 31)).withColumnRenamed("_end_source", "_source")

    def sums_by(df: DataFrame, *order: str) -> DataFrame:
        return df.groupBy("_source", *order).agg(F.sum("_end_size").alias("_sum"), F.first("_rest").alias("_rest"))

    first = _cut(sums_by(tied, "_slice"), ["_slice"])
    first = first.select(F.col("_source").alias("_in"), F.col("_slice").alias("_end_slice"), "_rest")
    inner = tied.drop("_rest").join(first, F.col("_source").eqNullSafe(F.col("_in")) & (F.col("_slice") == F.col("_end_slice")))
    last = _cut(sums_by(inner, "_tie"), ["_tie"])
    last = last.select(F.col("_source").alias("_of"), F.col("_tie").alias("_end_tie"), F.col("_rest").alias("_end_rest"))
    ends = stored(end.drop("_rest").join(last, F.col("_end_source").eqNullSafe(F.col("_of"))).drop("_of"), "mix-ends")

    # A row before the end takes its size once more, a row behind it does not.
    plan = plan.drop("_slices", "_rest").join(ends, F.col("_source").eqNullSafe(F.col("_end_source")), "left")
    plan = stored(plan.drop("_end_source"), "mix-bounds")
    placed = rows.join(plan, sourced)
    end = F.struct(F.col("_end_key"), F.col("_end_size"), F.col("_end_tie"))
    at = F.struct("_key", "size", "_tie")
    ended = F.col("_end_key").isNotNull()
    whole = placed.where(~(ended & (at == end))).withColumn("_part", F.when(ended & (at < end), F.col("size")).otherwise(0))
    # Rows at the end itself are equal in all columns: they are counted, and given out again one by one.
    equal = placed.where(ended & (at == end)).groupBy("_row", "source", "size", "source_size", "target", "_epochs", "_end_rest")
    before = Window.partitionBy("source").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    equal = equal.agg(F.count(F.lit(1)).alias("_n")).withColumn("_behind", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    block = F.lit(SLICE_ROWS).cast("long")
    equal = equal.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, block)))
    equal = equal.repartition("source", "_from")
    equal = equal.withColumn("_place", F.explode(F.sequence("_from", F.least(F.col("_from") + block, "_n") - 1)))
    equal = equal.withColumn("_place", F.col("_place") + F.col("_behind"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_end_rest") - F.col("_place") * F.col("size")))
    equal = equal.withColumn("_part", part)
    taken = (F.col("_epochs") * F.col("size") + F.col("_part")).cast("long").alias("taken")
    out = [df.select("_row", "size", "source_size", "target", taken) for df in (whole, equal)]
    return out[0].unionByName(out[1]).select("_row.*", "size", "source_size", "target", "taken")


def copies(mixed: DataFrame) -> DataFrame:
    """The mix as rows: each row of ``mix`` once per whole epoch it takes part in, and a copy cut to its first words
    where the budget ends inside it. The four added columns are dropped; ``n_chars``, if present, follows the text."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    word = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(word), F.lit(0)), 1, F.col("_rest").cast("int")), "")
    takes = F.concat(
        F.array_repeat(F.lit(0).cast("long"), F.col("_whole")),
        F.when(F.col("_rest") > 0, F.array(F.col("_rest"))).otherwise(F.array().cast("array<bigint>")),
    )
    out = mixed.withColumn("_whole", whole).withColumn("_rest", rest).withColumn("_rest", F.explode(takes))
    out = out.withColumn("text", F.when(F.col("_rest") > 0, head).otherwise(F.col("text")))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("_rest") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop("_whole", "_rest", "size", "source_size", "target", "taken")
