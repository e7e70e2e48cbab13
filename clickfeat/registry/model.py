"""Queries: training-table and model steps."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickfeat.functions.scalars import NOT_PREDICTORS, categoricals, predictors
from clickfeat.naming import ROW_ID
from clickfeat.operators import groups, relational
from clickfeat.operators.ordered import neighbour
from clickfeat.plans import catalog, model, wide
from clickfeat.registry.base import query
from clickfeat.sources.clicklog import events_as_clicks
from clickfeat.sources.store import run_store

PARAMS = model.SECOND_PARAMS


def model_parts(spark, sf_dir):
    """The second training table cut into train, validation and scored days, with predictor names."""
    log, store = events_as_clicks(spark, sf_dir), run_store(spark)
    columns = [ROW_ID, "app", "channel", "device", "os", "hour", "day", "ip", "click_time", "is_attributed"]
    table = store.get_or_compute("model-table", lambda: wide.build(log, catalog.SELECTED, store, "model", columns=columns))
    names = predictors(table, [*NOT_PREDICTORS, ROW_ID])
    parts = {
        "train": relational.between_days(table, 1, 16),
        "validate": relational.between_days(table, 17, 22),
        "labelled": relational.between_days(table, 1, 22),
        "scored": relational.between_days(table, 23, 31).withColumn("click_id", F.col(ROW_ID)),
    }
    return parts, names, categoricals(table)


def validated(spark, sf_dir):
    """The validated fit of the first seed, and what it was made of."""
    parts, names, categorical = model_parts(spark, sf_dir)
    return model.fit(parts["train"], names, categorical, PARAMS, validate=parts["validate"]), parts


# A label that follows one column, so that the right answer can be written in SQL. Its first tree is right for every row, and
# the fit ends when thirty more bring no better one.
RULE = PARAMS


def rule_parts(spark, sf_dir):
    log = events_as_clicks(spark, sf_dir).withColumn("is_attributed", (F.col("os") >= 3).cast("int"))
    table = log.select(ROW_ID, "app", "channel", "device", "os", "hour", "day", "ip", "click_time", "is_attributed")
    parts = [relational.between_days(table, *days) for days in ((1, 16), (17, 22), (23, 31))]
    return parts, ["app", "channel", "device", "os", "hour"]


@query(
    "model_matrix",
    """ SELECT rid, is_attributed AS label, CASE WHEN is_attributed = 1 THEN 200.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
        hour::DOUBLE AS f0, coalesce(epoch_us(click_time) - lag(t) OVER (PARTITION BY ip ORDER BY t, rid), -1)::DOUBLE AS f1,
        (dense_rank() OVER (ORDER BY channel) - 1)::DOUBLE AS f2 FROM clicks""",
)
def model_matrix(spark, sf_dir):
    log = events_as_clicks(spark, sf_dir)
    table = neighbour(log, ["ip"], "t", "_prev_t", -1).withColumn("since", F.col("t") - F.col("_prev_t"))
    made = model.matrix(model.weighted(table, 200.0), ["hour", "since", "channel"], ["channel"])
    values = vector_to_array(model.FEATURES)
    return made.select(
        "rid", F.col("is_attributed").alias("label"), F.col(model.WEIGHT).alias("weight"),
        *[values[i].alias(f"f{i}") for i in range(3)],
    )


@query(
    "rate_metrics",
    """, rated AS (SELECT is_attributed AS y, avg(is_attributed) OVER (PARTITION BY app, channel) AS p FROM clicks),
       clipped AS (SELECT y, p, least(greatest(p, 1e-15), 1 - 1e-15) AS q FROM rated),
       placed AS (SELECT y, q, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS place FROM clipped)
       SELECT round((sum(place) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) AS auc,
       round(avg(-y * ln(q) - (1 - y) * ln(1 - q)), 6) AS logloss FROM placed""",
)
def rate_metrics(spark, sf_dir):
    rated = groups.group_stat(events_as_clicks(spark, sf_dir), ["app", "channel"], "is_attributed", "mean", "score")
    return model.metrics(rated).select(F.round("auc", 6).alias("auc"), F.round("logloss", 6).alias("logloss"))


@query("model_validation")
def model_validation(spark, sf_dir):
    """Metrics of the validated fit on its validation scores, read back from their file."""
    found, parts = validated(spark, sf_dir)
    scores = model.write_validation(found, parts["validate"], run_store(spark).path("validation"))
    return model.metrics(scores).withColumn("best_round", F.lit(found.best_round))


@query("model_importance")
def model_importance(spark, sf_dir):
    found, parts = validated(spark, sf_dir)
    return model.write_importance(found, run_store(spark).path("importance"))


@query("model_seed_average")
def model_seed_average(spark, sf_dir):
    parts, names, categorical = model_parts(spark, sf_dir)
    return model.seed_average(parts["train"], parts["validate"], parts["labelled"], parts["scored"], names, categorical, PARAMS)


@query("model_report")
def model_report(spark, sf_dir):
    """Scores projected onto the reported clicks by their columns and written as CSV."""
    found, parts = validated(spark, sf_dir)
    scored = found.score(parts["scored"])
    clicks = parts["scored"].drop("is_attributed")
    return model.write_report(clicks, scored, run_store(spark).path("report"), relational.REPORT_KEYS)


@query(
    "model_rule_validation",
    """ SELECT rid, CASE WHEN os >= 3 THEN 1 ELSE 0 END AS is_attributed, CASE WHEN os >= 3 THEN 1 ELSE 0 END AS predicted
        FROM clicks WHERE day BETWEEN 17 AND 22""",
)
def model_rule_validation(spark, sf_dir):
    """Validation scores of a learnable label, read back from their file, from a half on."""
    (train, validate, _), names = rule_parts(spark, sf_dir)
    found = model.fit(train, names, ["channel"], RULE, validate=validate)
    scores = model.write_validation(found, validate, run_store(spark).path("rule-validation"))
    return scores.select("rid", "is_attributed", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(
    "model_rule_importance",
    """ SELECT * FROM (VALUES ('os', true, 100.0::DOUBLE), ('app', false, 0.0::DOUBLE), ('channel', false, 0.0::DOUBLE),
        ('device', false, 0.0::DOUBLE), ('hour', false, 0.0::DOUBLE)) v(feature, has_splits, gain)""",
)
def model_rule_importance(spark, sf_dir):
    """The one column that the label follows has all splits and all of the gain."""
    (train, validate, _), names = rule_parts(spark, sf_dir)
    found = model.fit(train, names, ["channel"], replace(RULE, column_share=1.0), validate=validate)
    made = model.write_importance(found, run_store(spark).path("rule-importance"))
    return made.select("feature", (F.col("split") > 0).alias("has_splits"), F.round("gain", 6).alias("gain"))


@query("model_rule_rounds", " SELECT 1 AS best_round, true AS separates")
def model_rule_rounds(spark, sf_dir):
    """The wait for a better round ends the fit of a learnable label long before its thousand rounds."""
    (train, validate, _), names = rule_parts(spark, sf_dir)
    found = model.fit(train, names, ["channel"], RULE, validate=validate)
    scored = model.metrics(found.score(validate))
    return scored.select(F.lit(found.best_round).alias("best_round"), (F.col("auc") == 1.0).alias("separates"))


@query(
    "category_codes_by_rate",
    """, r AS (SELECT ip, avg(is_attributed) AS rate FROM clicks GROUP BY ip)
       SELECT ip, row_number() OVER (ORDER BY rate, ip) - 1 AS code FROM r""",
)
def category_codes_by_rate(spark, sf_dir):
    """Codes of a category in the order of its conversion rate."""
    return model.category_codes(events_as_clicks(spark, sf_dir), "ip", "is_attributed").select("ip", F.col("code").cast("long").alias("code"))


@query(
    "model_rule_seed_average",
    " SELECT rid AS click_id, CASE WHEN os >= 3 THEN 1 ELSE 0 END AS predicted FROM clicks WHERE day >= 23",
)
def model_rule_seed_average(spark, sf_dir):
    """All ten seeds, each validated, refitted on all labelled days and scored."""
    (train, validate, scored), names = rule_parts(spark, sf_dir)
    both = relational.union_like(train, validate)
    made = model.seed_average(train, validate, both, scored.withColumn("click_id", F.col(ROW_ID)), names, ["channel"], RULE)
    return made.select("click_id", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(
    "model_rule_report",
    " SELECT rid AS click_id, CASE WHEN os >= 3 THEN 1 ELSE 0 END AS is_attributed FROM clicks WHERE day >= 23",
)
def model_rule_report(spark, sf_dir):
    """The written report of a learnable label, from a half on."""
    (train, validate, scored), names = rule_parts(spark, sf_dir)
    found = model.fit(train, names, ["channel"], RULE, validate=validate)
    clicks = scored.drop("is_attributed").withColumn("click_id", F.col(ROW_ID))
    made = model.write_report(clicks, found.score(scored), run_store(spark).path("rule-report"), relational.REPORT_KEYS)
    return made.select("click_id", (F.col("is_attributed") >= 0.5).cast("int").alias("is_attributed"))


@query(
    "averaged_scores",
    """, a AS (SELECT rid AS click_id, avg(is_attributed) OVER (PARTITION BY app) AS s FROM clicks
       UNION ALL SELECT rid, avg(is_attributed) OVER (PARTITION BY channel) FROM clicks)
       SELECT click_id, round(avg(s), 6) AS score FROM a GROUP BY click_id""",
)
def averaged_scores(spark, sf_dir):
    log = events_as_clicks(spark, sf_dir).withColumn("click_id", F.col(ROW_ID))
    runs = [groups.group_stat(log, [key], "is_attributed", "mean", "score") for key in ("app", "channel")]
    return model.average_scores(runs).select("click_id", F.round("score", 6).alias("score"))
