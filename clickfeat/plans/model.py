"""Training-table steps on Spark ML: category codes, matrix, boosted-tree fit, importance, scores, metrics and report."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickfeat.operators.ordered import place_in_group, top_rows
from clickfeat.operators.relational import project_scores, union_like
from clickfeat.operators.slices import salted_join
from clickfeat.plans import boosting
from clickfeat.plans.wide import broadcast_rows
from clickfeat.session import ensure_checkpoint_dir
from clickfeat.sources.store import FeatureStore, run_store, write_csv

SEEDS = tuple(range(42, 52))
REFIT_FACTOR = 1.46
TOP_FEATURES = 60
# No feature value is negative, so trees can tell a missing value apart.
MISSING = -1.0
LABEL, WEIGHT, FEATURES, SCORE = "is_attributed", "_weight", "_features", "score"
# Idle rounds after which a validated fit stops. Fixed value.
PATIENCE = 30
# Rows that one task of a fit takes; a fit is many short jobs, so small tables are read by few tasks. Larger ones are read by
# twice as many tasks as there are cores, until a task would take more than MOST_ROWS_PER_TASK rows.
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 50_000, 1_000_000
# Scores of one round are counted in so many bins for its area under the curve; so many rounds are counted at once.
BINS, ROUNDS_AT_ONCE = boosting.BINS, 64


@dataclass(frozen=True)
class FitParams:
    """Settings of a boosted-tree fit; the two named sets are fixed values of the modelling runs."""

    positive_weight: float = 200.0
    max_depth: int = 6
    learning_rate: float = 0.1
    row_share: float = 0.75
    column_share: float = 0.75
    min_rows: int = 1
    max_bins: int = 155
    rounds: int = 10_000
    # Validation measures that are watched; the first one that has waited long enough ends the fit.
    metrics: tuple[str, ...] = ("auc", "logloss")


WIDE_PARAMS = FitParams()
SECOND_PARAMS = FitParams(
    positive_weight=402.7, max_depth=4, row_share=0.7, column_share=0.9, min_rows=100, max_bins=256, rounds=1_000, metrics=("auc",)
)


def weighted(df: DataFrame, positive_weight: float, label: str = LABEL) -> DataFrame:
    """Row weight: ``positive_weight`` for conversions, 1 for all others."""
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, positive_weight).otherwise(1.0))


def category_codes(df: DataFrame, column: str, label: str | None = None) -> DataFrame:
    """(column, code): the values of a column numbered from 0 on in the order of their weighted label rate, ties and tables
    without a label in the order of the values. NULL has no code. The order is cut into slices; no task sees all values."""
    present = df.where(F.col(column).isNotNull())
    if label is None:
        rated = present.select(column, F.lit(0.0).alias("_rate")).distinct()
    else:
        # Whole sums, so that the order does not depend on the order of addition.
        share = F.try_divide(F.sum(F.when(F.col(label) == 1, F.lit(1)).otherwise(0)), F.count(F.lit(1)))
        rated = present.groupBy(column).agg(share.alias("_rate"))
    placed = place_in_group(rated, [], ["_rate", column], "_at", "_of")
    return placed.select(column, F.col("_at").cast("double").alias("code"))


@dataclass
class Encoder:
    """Turns predictor columns into one vector; categorical columns become codes of written tables."""

    predictors: list[str]
    categorical: list[str]
    codes: dict[str, DataFrame]
    few: dict[str, bool]

    @classmethod
    def learned(cls, known: DataFrame, predictors: Sequence[str], categorical: Sequence[str], label: str | None, store: FeatureStore) -> Encoder:
        """Codes of all values in ``known``; other values, as NULL, become ``MISSING``."""
        listed = [c for c in predictors if c in categorical]
        codes = {c: store.get_or_compute(f"codes-{c}", lambda c=c: category_codes(known, c, label)) for c in listed}
        few = {c: table.count() <= broadcast_rows(known.sparkSession) for c, table in codes.items()}
        return cls(list(predictors), list(categorical), codes, few)

    def apply(self, df: DataFrame) -> DataFrame:
        """The rows with their vector as ``_features``."""
        made = df
        for c, table in self.codes.items():
            named = table.withColumnRenamed("code", f"_{c}_code")
            # Rows of a very common value are spread by their other predictors.
            made = made.join(F.broadcast(named), c, "left") if self.few[c] else salted_join(made, named, [c], self.predictors, df)
        values = {f"_{c}_value": F.coalesce(F.col(f"_{c}_code" if c in self.codes else c).cast("double"), F.lit(MISSING)) for c in self.predictors}
        assembler = VectorAssembler(inputCols=list(values), outputCol=FEATURES, handleInvalid="keep")
        return assembler.transform(made.withColumns(values)).select(*df.columns, FEATURES)


def matrix(df: DataFrame, predictors: Sequence[str], categorical: Sequence[str] = (), label: str | None = None) -> DataFrame:
    """The table with one feature vector per row; categories are coded by label rate, without a label by value."""
    return Encoder.learned(df, predictors, categorical, label, run_store(df.sparkSession)).apply(df)


def written_matrix(df: DataFrame, encoder: Encoder, params: FitParams, store: FeatureStore, name: str) -> DataFrame:
    """Vector, label and weight of the rows, written once for all fits on them."""
    rows = encoder.apply(weighted(df.select(*dict.fromkeys([*encoder.predictors, LABEL])), params.positive_weight))
    made = store.get_or_compute(name, lambda: rows.select(FEATURES, F.col(LABEL).cast("double").alias(LABEL), WEIGHT))
    return made.coalesce(fit_tasks(made.count(), df.sparkSession.sparkContext.defaultParallelism))


def fit_tasks(rows: int, cores: int) -> int:
    """Tasks of each step of a fit. A step of a round is a job of its own, so more tasks than the cores need only add waiting."""
    return max(min(rows // ROWS_PER_TASK + 1, 2 * cores), rows // MOST_ROWS_PER_TASK + 1)


def nodes(trees: GBTClassificationModel) -> DataFrame:
    """All nodes of a fitted ensemble: ``tree``, ``node``, ``prediction``, ``feature`` (of the split, NULL in a leaf)."""
    path = run_store(SparkSession.active()).path("trees")
    trees.write().save(path)
    found = SparkSession.active().read.parquet(f"{path}/data")
    inner = F.col("nodeData.leftChild") >= 0
    return found.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.prediction").alias("prediction"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
    )


def first_trees(trees: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """The ensemble of the first ``count`` trees; the same as a fit of so many rounds with the same seed."""
    context, whole = SparkSession.active().sparkContext, trees._java_obj
    classes, gateway = context._jvm.org.apache.spark.ml, context._gateway
    kept = gateway.new_array(classes.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(gateway.jvm.double, count)
    all_trees, all_weights = whole.trees(), whole.treeWeights()
    for i in range(count):
        kept[i], weights[i] = all_trees[i], all_weights[i]
    made = classes.classification.GBTClassificationModel(whole.uid(), kept, weights, whole.numFeatures(), whole.numClasses())
    made = GBTClassificationModel(whole.copyValues(made, whole.extractParamMap()))
    made._transfer_params_from_java()
    return made


def round_measures(trees: GBTClassificationModel, held_out: DataFrame) -> list[dict[str, float]]:
    """Area under the ROC curve and log-loss on ``held_out`` after every round.

    Every row goes through the trees once; its leaves give the sums of all rounds. A task counts the scores of a round in
    ``BINS`` steps by label, so what is exchanged grows with rounds and bins, not with rows. Scores in one step count as ties.
    """
    leaves = nodes(trees).where(F.col("feature").isNull()).orderBy("tree", "node").select("tree", "prediction").toPandas()
    place = leaves.groupby("tree").cumcount()
    values = np.zeros((trees.getNumTrees, int(place.max()) + 1))
    values[leaves["tree"], place] = leaves["prediction"]
    values *= np.array(trees.treeWeights)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = batch.column("leaf").flatten().to_numpy().astype(int).reshape(batch.num_rows, -1)
            label = batch.column("label").to_numpy() == 1
            margin = np.zeros(batch.num_rows)
            for low in range(0, leaf.shape[1], ROUNDS_AT_ONCE):
                here = np.arange(low, min(low + ROUNDS_AT_ONCE, leaf.shape[1]))
                margins = margin[:, None] + np.cumsum(values[here, leaf[:, here]], axis=1)
                margin = margins[:, -1]
                step = np.floor((margins / (1 + np.abs(margins)) + 1) / 2 * (BINS - 1)).astype(np.int64)
                loss = np.logaddexp(0, np.where(label[:, None], -2 * margins, 2 * margins))
                cell = (np.arange(len(here)) * BINS + step).ravel()
                size = len(here) * BINS
                every = np.bincount(cell, minlength=size)
                ones = np.bincount(cell, np.repeat(label, len(here)), size).astype(np.int64)
                losses = np.bincount(cell, loss.ravel(), size)
                full = np.flatnonzero(every)
                columns = [low + full // BINS, full % BINS, ones[full], (every - ones)[full], losses[full]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["round", "step", "ones", "zeros", "loss"])

    scored = trees.copy().setLeafCol("_leaf").transform(held_out.select(FEATURES, LABEL))
    told = scored.select(vector_to_array("_leaf").alias("leaf"), F.col(LABEL).cast("double").alias("label"))
    binned = told.mapInArrow(run, "round long, step long, ones long, zeros long, loss double").groupBy("round", "step")
    summed = binned.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), F.sum("loss").alias("loss"))
    below = Window.partitionBy("round").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.col("ones") * (F.coalesce(F.sum("zeros").over(below), F.lit(0)) + F.col("zeros") / 2)
    rows = summed.withColumn("won", beaten).groupBy("round").agg(
        F.try_divide(F.sum("won"), F.sum("ones") * F.sum("zeros").cast("double")).alias("auc"),
        (F.sum("loss") / F.sum(F.col("ones") + F.col("zeros"))).alias("logloss"),
    )
    return [{"auc": r["auc"], "logloss": r["logloss"]} for r in rows.orderBy("round").collect()]


@dataclass
class FittedModel:
    encoder: Encoder
    trees: GBTClassificationModel

    @property
    def predictors(self) -> list[str]:
        return self.encoder.predictors

    @property
    def categorical(self) -> list[str]:
        return self.encoder.categorical

    @property
    def best_round(self) -> int:
        return self.trees.getNumTrees

    def score(self, df: DataFrame) -> DataFrame:
        """The rows with the conversion probability as ``score``."""
        found = self.trees.transform(self.encoder.apply(df))
        return found.select(*df.columns, vector_to_array("probability")[1].alias(SCORE))

    def importance(self, top: int = TOP_FEATURES) -> DataFrame:
        """Number of splits and share of the gain per feature in percent, largest gain first."""
        gains = self.trees.featureImportances.toArray()
        rows = [(i, name, float(100.0 * gain)) for i, (name, gain) in enumerate(zip(self.predictors, gains))]
        named = SparkSession.active().createDataFrame(rows, "_at int, feature string, gain double")
        splits = nodes(self.trees).where(F.col("feature").isNotNull()).groupBy(F.col("feature").alias("_at")).agg(F.count(F.lit(1)).alias("split"))
        table = named.join(splits, "_at", "left").select("feature", F.coalesce("split", F.lit(0)).alias("split"), "gain")
        return top_rows(table, [F.col("gain").desc(), F.col("feature")], top)


def best_of(losses: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """The best round (from 1) before ``patience`` rounds without a better one, and whether that wait is over."""
    best = 0
    for number, loss in enumerate(losses):
        if loss < losses[best]:
            best = number
        elif number - best >= patience:
            return best + 1, True
    return best + 1, False


def best_round(measures: Sequence[dict[str, float]], metrics: Sequence[str], patience: int = PATIENCE) -> tuple[int, bool]:
    """As ``best_of`` for several measures: the one whose wait ends first decides, the first listed one if none does."""
    found = []
    for place, name in enumerate(metrics):
        values = [m[name] if m[name] is not None else 0.0 for m in measures]
        best, over = best_of([-v for v in values] if name == "auc" else values, patience)
        found.append((not over, best if over else 0, place, best, over))
    return min(found)[3:]


def estimator(params: FitParams, seed: int) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=params.rounds,
        maxDepth=params.max_depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        minInstancesPerNode=params.min_rows,
        maxBins=params.max_bins,
        seed=seed,
    )


def fit_trees(
    train: DataFrame, params: FitParams, seed: int, validate: DataFrame | None = None, patience: int = PATIENCE
) -> GBTClassificationModel:
    """Boosted trees on written matrices. With ``validate`` the trees up to the best round before ``patience`` idle ones are kept.

    Spark ML fits a fixed number of rounds, so a few more than the wait are fitted first, and twice as
    many until the wait is over or ``params.rounds`` is reached. The kept trees are cut from the last fit.
    """
    ensure_checkpoint_dir(train.sparkSession)
    trees = estimator(params, seed)
    if validate is None:
        return trees.fit(train)
    rounds = min(params.rounds, patience + 2)
    while True:
        model = trees.setMaxIter(rounds).fit(train)
        best, over = best_round(round_measures(model, validate), params.metrics, patience)
        if over or rounds == params.rounds:
            return first_trees(model, best)
        rounds = min(params.rounds, 2 * rounds)


def fit(
    train: DataFrame,
    predictors: Sequence[str],
    categorical: Sequence[str] = (),
    params: FitParams = WIDE_PARAMS,
    seed: int = SEEDS[0],
    validate: DataFrame | None = None,
    patience: int = PATIENCE,
) -> FittedModel:
    """Boosted trees. With ``validate`` rows the number of rounds is the best one found before ``patience`` rounds without
    a better value of one of ``params.metrics``, or the best of ``params.rounds``. Categories are coded by the label rate of ``train``."""
    store = run_store(train.sparkSession)
    encoder = Encoder.learned(train, predictors, categorical, LABEL, store)
    rows = written_matrix(train, encoder, params, store, "train-matrix")
    held_out = None if validate is None else written_matrix(validate, encoder, params, store, "validate-matrix")
    return FittedModel(encoder, fit_trees(rows, params, seed, held_out, patience))


def refit_rounds(best: int) -> int:
    """Rounds of the fit on all labelled rows: more than the validated best."""
    return max(1, round(best * REFIT_FACTOR))


def refit(found: FittedModel, labelled: DataFrame, params: FitParams, seed: int) -> FittedModel:
    """Fit on all labelled rows with more rounds than the validated best."""
    return fit(labelled, found.predictors, found.categorical, replace(params, rounds=refit_rounds(found.best_round)), seed)


def average_scores(runs: Sequence[DataFrame], click_id: str = "click_id", score: str = SCORE) -> DataFrame:
    """Mean score per click over several runs."""
    stacked = union_like(*[r.select(click_id, score) for r in runs])
    return stacked.groupBy(click_id).agg(F.avg(score).alias(score))


def seed_average(
    train: DataFrame,
    validate: DataFrame,
    labelled: DataFrame,
    scored: DataFrame,
    predictors: Sequence[str],
    categorical: Sequence[str] = (),
    params: FitParams = SECOND_PARAMS,
    seeds: Sequence[int] = SEEDS,
    click_id: str = "click_id",
) -> DataFrame:
    """Validate, refit and score once per seed; the mean score per click.

    Codes and matrices are written once and shared by all seeds, whose fits run side by side; a seed has the trees that
    ``fit_trees`` gives it. The scores of all seeds come from one pass and are written once.
    """
    ensure_checkpoint_dir(train.sparkSession)
    store = run_store(train.sparkSession)
    seen = Encoder.learned(train, predictors, categorical, LABEL, FeatureStore(train.sparkSession, store.path("train")))
    every = Encoder.learned(labelled, predictors, categorical, LABEL, FeatureStore(train.sparkSession, store.path("labelled")))
    rows, held_out = (written_matrix(df, seen, params, store, name) for df, name in ((train, "train-matrix"), (validate, "validate-matrix")))
    all_rows = written_matrix(labelled, every, params, store, "labelled-matrix")

    def stop(measures: Sequence[dict[str, float]]) -> tuple[int, bool]:
        return best_round(measures, params.metrics)

    trees = estimator(params, seeds[0])
    found = boosting.fit(rows, held_out, trees, params.positive_weight, seeds, [params.rounds] * len(seeds), params.metrics, stop)
    again = [refit_rounds(len(of_seed)) for of_seed in found.trees]
    final = boosting.fit(all_rows, None, trees, params.positive_weight, seeds, again)
    scores = store.get_or_compute("scores", lambda: final.scores(every.apply(scored), FEATURES, click_id))
    return average_scores([scores.select(click_id, F.col(f"score_{place}").alias(SCORE)) for place in range(len(seeds))], click_id)


def metrics(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """One row: area under the ROC curve and log-loss."""
    auc = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol="_y", metricName="areaUnderROC", numBins=0
    ).evaluate(scored.select(F.col(label).cast("double").alias("_y"), F.col(score).cast("double").alias(score)))
    # Probabilities are kept off 0 and 1, where the logarithm has no value.
    p = F.least(F.greatest(F.col(score), F.lit(1e-15)), F.lit(1 - 1e-15))
    y = F.col(label)
    return scored.agg(F.lit(auc).alias("auc"), F.avg(-y * F.ln(p) - (1 - y) * F.ln(1 - p)).alias("logloss"))


def write_report(clicks: DataFrame, scored: DataFrame, path: str, on: Sequence[str], score: str = SCORE) -> DataFrame:
    """Scores of the reported clicks written as a CSV of click id and predicted label, and read back."""
    report = project_scores(clicks, scored, score, on).withColumnRenamed(score, LABEL)
    return written(report, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as CSV and read back with its own types."""
    write_csv(df, path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def write_importance(found: FittedModel, path: str, top: int = TOP_FEATURES) -> DataFrame:
    """The importance table as CSV."""
    return written(found.importance(top), path)


def write_validation(found: FittedModel, validate: DataFrame, path: str, row_id: str = "rid") -> DataFrame:
    """Scores of the validation rows with their labels, as CSV."""
    return written(found.score(validate).select(row_id, LABEL, SCORE), path)
