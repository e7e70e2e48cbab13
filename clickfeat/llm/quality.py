"""Quality scores by Bradley-Terry ranking.

A document's latent score is a weighted sum of features of its whole text. The weights are learned from preference pairs
(a good document before a bad one) by logistic loss on the feature differences, without an intercept. The cut is a
quantile of the latent scores of the training rows: the share of bad labels among them. The reported score is the
logistic of the distance to the cut, shifted so that the cut itself scores ``CUT_SCORE``.

Features are counts of the surface (``FEATURES``) and, for each kind of n-gram (``GRAMS``), the mean log odds of the
text's n-grams: how much likelier a good document holds the n-gram than a bad one. N-grams are hashed to ``BUCKETS``
values a kind. The odds are counted in each half of the labelled rows; a training row takes the odds of the other half,
so the pairs never see odds that their own labels made, and a document to score takes the mean of both.

Odds, pairs and the cut are made of all labelled rows. Orders over all of them (places in pairs, the quantile) are sliced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clickfeat.llm.common import BROADCAST_ROWS, stored, without
from clickfeat.llm.words import Words, mix, words_of
from clickfeat.operators.ordered import place_in_group

PAIRS_PER_ROW = 4  # preference pairs of each row of the larger class
PAIRS_PER_TASK = 250_000
GROUP_BYTES = 1 << 18  # text whose n-grams are made at once; each byte takes some ten numbers meanwhile
CUT_SCORE = 0.7
BUCKETS = 1 << 14  # hash values of each kind of n-gram

_UPPER, _LOWER, _DIGIT, _STOP, _MARK, _LINE, _WIDE = range(1, 8)
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[65:91] = _UPPER
_CLASS[97:123] = _LOWER
_CLASS[48:58] = _DIGIT
_CLASS[[ord(c) for c in ".,;:'\"-?()"]] = _STOP
_CLASS[10] = _LINE
_CLASS[128:] = _WIDE

FEATURES = [
    "length", "long_words", "upper", "digits", "stops", "marks", "wide", "bangs", "distinct_words", "top_word",
    "distinct_pairs", "marked_words", "lines", "stutter",
]
GRAMS = ["word", "word_pair", "five_bytes"]


def _row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets]).astype(np.float64)


def _repeats(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, per row."""
    if not len(hashes):
        return np.zeros(rows), np.zeros(rows)
    keys = np.sort((row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    owner = (keys[first] >> np.uint64(40)).astype(np.int64)
    counts = np.diff(np.append(first, len(keys)))
    top = np.zeros(rows)
    np.maximum.at(top, owner, counts)
    return np.bincount(owner, minlength=rows).astype(np.float64), top


def features(words: Words, offsets: np.ndarray) -> np.ndarray:
    """One line per row of a group; all zero for a text without words."""
    rows, data = words.rows, words.data
    kinds = _CLASS[data]
    count = {k: _row_sums(kinds == k, offsets) for k in (_UPPER, _LOWER, _DIGIT, _STOP, _MARK, _LINE, _WIDE)}
    bangs = _row_sums(data == ord("!"), offsets)
    n = words.counts().astype(np.float64)
    row = np.repeat(np.arange(rows), words.counts())
    distinct, top = _repeats(words.hashes, row, rows)
    pairs = words.hashes[:-1] * np.uint64(3) + words.hashes[1:]
    same = row[:-1] == row[1:]
    pairs_n = np.bincount(row[:-1][same], minlength=rows) if len(row) > 1 else np.zeros(rows)
    distinct_pairs, _ = _repeats(pairs[same] * np.uint64(0x9E3779B97F4A7C15), row[:-1][same], rows) if len(row) > 1 else (np.zeros(rows), None)
    again = (words.hashes[1:] == words.hashes[:-1]) & same if len(row) > 1 else np.zeros(0, bool)
    stutter = np.bincount(row[1:][again], minlength=rows) if len(row) > 1 else np.zeros(rows)
    marked = np.bincount(row[kinds[words.ends - 1] == _MARK], minlength=rows) if len(row) else np.zeros(rows)
    solid = np.maximum(sum(count[k] for k in (_UPPER, _LOWER, _DIGIT, _STOP, _MARK, _WIDE)), 1)
    letters = np.maximum(count[_UPPER] + count[_LOWER] + count[_WIDE], 1)
    each = np.maximum(n, 1)
    out = np.stack(
        [
            np.log1p(n) / 10,
            np.minimum(solid / each, 30) / 10,
            count[_UPPER] / letters,
            count[_DIGIT] / solid,
            count[_STOP] / solid,
            count[_MARK] / solid,
            count[_WIDE] / solid,
            bangs / solid,
            distinct / np.sqrt(each) / 10,
            top / each,
            distinct_pairs / np.maximum(pairs_n, 1),
            marked / each,
            count[_LINE] / each,
            stutter / each,
        ],
        axis=1,
    )
    out[n == 0] = 0
    return out


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) % np.uint64(BUCKETS)).astype(np.int64)


def grams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, for each kind of ``GRAMS``; none reaches over the end of a row."""
    row = np.repeat(np.arange(words.rows), words.counts())
    yield row, _bucket(words.hashes)
    same = row[:-1] == row[1:]
    yield row[:-1][same], _bucket(words.hashes[:-1][same] * np.uint64(3) + words.hashes[1:][same])
    row = np.repeat(np.arange(words.rows), np.diff(words.offsets))
    n = max(len(row) - 4, 0)
    same = row[:n] == row[4:]
    code = np.zeros(n, np.uint64)
    for i in range(5):
        code = code << np.uint64(8) | words.data[i : n + i]
    yield row[:n][same], _bucket(code[same])


def lexical(words: Words, odds: np.ndarray) -> np.ndarray:
    """Mean log odds (kinds x buckets) of each row's n-grams; 0 for a kind that the row has none of, and for a text
    without words."""
    out = np.zeros((words.rows, len(GRAMS)))
    for kind, (row, bucket) in enumerate(grams(words)):
        sums = np.bincount(row, weights=odds[kind][bucket], minlength=words.rows)
        out[:, kind] = sums / np.maximum(np.bincount(row, minlength=words.rows), 1)
    out[words.counts() == 0] = 0
    return out


def _batch_features(texts: pa.Array, odds: np.ndarray) -> np.ndarray:
    parts = [np.hstack([features(words, words.offsets), lexical(words, odds)]) for words in words_of(texts, limit=GROUP_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES) + len(GRAMS)))


def gram_odds(docs: DataFrame) -> np.ndarray:
    """Log odds (halves x kinds x buckets) of ``docs`` (half, label, text): the logarithm of the share of good documents
    that hold the n-gram over that of bad ones, both with one document more that holds it and one that does not. What a
    task returns and the driver sums is bounded by the buckets."""
    size = len(GRAMS) * BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((size + 1, 4), np.int64)  # the last line counts documents
        for batch in batches:
            group = 2 * batch.column("half").to_numpy() + batch.column("label").to_numpy()
            held[size] += np.bincount(group, minlength=4)
            for words in words_of(batch.column("text"), limit=GROUP_BYTES):
                own = group[words.first : words.first + words.rows]
                for kind, (row, bucket) in enumerate(grams(words)):
                    once = np.unique(row * BUCKETS + bucket)
                    np.add.at(held, (kind * BUCKETS + once % BUCKETS, own[once // BUCKETS]), 1)
        gram = np.flatnonzero(held.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int32()), *(pa.array(held[gram, i]) for i in range(4))], ["gram", "n0", "n1", "n2", "n3"]
        )

    parts = docs.select("half", "label", "text").mapInArrow(run, "gram int, n0 long, n1 long, n2 long, n3 long")
    sums = parts.groupBy("gram").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)]).toArrow()
    held = np.zeros((size + 1, 4))
    held[sums.column("gram").to_numpy()] = np.stack([sums.column(f"n{i}").to_numpy() for i in range(4)], axis=1)
    share = np.log((held[:size] + 1) / (held[size] + 2))
    return np.stack([share[:, 1] - share[:, 0], share[:, 3] - share[:, 2]]).reshape(2, len(GRAMS), BUCKETS)


def with_features(docs: DataFrame, odds: np.ndarray) -> DataFrame:
    """(doc_id, label, features) of labelled documents (doc_id, half, label, text), by the odds of the other half."""
    given = docs.sparkSession.sparkContext.broadcast(odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column("half").to_numpy()
            values = np.zeros((len(half), len(FEATURES) + len(GRAMS)))
            for own in (0, 1):
                index = np.flatnonzero(half == own)
                values[index] = _batch_features(batch.column("text").take(pa.array(index)), given.value[1 - own])
            cells = pa.ListArray.from_arrays(
                np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], pa.array(values.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), cells], ["doc_id", "label", "features"]
            )

    return docs.select("doc_id", "half", "label", "text").mapInArrow(run, "doc_id long, label int, features array<double>")


@dataclass
class Ranker:
    weights: np.ndarray
    cut: float
    odds: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        margin = values @ self.weights - self.cut + math.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def preference_pairs(rows: DataFrame) -> DataFrame:
    """(label, features): feature differences of good and bad rows, half of them turned round. Every row of the larger
    class is in ``PAIRS_PER_ROW`` pairs; all of them are used once before any is used twice."""

    def placed(label: int, name: str) -> tuple[DataFrame, int]:
        own = rows.where(F.col("label") == label).withColumn("_order", F.xxhash64(F.lit("pair"), "doc_id"))
        made = place_in_group(own, [], ["_order", "doc_id"], "_place", "_size")
        return made.select("_place", F.col("features").alias(name)), own.count()

    (good, n_good), (bad, n_bad) = placed(1, "_good"), placed(0, "_bad")
    if not n_good or not n_bad:
        return rows.sparkSession.createDataFrame([], "label double, features array<double>")
    total = PAIRS_PER_ROW * max(n_good, n_bad)
    ids = rows.sparkSession.range(total).select(
        F.col("id"),
        (F.col("id") % n_good).alias("_g"),
        ((F.col("id") + F.floor(F.col("id") / n_bad)) % n_bad).alias("_b"),
    )
    both = ids.join(good, F.col("_g") == good["_place"]).join(bad, F.col("_b") == bad["_place"])
    sign = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    return both.select(
        (F.col("id") % 2 == 0).cast("double").alias("label"),
        F.zip_with("_good", "_bad", lambda g, b: (g - b) * sign).alias("features"),
    )


def quantile(rows: DataFrame, value: Column, count: int, share: float) -> float:
    """The exact quantile of ``value``, interpolated as by ``percentile``: its two rows are found by their places in order."""
    ordered = place_in_group(rows.select(value.alias("_value"), "doc_id", "label"), [], ["_value", "doc_id", "label"], "_place", "_size")
    at = share * (count - 1)
    low, high = math.floor(at), math.ceil(at)
    found = {r["_place"]: r["_value"] for r in ordered.where(F.col("_place").isin(low, high)).select("_place", "_value").collect()}
    return found[low] if found[low] == found[high] else (high - at) * found[low] + (at - low) * found[high]


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """A ranker from ``docs`` (doc_id, text) and ``labels`` (doc_id, label of 0 or 1; others and NULL are not used).

    Without labels of both kinds there is nothing to rank by: every score is then ``CUT_SCORE``, or 0 if all labels are bad.
    """
    # Tasks import this module for its features; they have no use for the memory of Spark ML and pandas.
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    used = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "label"])
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")
    used = stored(used.withColumn("half", half), "quality-labels")
    texts = docs.select("doc_id", "text")
    if used.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(used), "doc_id")
    else:  # written, since two passes read the texts and each would exchange them
        texts = stored(texts.join(used, "doc_id"), "quality-texts")
    odds = gram_odds(texts)
    rows = stored(with_features(texts, odds), "quality-features")
    bad, count = rows.agg(F.avg(1 - F.col("label")), F.count(F.lit(1))).first()
    if bad is None or bad in (0.0, 1.0):
        return Ranker(np.zeros(len(FEATURES) + len(GRAMS)), 0.0 if not bad else 1e9, odds.mean(axis=0))
    tasks = max(8, PAIRS_PER_ROW * count // PAIRS_PER_TASK + 1)
    pairs = preference_pairs(rows).select("label", array_to_vector("features").alias("features")).coalesce(tasks).cache()
    fitted = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=100, tol=1e-7).fit(pairs)
    pairs.unpersist()
    weights = np.asarray(fitted.coefficients.toArray())
    latent = F.aggregate(
        F.zip_with("features", F.array(*map(F.lit, weights.tolist())), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x
    )
    return Ranker(weights, quantile(rows, latent, count, float(bad)), odds.mean(axis=0))


def score(docs: DataFrame, ranker: Ranker, name: str = "score") -> DataFrame:
    """``docs`` (text, ...) plus a column of scores from 0 to 1. NULL and empty texts have all features 0 and are scored
    like any other. A column already named ``name`` is replaced."""
    kept = docs.select(*without(docs, [name]))
    schema = StructType([*kept.schema.fields, StructField(name, DoubleType(), False)])
    given = docs.sparkSession.sparkContext.broadcast(ranker)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = given.value.score(_batch_features(batch.column("text"), given.value.odds))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def ranked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted`` (1 from the cut on), learned from the labels outside the held-out fold
    (remainder 2 of 4). ``labels`` has (doc_id, quality)."""
    own = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(remainder(F.col("doc_id"), 4) != 2)
    scored = score(docs.select(*without(docs, ["predicted"])), train(docs, own))
    return scored.withColumn("predicted", (F.col("score") >= CUT_SCORE).cast("int"))
