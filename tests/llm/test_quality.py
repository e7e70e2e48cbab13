import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickfeat.llm import quality
from clickfeat.llm.queries import QUERIES
from clickfeat.llm.words import mix, words_of


@pytest.fixture(scope="module")
def labelled(spark):
    good = ["The rain in the hills kept on until the river rose", "A quiet house stood by the old road to the sea"]
    bad = ["BUY!! NOW!! BUY!! NOW!! BUY!!", "x### y%%% z$$$ q### r%%%"]
    rows = [(i, (good if i % 3 else bad)[i % 2] + f" {'abcdefgh'[i % 8]}") for i in range(300)]
    docs = spark.createDataFrame([r + (0.5, "x") for r in rows], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i, _ in rows], "doc_id long, quality int")
    return docs, labels


def test_ranks_and_keeps_other_columns(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame([(None, None, 0.5, "x"), (1000, "", 0.5, "x"), (1001, "a" * 100_000, 0.5, "x")], docs.schema)
    noise = spark.createDataFrame([(5, None), (None, 1), (7, 9), (2, 1), (2, 1)], labels.schema)
    out = quality.ranked(docs.unionByName(odd), labels.unionByName(noise))
    assert out.columns == ["doc_id", "text", "label", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.predicted == int(bool(r.doc_id % 3)) for r in rows if r.doc_id is not None and r.doc_id < 300)


def test_without_labels_of_both_kinds(labelled):
    docs, labels = labelled
    assert {r.predicted for r in quality.ranked(docs, labels.where("quality = 1")).collect()} == {1}
    assert {r.predicted for r in quality.ranked(docs, labels.limit(0)).collect()} == {1}
    assert {r.predicted for r in quality.ranked(docs, labels.where("quality = 0")).collect()} == {0}
    assert quality.ranked(docs.limit(0), labels).collect() == []


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = QUERIES["op6_quality"](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = out.join(labels, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def brute_grams(text):
    """Hash values of the words, word pairs and runs of five bytes of a text, one list a kind."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = [int(h) for h in next(words_of(pa.array([" ".join(words)]))).hashes] if words else []
    raw = (text or "").encode()
    runs = [int.from_bytes(raw[i : i + 5], "big") for i in range(len(raw) - 4)]
    pairs = [(a * 3 + b) % (1 << 64) for a, b in zip(hashes, hashes[1:], strict=False)]
    return [[int(mix(np.array([h], np.uint64))[0]) % quality.BUCKETS for h in kind] for kind in (hashes, pairs, runs)]


TEXTS = ["one two", "", None, "éà", "abcd", "abcde", "  \n ", "two one two one", "x" * 70_000, "a b " * 300_000, "Two"]


def test_grams_stay_inside_their_row():
    found = {}
    for words in words_of(pa.array(TEXTS)):
        for kind, (row, bucket) in enumerate(quality.grams(words)):
            for r, b in zip(row, bucket, strict=True):
                found.setdefault((words.first + r, kind), []).append(b)
    for i, text in enumerate(TEXTS):
        whole = len(text or "") <= 100_000
        for kind, buckets in enumerate(brute_grams(text if whole else text[:2000])):
            mine = found.get((i, kind), [])
            assert mine[: len(buckets)] == buckets
            assert len(mine) == len(buckets) or not whole


def test_odds_and_features_equal_brute_force(spark):
    texts = [t for t in TEXTS if t is None or len(t) < 2000]
    rows = [(i, i % 2, (i // 2) % 2, t) for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, half int, label int, text string").repartition(5)
    odds = quality.gram_odds(docs)
    held = {(h, lab): [brute_grams(t) for _, half, label, t in rows if (half, label) == (h, lab)] for h in (0, 1) for lab in (0, 1)}

    def brute(half, kind, bucket):
        share = [
            math.log((sum(bucket in g[kind] for g in held[half, lab]) + 1) / (len(held[half, lab]) + 2)) for lab in (0, 1)
        ]
        return share[1] - share[0]

    for text in texts:
        for kind, buckets in enumerate(brute_grams(text)):
            for bucket in buckets:
                assert odds[:, kind, bucket] == pytest.approx([brute(h, kind, bucket) for h in (0, 1)])
    for r in quality.with_features(docs, odds).collect():
        own = dict(enumerate(texts * 3))[r.doc_id]
        mine = r.features[len(quality.FEATURES) :]
        if not re.search(r"[^\x20\x09-\x0D]", own or ""):
            assert mine == [0, 0, 0]
            continue
        for kind, buckets in enumerate(brute_grams(own)):
            mean = sum(odds[1 - r.doc_id % 2, kind, b] for b in buckets) / max(len(buckets), 1)
            assert mine[kind] == pytest.approx(mean)


def test_weights_equal_newton_steps_on_the_pairs(spark, monkeypatch):
    """The fitted weights are the least of the regularised logistic loss over all feature differences."""
    rng = np.random.default_rng(5)
    words = ["sea", "road", "buy", "now", "river", "x!", "9", "hill"]
    rows = [(i, " ".join(rng.choice(words[: 4 + 4 * (i % 3 == 0)], 12)), int(i % 3 == 0)) for i in range(400)]
    rows = [(i, t, q if i % 11 else 1 - q) for i, t, q in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, label int")
    seen, own = [], quality.preference_pairs
    monkeypatch.setattr(quality, "preference_pairs", lambda r: seen.append(own(r)) or seen[-1])
    ranker = quality.train(docs, labels)
    pairs = seen[0].collect()
    x, y = np.array([p.features for p in pairs]), np.array([p.label for p in pairs])
    scale = x.std(axis=0, ddof=1)
    used = scale > 0
    z, w = x[:, used] / scale[used], np.zeros(used.sum())
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        slope = z.T @ (p - y) / len(y) + 1e-4 * w
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(y) + 1e-4 * np.eye(len(w)), slope)
    loss = lambda v: np.logaddexp(0, -(2 * y - 1) * (x @ v)).mean() + 5e-5 * ((v * scale) ** 2).sum()
    best = np.zeros(len(used))
    best[used] = w / scale[used]
    assert loss(ranker.weights) == pytest.approx(loss(best), abs=1e-4)


def test_learns_from_every_labelled_row(spark, monkeypatch):
    n = 20_050
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('word ', id % 7) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "cast(id % 3 > 0 as int) AS label")
    seen = []
    monkeypatch.setattr(quality, "gram_odds", lambda t: seen.append(t.agg({"doc_id": "count"}).first()[0]) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        quality.train(docs, labels)
    assert seen == [n]


def test_every_row_is_in_a_pair(spark):
    n = 11_000
    rows = spark.range(n + 3).selectExpr("id AS doc_id", f"cast(id < {n} as int) AS label", "array(double(id)) AS features")
    made = quality.preference_pairs(rows)
    differences = made.selectExpr("if(label = 1, features[0], -features[0]) AS d").collect()
    assert len(differences) == 4 * n
    assert {int(n + b + r.d) for r in differences for b in range(3)} >= set(range(n))


def test_quantile_is_exact(spark):
    values = [0.5, -1.25, 3.0, 3.0, 7.5, 0.1, 2.0]
    rows = spark.createDataFrame([(i, 0, v) for i, v in enumerate(values)], "doc_id long, label int, v double")
    for share in (0.0, 0.2, 0.5, 0.77, 1.0):
        wanted = rows.agg(F.percentile("v", F.lit(share))).first()[0]
        assert quality.quantile(rows, F.col("v"), len(values), share) == pytest.approx(wanted, abs=1e-12)
