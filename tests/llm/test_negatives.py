import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickfeat.llm import negatives

SCHEMA = "vec_id long, label int, vector array<long>"


def brute(rows, every, k=3, positives=5, window=(50, 95)):
    """Every result by looking at all pairs."""
    real = [(i, g, v) for i, g, v in rows if i is not None and g is not None and v is not None and None not in v]
    out = []
    for own, label, anchor in {(i, g, tuple(v)) for i, g, v in real if i % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(anchor, v)), i, g) for i, g, v in real if i != own)
        for score, positive, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and -window[0] * score <= -100 * x[0] <= -window[1] * score]
            out += [(own, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fits[:k], 1)]
    return sorted(out)


def mined(spark, rows, every, **options):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", key string, shard int")
    out = negatives.mine(frame, F.col("vec_id") % every == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("kind", ["dense", "close", "sparse", "ties", "wide", "hot label"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(negatives, "SHARD", 150)
    monkeypatch.setattr(negatives, "BLOCK", 7)
    random.seed(kind)
    width = {"wide": 130, "ties": 3}.get(kind, 12)
    centres = [[random.randint(-200, 200) for _ in range(width)] for _ in range(4)]
    draw = {
        "dense": lambda i: [random.randint(-256, 256) for _ in range(width)],
        "close": lambda i: [x + random.randint(-40, 40) for x in centres[i % 4]],
        "sparse": lambda i: [random.choice([0] * 9 + [random.randint(-99, 99)]) for _ in range(width)],
        "ties": lambda i: [random.choice([0, 1, 10]) for _ in range(width)],
        "wide": lambda i: [random.randint(-256, 256) for _ in range(width)],
        "hot label": lambda i: [x + random.randint(-90, 90) for x in centres[i % 2]],
    }[kind]
    label = (lambda i: 0 if i % 3 else i % 5) if kind == "hot label" else (lambda i: random.randrange(4))
    rows = [(i, label(i), draw(i)) for i in range(600)]
    rows += [(None, 1, draw(0)), (900, None, draw(0)), (901, 1, None), (902, 1, [1, None]), (903, 1, []), (950, 2, [7]), (960, 2, [0] * width)]
    rows += [rows[3], rows[3], rows[40], (40, 3, draw(40)), (40, rows[40][1], draw(41))]
    assert mined(spark, rows, 20) == brute(rows, 20)


def test_other_settings_and_few_rows(spark):
    random.seed(2)
    rows = [(i, i % 2, [random.randint(0, 50) for _ in range(4)]) for i in range(60)]
    assert mined(spark, rows, 10, k=5, positives=2, window=(10, 200)) == brute(rows, 10, 5, 2, (10, 200))
    for few in ([], rows[1:5], rows[:1], [(0, 1, []), (1, 1, []), (2, 0, [])], [(0, 0, [5]), (1, 0, [3]), (2, 1, [2])]):
        assert mined(spark, few, 10) == brute(few, 10)


def test_intervals_hold_the_score_and_drop_candidates():
    """The interval is sure for every pair; for close groups most candidates are dropped unscored."""
    draw = np.random.default_rng(1)
    centres = draw.integers(-250, 250, (30, 64))
    cells = centres[draw.integers(0, 30, 3000)] + draw.integers(-20, 20, (3000, 64))
    asked = cells[:50]
    low, high = negatives.Codes(cells).intervals(asked)
    scores = asked @ cells.T
    assert (low <= scores).all() and (scores <= high).all()
    left = [negatives.unbeaten(low[i], high[i], 5).sum() for i in range(50)]
    assert max(left) < 400
