import hashlib
import math

import pytest
from pyspark.sql import functions as F

from clickfeat.llm import mixing
from clickfeat.llm.common import n_words

SCHEMA = "doc_id long, source string, text string, size string, _slice int"


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit > 3 * sizes[s]]
        if not over:
            return target | {s: weight[s] * unit for s in free}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def brute(rows):
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    target, taken = brute_targets(sizes), []
    for source in sizes:
        mine = [(hashlib.md5(f"mix-1:{'' if i is None else i}".encode()).hexdigest(), i, len((t or "").split())) for i, s, t in rows if s == source]
        budget, before = math.floor(target[source] + 1e-9), 0
        for _, i, n in sorted(mine, key=lambda x: (x[0], x[2])):
            full, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
            taken.append((i, source, n, full * n + max(0, min(n, rest - before))))
            before += n
    return sorted(taken, key=str), target


@pytest.mark.parametrize("slice_rows", [10_000, 7])
def test_equals_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    sources = ["a"] * 60 + ["b", "c", "ü"] * 5 + [None] * 7 + ["empty"] * 3 + ["tiny"]
    rows = [(i, s, None if s == "empty" else " w" * (i * 7 % 23) or "") for i, s in enumerate(sources)] + [(3, "a", "w w"), (None, "a", "w")]
    rows += [rows[1], rows[1]]
    given = spark.createDataFrame([r + ("clash", 1) for r in rows], SCHEMA)
    out = mixing.mix(given, n_words(F.col("text")))
    found = out.collect()
    expected, target = brute(rows)
    assert sorted(((r.doc_id, r.source, r.size, r.taken) for r in found), key=str) == expected
    for r in found:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r.size
    assert out.columns == ["doc_id", "source", "text", "_slice", "size", "source_size", "target", "taken"]
    # As rows: as many words as were taken, every copy whole but for one at most in each source.
    copies = mixing.copies(out).collect()
    for source in target:
        words = sum(len((r.text or "").split()) for r in copies if r.source == source)
        assert words == sum(r.taken for r in found if r.source == source)
        texts = {(i, " ".join((t or "").split())) for i, s, t in rows if s == source}
        assert sum((r.doc_id, " ".join(r.text.split())) not in texts for r in copies if r.source == source) <= 1


def test_empty_table_and_one_source(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty, n_words(F.col("text"))).collect() == []
    one = spark.createDataFrame([(1, "s", "a b c", "", 0), (2, "s", None, "", 0)], SCHEMA)
    assert sorted(r.taken for r in mixing.mix(one, n_words(F.col("text"))).collect()) == [0, 3]


@pytest.mark.parametrize("slice_rows", [10_000, 7, 1])
def test_one_id_on_a_third_of_the_rows(spark, monkeypatch, slice_rows):
    """NULL ids and one id fill a source: texts of equal and of different sizes, many of them equal rows."""
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    rows = [(None, "a", f"x{i % 40} " + "w " * (i % 3)) for i in range(90)]
    rows += [(7, "b", "same four words here")] * 80 + [(7, "b", None)] * 3
    rows += [(100 + i, s, "w " * (i % 5)) for i in range(40) for s in ("a", "b")]
    rows += [(200 + i, "c", "w " * 200) for i in range(2)]
    given = spark.createDataFrame([r + ("clash", 1) for r in rows], SCHEMA).repartition(5)
    out = mixing.mix(given, n_words(F.col("text")))
    expected, target = brute(rows)
    assert sorted(((r.doc_id, r.source, r.size, r.taken) for r in out.collect()), key=str) == expected
    again = mixing.mix(given.repartition(3), n_words(F.col("text")))
    # The texts are neither sorted nor joined by shuffling; the one window is over the rows at the ends.
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" in plan and plan.count("Window ") == 1 and "SortMergeJoin" not in plan
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
