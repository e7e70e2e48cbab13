import random
import re

import numpy as np
import pytest

from clickfeat.llm import candidates as C
from clickfeat.llm import near_duplicates as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    of = list(range(len(rows)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= percent * len(sets[a][1] | sets[b][1]):
                x, y = of[a], of[b]
                of = [min(x, y) if c in (x, y) else c for c in of]
    least = {c: min((sets[k][0] for k in range(len(sets)) if of[k] == c and sets[k][0] is not None), default=None) for c in of}
    return sorted(((i, len(s), least[of[k]]) for k, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize("percent", [85, 80])
def test_linked_sets_share_a_signature(percent):
    rng, linked = np.random.default_rng(percent), 0
    for _ in range(1500):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 150))).astype(np.uint64))
        drop, add = rng.integers(0, max(1, len(a) // 6) + 1, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
            found, owner = nd.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), percent)
            assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())
            linked += 1
    assert linked > 300


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_equals_brute_force(spark, documents, width, percent):
    random.seed(width)
    rows = [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "ONE two"), (9005, "two"), (None, "one two")]
    for g in range(12):
        base = [f"w{random.randrange(400)}" for _ in range(random.choice([5, 12, 40, 160]))]
        for _ in range(random.choice([1, 2, 15])):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4])):
                text[random.randrange(len(text))] = f"w{random.randrange(400)}"
            rows.append((len(rows) * 3 % 997, " ".join(text)))
    rows = [r for k, r in enumerate(rows) if r[0] not in {x[0] for x in rows[:k]}]
    extra = {"node": ("long", 5), "_node": ("int", 1), "component": ("string", "x")}
    found = nd.near_duplicates(documents(rows, extra), width, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, width, percent)


def test_groups_of_two_batches_joined_by_one_inner_pair(spark, monkeypatch):
    """Each side shares its signatures within its own batch; only the last text of one and of the other link across."""

    def tiny(parts, buckets):
        before = C.HOT, C.ROWS
        C.HOT, C.ROWS = 2, 8
        try:
            yield from C.packed(parts, buckets)
        finally:
            C.HOT, C.ROWS = before

    monkeypatch.setattr(nd, "packed", tiny)
    sides = ([], [])
    for family in range(3):
        x = [f"f{family}w{i}" for i in range(160)]
        y = [f"{w}y" if i in (20, 80, 140) else w for i, w in enumerate(x)]
        for side, base in enumerate((x, y)):
            for at in (35, 50, 65, 95, 110, 125, None):
                text = [f"{w}e{side}" if i == at else w for i, w in enumerate(base)]
                sides[side].append((1000 * side + len(sides[side]), " ".join(text)))
    rows = sides[0] + sides[1]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    found = nd.near_duplicates(docs).collect()
    expected = brute(rows, nd.WIDTH, nd.PERCENT)
    assert len({c for *_, c in expected}) == 3
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == expected


def test_repeated_rows_and_one_of_each(spark, documents):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(5, text), (5, text), (5, "other words that are not alike"), (3, text + " b"), (8, None), (9, None), (None, text)]
    found = nd.near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 3), (3, 3), (5, 3), (5, 3), (5, 5), (8, 8), (9, 9)]
    kept = nd.one_of_each(documents(rows, {"lang": ("string", "en")}))
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [(3, "a0 a1"), (5, "other"), (8, ""), (9, "")]


def test_empty_table(spark, documents):
    assert nd.near_duplicates(documents([])).collect() == []
    assert nd.one_of_each(documents([])).collect() == []


def test_a_component_and_a_repeated_row_on_a_third_of_the_rows(spark, documents, monkeypatch):
    """Hot groups are split into parts; lost or doubled rows would show."""
    from clickfeat.llm import common

    monkeypatch.setattr(common, "HOT_GROUP_ROWS", 3)
    body = " ".join(f"w{i}" for i in range(120))
    rows = [(i, f"{body} tail{i % 7}") for i in range(40, 80)] + [(5, body)] * 30 + [(None, "lone text of six other words")] * 20
    rows += [(1000 + i, " ".join(f"r{i}x{k}" for k in range(9))) for i in range(30)]
    for limit in (2_000_000, 0):
        monkeypatch.setattr(nd, "BROADCAST_ROWS", limit)
        given = documents(rows, {"_c": ("int", 1), "_part": ("int", 1)}).repartition(4)
        found = nd.near_duplicates(given, 4, 85).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, 4, 85)
        assert sum(r.first for r in found if r.component_id == 5) == 30
        assert nd.one_of_each(given, 4, 85).count() == 1 + 1 + 30


def test_wide_sketches_keep_all_links_and_part_long_unlike_sets():
    rng = np.random.default_rng(5)
    for n in (1, 63, 64, 65, 700, 5000):
        one = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        for m in sorted({n, max(1, n * 9 // 10), n * 4 // 5}):
            two = np.sort(np.concatenate([one[rng.permutation(n)[:m]], rng.integers(0, 2**63, n // 10).astype(np.uint64)]))
            both, total = len(np.intersect1d(one, two)), len(np.union1d(one, two))
            cells = nd._wide_parities(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
            x, y = (np.frombuffer(c, np.uint8) for c in cells)
            assert 8 * len(x) >= n
            if 100 * both >= 80 * total:
                assert nd.close(len(one), x, len(two), y, 80) and nd.close(len(two), y, len(one), x, 80)
    one, two = (np.sort(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (5000, 4500))
    x, y = (np.frombuffer(c, np.uint8) for c in nd._wide_parities(np.concatenate([one, two]), np.array([0, 5000, 9500])))
    assert not nd.close(5000, x, 4500, y, 80)


def test_sets_are_sent_for_close_pairs_only(spark, documents, monkeypatch):
    words = lambda salt: " ".join(f"{salt}{i}" for i in range(3000))
    rows = [(1, words("a")), (2, words("a") + " end"), (3, words("b")), (4, words("c"))]
    made = {}
    keep = nd.stored
    monkeypatch.setattr(nd, "stored", lambda df, name, **options: made.setdefault(name, keep(df, name, **options)))
    docs = nd.with_nodes(documents(rows))
    sketches = nd._sketches(docs, 4)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (3, 4)], "a long, b long")
    found = nd._verified(pairs, sketches, docs, 4, 85).collect()
    assert [tuple(r) for r in found] == [(1, 2)]
    assert {r.node for r in made["near-sets"].collect()} == {1, 2}
    assert sum(map(len, (r.sketch for r in sketches.collect()))) * 16 < sum(len(r.shingles) for r in nd._sets(docs, 4).collect())


def test_texts_of_unique_ids_are_not_shuffled(spark, documents):
    plan = nd._once(nd.with_nodes(documents([(1, "a"), (2, "b")])))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, None), (None, "")]
    assert sorted((r.doc_id or 0, r.text or "") for r in nd._once(nd.with_nodes(documents(rows))).collect()) == [(0, ""), (1, "a"), (1, "b"), (2, "c")]
