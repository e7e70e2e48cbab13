import hashlib
import random

import pytest

from clickfeat.llm import candidates as C
from clickfeat.llm import lines as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(text, times, letters):
    out = list(text)
    for _ in range(times):
        i, kind = random.randint(0, len(out)), random.random()
        if kind < 0.4:
            out.insert(i, random.choice(letters))
        elif out and kind < 0.7:
            out.pop(min(i, len(out) - 1))
        elif out:
            out[min(i, len(out) - 1)] = random.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_banded_distance(edits):
    random.seed(edits)
    for letters in ("ab", "abcdé日"):
        for _ in range(3000):
            a = "".join(random.choice(letters) for _ in range(random.randint(0, 16)))
            b = edited(a, random.randint(0, edits + 2), letters)
            assert L.within(a, b, edits) == (distance(a, b) <= edits), (a, b)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_share_a_key_and_have_close_sketches(spark, edits):
    import numpy as np
    from pyspark.sql import functions as F

    random.seed(edits)
    pairs = []
    for _ in range(400):
        a = "".join(random.choice("abc") for _ in range(random.randint(8, 30)))
        b = edited(a, edits, "abc")
        if len(b) > edits and distance(a, b) <= edits:
            pairs.append((a, b))
            chars = np.frombuffer((a + b).encode("utf-32-le"), np.uint32)
            found, owner = L.keys(chars, np.array([0, len(a)]), np.array([len(a), len(b)]), edits)
            assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist()), (a, b)
    texts = spark.createDataFrame([(i * 2 + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)], "node long, text string")
    facts = L.with_sketches(texts).select("node", "fact")
    both = facts.where("node % 2 = 0").alias("x").join(facts.alias("y"), F.col("x.node") + 1 == F.col("y.node"))
    assert both.where(~L.can_be_near(F.col("x.fact"), F.col("y.fact"), edits)).count() == 0 and both.count() == len(pairs)


def brute(rows, edits, min_chars):
    found = [(i, j, x) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for j, x in enumerate(t.split("\n") if t is not None else [])]
    kinds = sorted({x for *_, x in found if x.strip(" ")})
    of = {x: x for x in kinds}
    for k, a in enumerate(kinds):
        for b in kinds[:k]:
            if min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                old, new = of[a], of[b]
                of = {x: new if c == old else c for x, c in of.items()}
    seen, out = set(), {i: [0, 0, []] for i, _ in rows}
    for i, _, x in found:
        out[i][0] += 1
        if x.strip(" ") and of[x] in seen:
            out[i][1] += 1
            continue
        seen.add(of.get(x, ""))
        out[i][2].append(x)
    return out


def test_equals_brute_force(spark, documents):
    random.seed(9)
    letters = "abcde é"
    bases = ["".join(random.choice(letters) for _ in range(random.choice([6, 22, 40]))) for _ in range(12)]
    rows = [(None, bases[0]), (900, None), (901, ""), (902, "\n\n  \n"), (903, "short\nshorT\nshort")]
    for i in range(25):
        rows.append((i, "\n".join(edited(random.choice(bases), random.choice([0, 0, 1, 3]), letters) for _ in range(6))))
    extra = {"node": ("int", 1), "line": ("string", "x"), "gone": ("int", 3)}
    found = L.dedup_lines(documents(rows + [rows[7]], extra)).collect()
    expected = brute(rows, 2, 20)
    assert len(found) == len(rows) + 1
    for r in found:
        n, gone, kept = expected[r.doc_id]
        assert (r.n_lines, r.n_removed) == (n, gone), r.doc_id
        assert r.kept == (None if r.doc_id == 900 else "\n".join(kept))


def test_groups_of_two_batches_joined_by_one_inner_pair(spark, monkeypatch):
    """Each side shares its keys within its own batch; only one line of each is near one of the other."""

    def tiny(parts, buckets):
        before = C.HOT, C.ROWS
        C.HOT, C.ROWS = 2, 8
        try:
            yield from C.packed(parts, buckets)
        finally:
            C.HOT, C.ROWS = before

    monkeypatch.setattr(L, "packed", tiny)
    random.seed(3)
    sides = ([], [])
    for _ in range(4):
        x = [random.choice("abcdefghij") for _ in range(60)]
        y = ["Y" if i in (5, 25) else c for i, c in enumerate(x)]
        for side, base in enumerate((x, y)):
            for at in (None, 2, 8, 11, 14, 17, 22, 28, 31, 34, 37):
                sides[side].append((1000 * side + len(sides[side]), "".join("XZ"[side] if i == at else c for i, c in enumerate(base))))
    rows = sides[0] + sides[1]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    expected = brute(rows, 2, 20)
    assert sum(gone for _, gone, _ in expected.values()) == len(rows) - 4
    for r in L.dedup_lines(docs).collect():
        n, gone, kept = expected[r.doc_id]
        assert (r.n_lines, r.n_removed, r.kept) == (n, gone, "\n".join(kept)), r.doc_id


def test_empty_table(spark, documents):
    assert L.dedup_lines(documents([])).collect() == []


def test_a_line_on_a_third_of_all_lines(spark, documents, monkeypatch):
    from clickfeat.llm import common

    monkeypatch.setattr(common, "HOT_GROUP_ROWS", 4)
    rows = [(i, f"the common line of them all\nown text number {hashlib.md5(str(i).encode()).hexdigest()} of this row\nthe common line of them all") for i in range(40)]
    rows += [(None, "the common line of them all"), (3, "another text under a repeated id\nthe common line of them all")]
    found = L.dedup_lines(documents(rows, {"class": ("int", 1), "_part": ("int", 1)})).collect()
    kept = [line for r in found for line in (r.kept or "").split("\n")]
    assert sum(r.n_lines for r in found) == 40 * 3 + 3 and sum(r.n_removed for r in found) == 82 - 1
    assert kept.count("the common line of them all") == 1 and len([k for k in kept if k.startswith("own")]) == 40
