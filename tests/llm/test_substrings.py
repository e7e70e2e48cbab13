import random

import pytest

from clickfeat.llm import substrings


def brute(rows, k):
    """rows: (doc_id, text), distinct; order by id (None first)."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = (text or "").split()
        gone = [False] * len(words)
        for i in range(len(words) - k + 1):
            window = tuple(words[i : i + k])
            if window in seen:
                gone[i : i + k] = [True] * k
            seen.add(window)
        out[doc_id] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("window, seed, letters", [(5, 2, 3), (6, 3, 12), (20, 8, 200)])
def test_equals_brute_force(spark, documents, window, seed, letters):
    random.seed(window)
    word = lambda: f"w{random.randrange(letters)}"
    passages = [[word() for _ in range(random.randint(3, 60))] for _ in range(8)]
    rows = [(None, " ".join(passages[0])), (7000, None), (7001, ""), (7002, "x " * 100), (7003, "\n".join(passages[1]))]
    for i in range(60):
        parts = [random.choice(passages) if random.random() < 0.5 else [word() for _ in range(random.randint(0, 25))] for _ in range(4)]
        rows.append((i, " ".join(w for p in parts for w in p)))
    extra = {"doc": ("int", 1), "sub": ("string", "s"), "start": ("int", 3), "places": ("int", 4)}
    given = documents(rows + [rows[5]], extra).repartition(5)  # one repeated row
    found = substrings.without_repeats(given, window, seed).collect()
    expected = brute(rows, window)
    assert len(found) == len(rows) + 1
    for r in found:
        assert (r.n_words, r.n_removed, r.kept) == expected[r.doc_id], r.doc_id


def test_rows_of_one_id_are_one_after_the_other(spark, documents):
    text = " ".join(f"a{i}" for i in range(25))
    found = substrings.without_repeats(documents([(1, text), (1, text + " b"), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) in ([(1, 0), (1, 25), (2, 25)],)


def test_empty_table(spark, documents):
    assert substrings.without_repeats(documents([])).collect() == []
