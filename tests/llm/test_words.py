import random
import re

import numpy as np
import pyarrow as pa
import pytest

from clickfeat.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, "a", "  a\tb\n c\r\n", "é ü x \x1f y", "word" * 50, "x " * 300, "\n\n", "A b C", "日本 語"]


def split(text, lower):
    found = WORD.findall(text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if lower else found


@pytest.fixture(params=[None, 16])
def limit(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(W, "LIMIT", request.param)
        monkeypatch.setattr(W, "_POWERS", {})


@pytest.mark.parametrize("lower", [False, True])
def test_words_are_those_of_the_pattern(limit, lower):
    seen, names = {}, 0
    for group in W.words_of(pa.array(TEXTS * 3), lower):
        spelled = W.spelled(group, np.arange(len(group.hashes))).to_pylist()
        for i in range(group.rows):
            own = spelled[group.bounds[i] : group.bounds[i + 1]]
            assert own == split((TEXTS * 3)[group.first + i], lower)
            names += 1
        for word, value in zip(spelled, group.hashes.tolist()):
            assert seen.setdefault(word, value) == value
    assert names == len(TEXTS) * 3 and len(set(seen.values())) == len(seen)


def test_empty_column():
    assert list(W.words_of(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 13, 20])
def test_window_hashes_agree_exactly_on_equal_windows(k):
    random.seed(k)
    values = np.array([random.choice([1, 2]) for _ in range(200)], np.uint64)
    found = W.window_hashes(values, k)
    assert len(found) == 200 - k + 1
    by_content = {}
    for i, h in enumerate(found.tolist()):
        assert by_content.setdefault(tuple(values[i : i + k].tolist()), h) == h
    assert len(set(by_content.values())) == len(by_content)


def test_windows_stay_in_their_row():
    bounds = np.array([0, 3, 3, 7])
    assert W.inside(bounds, 3, 5).tolist() == [True, False, False, True, True]
