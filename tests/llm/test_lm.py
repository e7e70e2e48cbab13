import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from clickfeat.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def pieces():
    return lm.load_pieces()


def brute_marginal(logp, word):
    text = b" " + word.encode()
    alpha = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        alpha[j] = sum(alpha[i] * logp.get(text[i:j], 0.0) for i in range(j))
    return math.log(alpha[-1])


@pytest.fixture(scope="module")
def table(pieces):
    def of(raw):
        key = lm.mix(lm._prefix_hashes(np.frombuffer(raw, np.uint8)[None, :])[:, -1])[0]
        at = int(np.searchsorted(pieces.keys, key))
        return math.exp(pieces.logp[at]) if at < len(pieces.keys) and pieces.keys[at] == key else 0.0

    class Table(dict):
        def get(self, raw, default):
            return of(raw)

    return Table()


WORDS = ["a", "the", "another", "éà", "日本", "zqxj", "antidisestablishment", "\x01", "0"]


def test_marginals_sum_over_all_segmentations(pieces, table):
    found = lm.log_marginals(pieces, pa.array(WORDS))
    assert found == pytest.approx([brute_marginal(table, w) for w in WORDS])


def test_long_words_stay_finite(pieces):
    assert np.isfinite(lm.log_marginals(pieces, pa.array(["ab" * 3000]))).all()


def test_expected_counts_spell_the_words(pieces):
    counts = lm.expected_counts(pieces, pa.array(WORDS))
    assert counts.min() >= 0 and sum(len(w) > 0 for w in WORDS) <= counts.sum() <= sum(len(w.encode()) + 1 for w in WORDS)


def test_edges_found_again_give_the_same_counts(pieces, monkeypatch):
    words = pa.array([*WORDS, "ab" * 300])
    whole = lm.expected_counts(pieces, words)
    for cells in (1, 7, 64):
        monkeypatch.setattr(lm, "CELLS", cells)
        assert lm.expected_counts(pieces, words) == pytest.approx(whole)


def brute_pieces():
    """Probability of each piece of the vocabulary file and of each byte, in inverse proportion to the rank."""
    model = sentencepiece.SentencePieceProcessor(model_file=lm.VOCABULARY)
    found = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            piece = model.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
            if b" " not in raw[1:]:
                found.setdefault(raw, 1 / (len(found) + 1))
    for byte in range(256):
        found.setdefault(bytes([byte]), 1 / (len(found) + 1))
    total = sum(found.values())
    return {raw: x / total for raw, x in found.items()}


def brute_lattice(prob, text, longest=64):
    """Sums over the segmentations of each beginning and of each rest of the text."""
    n = len(text)
    ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for j in range(1, n + 1):
        ahead[j] = sum(ahead[i] * prob.get(text[i:j], 0) for i in range(max(0, j - longest), j))
    for i in reversed(range(n)):
        behind[i] = sum(prob.get(text[i:j], 0) * behind[j] for j in range(i + 1, min(n, i + longest) + 1))
    return ahead, behind


def brute_estimate(words):
    """(piece probabilities, probability of the end) after the rounds of expectation over distinct words."""
    prob, end = brute_pieces(), 1.0
    for _ in range(lm.ROUNDS):
        used = dict.fromkeys(prob, 0.1)
        for word in words:
            text = b" " + word.encode()
            ahead, behind = brute_lattice(prob, text)
            for i in range(len(text)):
                for j in range(i + 1, len(text) + 1):
                    if text[i:j] in prob:
                        used[text[i:j]] += ahead[i] * prob[text[i:j]] * behind[j] / ahead[-1]
        total = sum(used.values()) + 1.1
        prob, end = {raw: x / total for raw, x in used.items()}, 1.1 / total
    return prob, end


def test_scores_equal_brute_force(spark, documents):
    texts = ["The cat sat", "the the dog", "", None, "zebra crossing cat", "Émile the unseenword", "日本 cat zqxj"]
    rows = [(i, texts[i % len(texts)] if i != 36 else "heldout zebra only") for i in range(60)]
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = {i: WORD.findall(lower(t)) for i, t in rows}
    count = Counter(w for i in tokens if not held[i] for w in tokens[i])
    ends = sum(not h for h in held.values())
    n, t = sum(count.values()) + ends, len(count) + 2
    prob, end = brute_estimate(list(count))
    lattice = {w: brute_lattice(prob, b" " + w.encode())[0][-1] for ws in tokens.values() for w in ws}
    word = lambda c, sum_: math.log10((c + t * sum_) / (n + t))
    for top_words in (2, 1000):  # most words joined, all words sent to the tasks
        found = lm.score_texts(documents(rows), top_words=top_words).collect()
        assert len(found) == len(rows)
        for r in found:
            mine = tokens[r.doc_id]
            assert r.score == pytest.approx(sum(word(count[w], lattice[w]) for w in mine) + word(ends, end))
            assert r.lattice_score == pytest.approx(sum(math.log10(lattice[w]) for w in mine) + math.log10(end))


def test_scores(spark, documents):
    texts = ["The cat sat", "the the dog", "", None, "zebra crossing cat", "cat " * 40, "Émile the"]
    rows = [(i, texts[i % len(texts)]) for i in range(40)] + [(3, texts[3])]
    found = lm.score_texts(documents(rows, {"word": ("string", "x"), "times": ("int", 2)}), top_words=3).collect()
    assert len(found) == len(rows)
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    count = Counter(w for i, t in rows if not held[i] for w in tokens[i])
    n, v = sum(count.values()), len(count)
    for r in found:
        mine = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(mine), n)
        assert r.n_known == sum(count[w] > 0 for w in mine)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in mine))
        assert -1e6 < r.lattice_score < 0 and -1e6 < r.score < 0
    by_text = {}
    for r in found:
        assert by_text.setdefault(texts[r.doc_id % len(texts)], pytest.approx(r.score)) == r.score
    # Known words score by their counts, unknown ones by their pieces.
    assert by_text["The cat sat"].expected > by_text["zebra crossing cat"].expected


def test_empty_and_unlearned_tables(spark, documents):
    assert lm.score_texts(documents([])).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = lm.score_texts(documents([(only, "a b")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score)
