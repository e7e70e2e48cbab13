"""Scores of texts under a subword lattice, next to an add-a-tenth unigram base.

The pieces are those of an existing vocabulary file. Words are independent; the probability of a word is the sum over all
its segmentations into pieces of the product of piece probabilities, by a forward recursion in log space over the bytes
of the word, a space in front marking its start. The piece scores start from the file's order of pieces (probability in
inverse proportion to the rank) and are estimated by expectation over all segmentations of all distinct training words.
Beside the pieces, a word's lattice has one edge for the whole word as it was counted in training: with c of N training
tokens, the sum L over all segmentations and T, one more than the number of distinct tokens, a word has the probability
(c + T * L) / (N + T). The log probability of a text is the sum over its words plus that of the end; ``lattice_score`` is the same sum of log L alone.

Counts and lattices are computed once per distinct word. Texts meet them in two ways: the most frequent words (a bounded
table) go to every task, all other words by a join on the word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import stored
from clickfeat.llm.near_duplicates import with_nodes
from clickfeat.llm.words import mix, spelled, words_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2  # of estimation
TOP_WORDS = 200_000  # words sent to every task; the others are joined
CELLS = 1 << 18  # bytes of words in one block of the recursion
_BASE = 0x100000001B3D
_ADDED = 0.1


@dataclass
class Pieces:
    """Pieces by the hash of their bytes: ``keys`` sorted, ``logp`` the natural log probability of each."""

    keys: np.ndarray
    logp: np.ndarray
    longest: int
    end: float
    present: np.ndarray

    def with_counts(self, counts: np.ndarray, ends: float) -> Pieces:
        counts = counts + _ADDED
        total = counts.sum() + ends + _ADDED
        return Pieces(self.keys, np.log(counts / total), self.longest, math.log((ends + _ADDED) / total), self.present)


def _prefix_hashes(cells: np.ndarray) -> np.ndarray:
    powers = _powers(cells.shape[1])
    out = np.zeros((cells.shape[0], cells.shape[1] + 1), np.uint64)
    np.cumsum((cells.astype(np.uint64) + np.uint64(1)) * powers, axis=1, out=out[:, 1:])
    return out


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces of a vocabulary file, and all single bytes. Read on the driver only."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks: dict[bytes, int] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        if raw and b" " not in raw[1:]:
            ranks.setdefault(raw, len(ranks) + 1)
    for byte in range(256):
        ranks.setdefault(bytes([byte]), len(ranks) + 1)
    keys = np.zeros(len(ranks), np.uint64)
    for place, raw in enumerate(ranks):
        keys[place] = mix(_prefix_hashes(np.frombuffer(raw, np.uint8)[None, :])[:, -1])[0]
    order = np.argsort(keys)
    weight = 1 / np.array(list(ranks.values()), float)[order]
    present = np.zeros(1 << 20, bool)
    present[(keys & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return Pieces(keys[order], np.log(weight / weight.sum()), max(map(len, ranks)), 0.0, present)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index, bytes with a space in front) of words of one length, in blocks."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for same in np.split(order, cuts):
        if not len(same):
            continue
        n = int(lengths[same[0]])
        step = max(1, CELLS // (n + 1))
        for i in range(0, len(same), step):
            index = same[i : i + step]
            cells = np.full((len(index), n + 1), 32, np.uint8)
            cells[:, 1:] = data[offsets[index][:, None] + np.arange(n)]
            yield index, cells


def _edges(pieces: Pieces, cells: np.ndarray, first: int = 1, last: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each end j from ``first`` to ``last``: (first start, j, piece of each start and -1 for none, its log
    probability), starts by column."""
    sums, n = _prefix_hashes(cells), cells.shape[1]
    down = _powers(n, pow(_BASE, -1, 1 << 64))
    for j in range(first, (last or n) + 1):
        i = max(0, j - pieces.longest)
        key = mix((sums[:, j : j + 1] - sums[:, i:j]) * down[i:j])
        piece = np.full(key.shape, -1, np.int32)
        maybe = np.flatnonzero(pieces.present[(key & np.uint64(0xFFFFF)).astype(np.int32)])
        found = key.ravel()[maybe]
        at = np.minimum(np.searchsorted(pieces.keys, found), len(pieces.keys) - 1)
        at[pieces.keys[at] != found] = -1
        piece.ravel()[maybe] = at
        yield i, j, piece, np.where(piece >= 0, pieces.logp[piece], -np.inf)


def _sum_log(terms: np.ndarray) -> np.ndarray:
    most = terms.max(axis=1)
    return most + np.log(np.exp(terms - most[:, None]).sum(axis=1))


def log_marginals(pieces: Pieces, words: pa.Array) -> np.ndarray:
    """Natural log probability of each word, over all its segmentations."""
    out = np.zeros(len(words))
    for index, cells in _by_length(words):
        alpha = np.full((cells.shape[0], cells.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0
        for i, j, _, logp in _edges(pieces, cells):
            alpha[:, j] = _sum_log(alpha[:, i:j] + logp)
        out[index] = alpha[:, -1]
    return out


def expected_counts(pieces: Pieces, words: pa.Array) -> np.ndarray:
    """How often each piece is used in expectation over all segmentations of the words. The edges of ``CELLS`` bytes are
    held at a time; those of a longer word are found again on the way back."""
    total = np.zeros(len(pieces.keys))
    for index, cells in _by_length(words):
        n = cells.shape[1]
        alpha, beta = np.full((2, len(index), n + 1), -np.inf)
        alpha[:, 0] = beta[:, n] = 0
        step = max(1, CELLS // len(index))
        blocks = [(first, min(first + step - 1, n)) for first in range(1, n + 1, step)]
        for block in blocks:
            edges = list(_edges(pieces, cells, *block))
            for i, j, _, logp in edges:
                alpha[:, j] = _sum_log(alpha[:, i:j] + logp)
        for block in reversed(blocks):
            if block is not blocks[-1]:
                edges = list(_edges(pieces, cells, *block))
            for i, j, piece, logp in reversed(edges):
                through = logp + beta[:, j : j + 1]
                share = np.exp(alpha[:, i:j] + through - alpha[:, n:])
                used = piece >= 0
                np.add.at(total, piece[used], share[used])
                beta[:, i:j] = np.logaddexp(beta[:, i:j], through)
    return total


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) of all words of ``docs`` (text, held_out); c counts the rows that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for words in words_of(batch.column("text"), lower=True):
                _, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
                learned = ~np.repeat(held[words.first : words.first + words.rows], words.counts())
                times = np.bincount(inverse[learned], minlength=len(first))
                yield pa.RecordBatch.from_arrays([spelled(words, first), pa.array(times, pa.int64())], ["word", "c"])

    return docs.select("text", "held_out").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def estimate(counts: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Piece probabilities after ``rounds`` of expectation over the distinct counted words and one end. The vocabulary
    bounds what a task returns and what the driver sums."""
    spark = counts.sparkSession
    known = counts.where("c > 0").select("word")
    for _ in range(rounds):
        given = spark.sparkContext.broadcast(pieces)

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(given.value.keys))
            for batch in batches:
                total += expected_counts(given.value, batch.column("word"))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["piece", "n"])

        sums = known.mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        found = np.zeros(len(pieces.keys))
        found[sums.column("piece").to_numpy()] = sums.column("n").to_numpy()
        pieces = pieces.with_counts(found, 1)
    return pieces


def mixed(c, lattice, tokens: int, types: int):
    """log10 of (c + types * L) / (tokens + types), for the natural logarithm of L."""
    with np.errstate(divide="ignore"):
        counted = np.log(np.asarray(c, float))
    return (np.logaddexp(counted, math.log(types + 1) + lattice) - math.log(tokens + types + 1)) / math.log(10)


def word_scores(counts: DataFrame, pieces: Pieces, tokens: int, types: int) -> DataFrame:
    """``counts`` plus ``logp``, the log10 probability of each word, and ``lattice``, that of its pieces alone."""
    given = counts.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lattice = log_marginals(given.value, batch.column("word"))
            logp = mixed(batch.column("c").to_numpy(), lattice, tokens, types)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(logp), pa.array(lattice / math.log(10))], ["word", "c", "logp", "lattice"]
            )

    return counts.select("word", "c").mapInArrow(run, "word string, c long, logp double, lattice double")


def score_texts(docs: DataFrame, vocabulary: str = VOCABULARY, held_out=is_held_out, top_words: int = TOP_WORDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score) for every row of ``docs`` (doc_id, text).

    Words are taken without the case of A-Z; every text ends with one end token, so an empty or NULL text has one token.
    ``held_out`` says which rows not to learn from. Repeated rows give equal results, each counted in training. A NULL id
    counts as the empty text for the fold. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out(F.col("doc_id")))
    counts = stored(count_words(rows), "lm-counts")
    learned, vocabulary_size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    ends = rows.where(~F.col("held_out")).count()
    train_tokens = learned + ends
    types = vocabulary_size + (ends > 0)
    below = train_tokens + 0.1 * (types + 1)
    pieces = estimate(counts, load_pieces(vocabulary))
    scores = stored(word_scores(counts, pieces, train_tokens, types), "lm-words")

    top = scores.orderBy(F.desc("c"), "word").limit(top_words).toArrow().combine_chunks()
    hashes = np.concatenate([w.hashes for w in words_of(top.column("word"))] or [np.zeros(0, np.uint64)])
    order = np.argsort(hashes)
    times, logp, lattice = (top.column(c).to_numpy()[order] for c in ("c", "logp", "lattice"))
    base = np.log10((times + 0.1) / below)
    given = spark.sparkContext.broadcast((hashes[order], (times > 0).astype(np.int64), base, logp, lattice))
    end = (
        int(ends > 0), math.log10((ends + 0.1) / below), float(mixed(ends, pieces.end, train_tokens, types)), pieces.end / math.log(10)
    )
    names = ["node", "word", "times", "doc_id", "held_out", "n_tokens", "n_known", "base", "logp", "lattice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known, base, logp, lattice = given.value
        for batch in batches:
            nodes, ids = batch.column("_node").to_numpy(), batch.column("doc_id")
            for words in words_of(batch.column("text"), lower=True):
                n, counts = words.rows, words.counts()
                row = np.repeat(np.arange(n), counts)
                at = np.minimum(np.searchsorted(keys, words.hashes), max(len(keys) - 1, 0))
                common = keys[at] == words.hashes if len(keys) else np.zeros(len(row), bool)
                of, hit = row[common], at[common]
                add = lambda x: np.bincount(of, weights=x[hit], minlength=n) if len(of) else np.zeros(n)  # noqa: E731, B023
                own = slice(words.first, words.first + n)
                mine = nodes[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mine), pa.array([f"\n{x}" for x in mine]), pa.nulls(n, pa.int64()), ids[own],
                        batch.column("held_out")[own], pa.array(counts + 1, pa.int64()),
                        pa.array(add(known).astype(np.int64) + end[0]), pa.array(add(base) + end[1]), pa.array(add(logp) + end[2]),
                        pa.array(add(lattice) + end[3]),
                    ],
                    names,
                )
                rare = np.flatnonzero(~common)
                if not len(rare):
                    continue
                sort = rare[np.lexsort((words.hashes[rare], row[rare]))]
                new = np.ones(len(sort), bool)
                new[1:] = (words.hashes[sort][1:] != words.hashes[sort][:-1]) | (row[sort][1:] != row[sort][:-1])
                first = np.flatnonzero(new)
                many = np.diff(np.append(first, len(sort)))
                empty = lambda kind: pa.nulls(len(first), kind)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mine[row[sort[first]]]), spelled(words, sort[first]), pa.array(many, pa.int64()),
                        empty(pa.int64()), empty(pa.bool_()), empty(pa.int64()), empty(pa.int64()),
                        empty(pa.float64()), empty(pa.float64()), empty(pa.float64()),
                    ],
                    names,
                )

    schema = "node long, word string, times long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, logp double, lattice double"
    parts = with_nodes(rows).select("_node", "doc_id", "text", "held_out").mapInArrow(run, schema)
    # A text's own line has a key that no word has, and meets nothing in the join.
    words = scores.select("word", F.col("c").alias("_c"), F.col("logp").alias("_logp"), F.col("lattice").alias("_lattice"))
    joined = parts.join(words, "word", "left")
    each = F.log10((F.col("_c") + 0.1) / F.lit(below))
    line = joined.select(
        "node", "doc_id", "held_out", "n_tokens",
        F.when(F.col("times").isNull(), 1).otherwise(0).alias("copies"),
        F.coalesce("n_known", F.when(F.col("_c") > 0, F.col("times")), F.lit(0)).alias("n_known"),
        F.coalesce("base", F.col("times") * each).alias("base"),
        F.coalesce("logp", F.col("times") * F.col("_logp")).alias("logp"),
        F.coalesce("lattice", F.col("times") * F.col("_lattice")).alias("lattice"),
    )
    sums = line.groupBy("node").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("copies").alias("copies"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "logp", "lattice")],
    )
    out = sums.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    share = lambda c: F.expr(f"{c} div copies")
    return out.select(
        "doc_id", "held_out", share("n_tokens").alias("n_tokens"), share("n_known").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("logp") / F.col("copies")).alias("score"),
        (F.col("lattice") / F.col("copies")).alias("lattice_score"),
    )
