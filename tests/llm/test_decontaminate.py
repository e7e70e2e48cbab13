import random

import pyarrow as pa
import pytest

from clickfeat.llm import decontaminate as D

ITEM = [f"t{i}" for i in range(30)]


def test_tiles_are_longest_first_and_do_not_overlap():
    # Places 0-9 and 20-29 of the item, swapped in the document, and a shorter overlapping match.
    hits = [(100 + i, i) for i in range(6)] + [(50 + i, 20 + i) for i in range(6)] + [(102 + i, 20 + i) for i in range(2)]
    assert sorted(D.tile(hits, 5)) == [(50, 20, 10), (100, 0, 10)]
    assert D.tile([(0, 0), (3, 2)], 5) == [(0, 0, 5)]
    assert D.tile([], 5) == []


def test_cut_matches_go_on_with_their_rest():
    # One long match covers document words 0-14; a second of 12 words shares 5 of them and keeps its other 7.
    hits = [(i, i) for i in range(11)] + [(10 + i, 20 + i) for i in range(8)]
    assert D.tile(hits, 5) == [(0, 0, 15), (15, 25, 7)]


def leaks(spark, documents, docs, items, **options):
    items = spark.createDataFrame(items, "item_id long, text string")
    found = D.leaks(documents(docs, {"item_id": ("int", 1)}), items, **options).collect()
    return sorted((r.doc_id or -1, r.item_id or -1, r.tiles, r.covered_words, r.item_words) for r in found)


def test_moved_passages_repeats_and_gaps(spark, documents):
    moved = ITEM[20:] + ["x", "y"] + ITEM[:10]
    docs = [
        (1, " ".join(["a"] * 9 + ITEM)), (2, "\n".join(moved).upper()), (3, " ".join(ITEM[:14])), (4, " ".join(ITEM[:15])),
        (5, " ".join(ITEM[::2])), (6, None), (7, ""), (None, " ".join(ITEM)), (1, " ".join(["a"] * 9 + ITEM)),
        (8, " ".join(ITEM * 40)), (9, "t0 t1 t2"),
    ]
    items = [(10, " ".join(ITEM)), (11, None), (12, ""), (13, "t0 t1 t2"), (None, " ".join(ITEM))]
    whole = [(1, 1, 30), (1, 1, 30), (2, 2, 20), (4, 1, 15), (8, 1, 30), (-1, 1, 30)]
    expected = sorted((d, item, tiles, n, 30) for d, tiles, n in whole for item in (10, -1))
    assert leaks(spark, documents, docs, items) == expected


def test_blocks_of_items_give_the_same(spark, documents, monkeypatch):
    docs = [(i, " ".join([f"d{i}"] * 3 + [f"i{i % 4}w{k}" for k in range(12)])) for i in range(12)]
    items = [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(4)]
    whole = leaks(spark, documents, docs, items)
    monkeypatch.setattr(D, "BLOCK_BYTES", 50)
    assert leaks(spark, documents, docs, items) == whole and len(whole) == 12


def test_clean_and_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    docs = documents([(1, " ".join(ITEM)), (2, "fine"), (3, None), (None, "fine")], {"_bad": ("long", 1)})
    assert sorted(r.doc_id or 0 for r in D.clean(docs, items).collect()) == [0, 2, 3]
    assert D.clean(docs, items.limit(0)).count() == 4 and D.clean(docs.limit(0), items).count() == 0


def test_clean_rows_stay_under_null_and_repeated_ids(spark, documents):
    items = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    leak = " ".join(ITEM)
    rows = [(None, leak), (None, "fine"), (None, None), (5, leak), (5, "good"), (5, leak), (6, "good"), (7, leak)]
    kept = D.clean(documents(rows, {"_node": ("long", 1), "_id": ("string", "x")}), items)
    assert kept.columns == ["doc_id", "text", "_node", "_id"]
    found = sorted(((r.doc_id or 0, r.text or "", r["_node"], r["_id"]) for r in kept.collect()))
    assert found == [(0, "", 1, "x"), (0, "fine", 1, "x"), (5, "good", 1, "x"), (6, "good", 1, "x")]


def test_items_of_a_block():
    block = D.Items.of([1, 2], pa.array(["a b c d e f", "x"]), 5)
    assert len(block.seeds) == 2 and sorted(block.place.tolist()) == [0, 1] and len(block.words[1]) == 1


def brute_tiles(doc, item, k):
    """All pairs of places, the longest common run of open words again and again."""
    used_doc, used_item, tiles = set(), set(), []
    while True:
        best = (k - 1, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while (
                    p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]
                    and p + n not in used_doc and q + n not in used_item
                ):
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < k:
            return tiles
        used_doc.update(range(p, p + n))
        used_item.update(range(q, q + n))
        tiles.append((p, q, n))


@pytest.mark.parametrize("pairs", [1, 1 << 18])
def test_equals_brute_force(spark, documents, monkeypatch, pairs):
    monkeypatch.setattr(D, "PAIRS", pairs)
    rng = random.Random(5)
    text = lambda n, words: [rng.choice("abcdefgh"[:words]) for _ in range(n)]
    docs = [(i, text(rng.randint(0, 45), 1 + i % 5)) for i in range(40)]
    items = [(100 + i, text(rng.randint(0, 20), 1 + i % 5)) for i in range(12)]
    docs += [(50 + i, text(4, 8) + it[len(it) // 2 :] + text(3, 8) + it[: len(it) // 2]) for i, (_, it) in enumerate(items)]
    expected = []
    for d, words in docs:
        for i, it in items:
            tiles = brute_tiles(words, it, 3)
            covered = sum(n for _, _, n in tiles)
            if tiles and covered >= 0.4 * len(it):
                expected.append((d, i, len(tiles), covered, len(it)))
    found = leaks(
        spark, documents, [(d or -1, " ".join(w)) for d, w in docs], [(i, " \n".join(w)) for i, w in items], coverage=0.4, min_match=3
    )
    assert found == sorted((d or -1, *rest) for d, *rest in expected) and len(found) > 100


def test_seeds_at_very_many_places(spark, documents):
    """One word 30,000 times: millions of pairs of places, one match a diagonal."""
    docs = [(1, "w " * 30_000), (2, "v " * 10 + "w " * 250), (3, "w " * 3 + "v"), (4, "x" * 2_000_000)]
    items = [(9, "w " * 400), (8, "w " * 5)]
    assert leaks(spark, documents, docs, items) == [(1, 8, 1, 5, 5), (1, 9, 1, 400, 400), (2, 8, 1, 5, 5), (2, 9, 1, 250, 400)]
    block = D.Items.of([9], pa.array(["w " * 400]), 5)
    group = next(iter(D.words_of(pa.array(["w " * 2_000]))))
    assert len(D._matches(block, group.hashes, group.bounds)[0]) == 2_000 + 400 - 2 * 5 + 1
