import zlib
from collections import Counter, defaultdict

from clickfeat.llm import sharding
from clickfeat.llm.queries import QUERIES


def checked(out, rows, shards):
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    sizes = [len(v) for v in slots.values()] + [0] * (shards - len(slots))
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == rows
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))


def test_shards_are_even_and_reruns_agree(spark, documents):
    rows = [(i, f"text {i} " * (i % 50)) for i in range(500)] + [(None, None), (None, ""), (7, "again"), (7, "again")]
    given = documents(rows, {"shard": ("string", "x"), "_row": ("int", 1), "row": ("int", 2)})
    first = sharding.external_shuffle(given.repartition(3), shards=7, bucket_bytes=2000)
    second = sharding.external_shuffle(given.repartition(5), shards=7, bucket_bytes=2000).collect()
    out = first.collect()
    assert first.columns == ["doc_id", "text", "_row", "row", "shard", "slot"]
    checked(out, len(rows), 7)
    assert sorted(map(str, out)) == sorted(map(str, second))
    order = [r.doc_id for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order, key=lambda x: (x is not None, x or 0)) and Counter(order) == Counter(i for i, _ in rows)


def test_a_hot_id_is_spread(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 20)
    rows = [(1, f"same id {i % 3}" * 20) for i in range(300)] + [(i, "x") for i in range(2, 50)]
    out = sharding.external_shuffle(documents(rows), shards=4, bucket_bytes=3000).collect()
    checked(out, len(rows), 4)
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)


def test_few_rows_and_none(spark, documents):
    checked(sharding.external_shuffle(documents([(1, "a"), (2, None)])).collect(), 2, 16)
    assert sharding.external_shuffle(documents([])).collect() == []


def test_written_shards_hold_their_rows_in_order(spark, documents, tmp_path):
    out = sharding.external_shuffle(documents([(i, str(i)) for i in range(40)]), shards=3)
    sharding.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.shard, r.slot, r.doc_id) for r in back.collect()) == sorted((r.shard, r.slot, r.doc_id) for r in out.collect())


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op8_sharding"](spark, sf_dir).collect()
    checked(out, len(docs), 16)
    for r in out:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
