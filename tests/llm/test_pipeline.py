"""The pipeline, stage by stage, against what each stage may do to its input."""

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from clickfeat.llm.common import stored, table
from test_near_duplicates import shingles  # noqa: I001

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    """The input, then the output of every stage."""
    docs = table(spark, SF_DIR, "documents")
    given = [docs]
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "test-stage")
        given.append(docs)
    return [df.collect() for df in given]


def test_stages_are_the_dealt_ones():
    assert [stage.__name__ for _, stage in P.STAGES] == ["good", "unlike", "unleaked", "mixed", "sharded"]


def test_columns_and_rows(tables):
    for rows in tables[1:5]:
        assert list(rows[0].asDict()) == COLUMNS
    for before, after in zip(tables[:3], tables[1:4]):
        assert {tuple(r) for r in after} <= {tuple(r) for r in before} and 0 < len(after) <= len(before)


def test_one_of_each_group_stays(tables):
    sets = [(r.doc_id, shingles(r.text, P.WIDTH)) for r in tables[1]]
    of = {i: i for i, _ in sets}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= P.PERCENT * len(a | b):
                x, y = of[i], of[j]
                of = {n: min(x, y) if c in (x, y) else c for n, c in of.items()}
    assert sorted(r.doc_id for r in tables[2]) == sorted(set(of.values()))


def test_no_item_is_left(tables, spark):
    items = [" ".join(r.text.lower().split()) for r in table(spark, SF_DIR, "benchmark").collect()]
    joined = lambda r: " ".join(r.text.lower().split())
    assert not any(item in joined(r) for r in tables[3] for item in items)
    gone = {r.doc_id for r in tables[2]} - {r.doc_id for r in tables[3]}
    assert gone >= {r.doc_id for r in tables[2] if any(item in joined(r) for item in items)}


def test_mix_and_shards(tables):
    whole = {r.doc_id: r.text for r in tables[3]}
    cut = [r for r in tables[4] if r.text != whole[r.doc_id]]
    assert len(cut) <= len({r.source for r in tables[3]}) and all(whole[r.doc_id].split()[: len(r.text.split())] == r.text.split() for r in cut)
    assert sorted(map(str, (r[:5] for r in tables[5]))) == sorted(map(str, (r[:5] for r in tables[4])))
    sizes = [sum(r.shard == s for r in tables[5]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_odd_tables_go_through(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 3000, "en", None, 15000)]
    rows += [(i, f"A plain line of words number {i} that says a little.", "en", "s", 50) for i in range(3, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    for source, frame in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], frame).write.parquet(str(tmp_path / f"{source}.parquet"))
    for start in (docs, docs.limit(0)):
        out = start
        for _, stage in P.STAGES:
            out = stored(stage(spark, out, str(tmp_path)), "test-odd")
        assert out.columns == [*COLUMNS, "shard", "slot"]
        assert (out.count() > 0) == (not start.isEmpty())
