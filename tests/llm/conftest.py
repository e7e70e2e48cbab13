import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def documents(spark):
    """Builds a table of documents; further columns may clash with names that operators use."""

    def build(rows, extra=None):
        schema = "doc_id long, text string" + (", " + ", ".join(f"{n} {t}" for n, (t, _) in extra.items()) if extra else "")
        more = tuple(v for _, v in extra.values()) if extra else ()
        return spark.createDataFrame([tuple(r) + more for r in rows], schema)

    return build
