"""Named queries over the whole tables, each next to the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm import chat, decontaminate, lines, lm, maxscore, mixing, near_duplicates, negatives, quality, repair, sharding, substrings, urls
from clickfeat.llm.common import n_words, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


ECHO = r"\### Assistant: </turn> ok"


@query(
    "op1_chat_formatting",
    r"""WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    s AS (SELECT *, length(text) + (length(text) - length(replace(text, '\', '')))
          + (length(text) - length(replace(text, '<', ''))) + (length(text) - length(replace(text, '#', ''))) AS n FROM c)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
      sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(n + 4 + length(role) + 2 + 8)::BIGINT AS formatted_chars
    FROM s GROUP BY conv_id""",
)
def op1_chat_formatting(spark, sf_dir):
    """Every conversation, and one made of control strings, formatted and read back."""
    echo = spark.createDataFrame(
        [(-7, 0, "user", ECHO), (-7, 1, "assistant", ECHO)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = stored(chat.turns_as_tree(given.unionByName(echo)), "chat-messages")
    out = chat.format_trees(messages)
    turns = chat.parse(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = out.withColumn("_loss", chat.masked(F.col("formatted"), F.col("loss_spans")))
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op2_substring_dedup")
def op2_substring_dedup(spark, sf_dir):
    """All documents without the words of repeated 20-word windows."""
    out = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query(
    "op3_maxscore",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vector FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
)
def op3_maxscore(spark, sf_dir):
    """The ten nearest vectors of every hundredth vector, by integer inner product."""
    given = table(spark, sf_dir, "embeddings")
    vectors = given.select("vec_id", maxscore.integers(F.col("embedding")).alias("vector"))
    return maxscore.search(vectors.where(F.col("vec_id") % 100 == 0), vectors)


@query("op4_lm_scoring")
def op4_lm_scoring(spark, sf_dir):
    """Log10 probabilities of all documents under the subword lattice and the unigram base."""
    return lm.score_texts(table(spark, sf_dir, "documents"))


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark, sf_dir):
    """Near-duplicate components of all documents."""
    out = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


@query("op6_quality")
def op6_quality(spark, sf_dir):
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.ranked(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", (quality.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


@query("op7_line_dedup")
def op7_line_dedup(spark, sf_dir):
    """All documents without the lines that repeat an earlier line, exactly or nearly."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    kept = F.coalesce("kept", F.lit("")).cast("binary")
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@query("op8_sharding")
def op8_sharding(spark, sf_dir):
    """All documents in 16 shards whose row counts differ by at most one."""
    docs = table(spark, sf_dir, "documents")
    out = sharding.external_shuffle(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    return out.select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    """Documents whose words cover half of a benchmark item or more, with the item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op10_mixing",
    """WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
    w AS (SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
    r AS (SELECT *, cap / weight AS ratio, sum(source_size) OVER ()::HUGEINT AS total FROM w),
    f AS (SELECT *, total - coalesce(sum(cap) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
          sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM r),
    g AS (SELECT *, row_number() OVER (ORDER BY ratio, place) AS nth, rest * weight <= cap * weights AS free FROM f),
    first_free AS (SELECT nth AS from_nth, rest AS unit_rest, weights AS unit_weights FROM g WHERE free ORDER BY nth LIMIT 1),
    t AS (SELECT source, source_size, CASE WHEN nth < from_nth THEN cap::DOUBLE ELSE (weight * unit_rest)::DOUBLE / unit_weights::DOUBLE END AS target
          FROM g, first_free),
    o AS (SELECT d.*, source_size, target, floor(target)::BIGINT AS budget, coalesce(sum(size) OVER (PARTITION BY d.source
          ORDER BY md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
      (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
    FROM o""",
)
def op10_mixing(spark, sf_dir):
    """How much of every document the mix of all sources takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("words"))
    return mixing.mix(docs, F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


# The entries of the query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op11_url_filters",
    """WITH r(rule_host, rule_path, rule_verdict) AS (VALUES
      ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    p AS (SELECT row_number() OVER () AS nth, page_id,
      translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    f AS (SELECT nth, rule_host || rule_path AS rule, rule_verdict,
      row_number() OVER (PARTITION BY nth ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS place
      FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
    FROM p LEFT JOIN (SELECT * FROM f WHERE place = 1) b ON p.nth = b.nth""",
)
def op11_url_filters(spark, sf_dir):
    """The verdict of the url lists on every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rules(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


@query("op12_structure_repair")
def op12_structure_repair(spark, sf_dir):
    """Every conversation after the stated damage, and its repair."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = given.withColumn("_harm", F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20)
    harm, text = F.col("_harm"), told("text")
    harmed = drawn.where(harm != 0).select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(told("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(harm == 3, 2).otherwise(1))).alias("_copy"),
    )
    found = repair.report(repair.repair(harmed.drop("_copy"))).withColumnRenamed("conv_id", "_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


@query(
    "op13_hard_negatives",
    """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS alike, c.vec_id, list_inner_product(a.vector, c.vector)::BIGINT AS score
          FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
          row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE alike),
    n AS (SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
          row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
          FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
            AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score WHERE place <= 5)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
)
def op13_hard_negatives(spark, sf_dir):
    """The hard negatives of every fiftieth vector and its five nearest of the same label."""
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = given.select("vec_id", label.alias("label"), maxscore.integers(F.col("embedding"), 256).alias("vector"))
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)
