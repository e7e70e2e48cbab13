import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from clickfeat.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def fault(rows, n):
    role, text = rows[n]
    words = re.findall("[^\\x20\\x09-\\x0d]", text)
    if not words:
        return "blank"
    if rows[n] in rows[:n]:
        return "duplicate"
    return "" if words[-1] in ".!?" else "truncated"


def cheapest(rows):
    """(cost, audit, repaired rows) by trying edits in every order of letters, with the least cost of the rest remembered."""
    faults = [fault(rows, n) for n in range(len(rows))]

    def options(n, role):
        """(letter, cost, next place, made row) from a place, after a row of the given role initial."""
        if n < len(rows):
            yield "D", 4, n + 1, None
        for made in ("user", "assistant"):
            yield "I", 3, n, (made, "")
        if n < len(rows) and faults[n] not in ("blank", "duplicate"):
            extra = 3 * (faults[n] == "truncated")
            yield "K", extra, n + 1, rows[n]
            for made in ("user", "assistant"):
                yield "R", 3 + extra, n + 1, (made, rows[n][1])

    def follows(role, made):
        first = made[0][:1]
        return first in {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}[role] and first

    @lru_cache(None)
    def best(n, role, inserted):
        """Least (cost, letters, rows) from here; at most three rows are inserted in one place, more never pay."""
        found = [(0, "", ())] if n == len(rows) and role in ("", "a") else []
        for letter, cost, to, made in options(n, role):
            if letter == "I" and inserted == 3:
                continue
            now = role if made is None else follows(role, made)
            if now:
                rest = best(to, now, inserted + 1 if letter == "I" else 0)
            elif made is None:
                rest = best(to, role, 0)
            else:
                continue
            if rest:
                found.append((cost + rest[0], letter + rest[1], ((made,) if made else ()) + rest[2]))
        return min(found, default=None)

    cost, audit, kept = best(0, "", 0)
    assert SHAPE.fullmatch("".join(r[0][:1] for r in kept))
    return cost, audit, kept


def expected(rows):
    """All columns of the report of one conversation of (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    plain = [r[1:] for r in rows]
    turns = [t for t, _, _ in rows if t is not None]
    faults = [fault(plain, n) for n in range(len(rows))]
    cost, audit, kept = cheapest(plain)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = "\n".join(f"{r}:{x}" for r, x in kept)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def conversations(seed, n, longest):
    random.seed(seed)
    texts = ["One.", "Two!", "three", "", " \t\n", "One.", "\u00e9?", "No. \r", None, "x\u00a0", "four"]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", "sys", None]
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(random.randint(1, longest)):
            turn += random.choice([0, 1, 1, 1, 2])
            rows.append((None if conv == 0 else conv, random.choice([None, turn, turn, turn]), random.choice(roles), random.choice(texts)))
    return rows


def by_conversation(rows):
    grouped = {}
    for conv, *row in rows:
        grouped.setdefault(conv, []).append(tuple(row))
    return grouped


def reported(spark, rows, partitions=3):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", part string, copies int").repartition(partitions)
    return {r[0]: tuple(r)[1:] for r in repair.report(repair.repair(frame)).collect()}


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_equals_brute_force(spark, monkeypatch, block):
    """Blocks of one and of a few rows take the steps of a long conversation."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rows = conversations(block, 60, 9)
    assert reported(spark, rows) == {c: expected(r) for c, r in by_conversation(rows).items()}


def test_one_long_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 16)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        random.seed(4)
        rows = [(7, t, random.choice(["user", "assistant", "user", "system"]), random.choice(["a.", "b", f"c{t}."])) for t in range(700)]
        packed = repair.blocks(spark.createDataFrame(rows, SCHEMA))
        assert packed.select("part").distinct().count() > 2
        assert reported(spark, rows) == {7: expected([r[1:] for r in rows])}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeated_rows_are_one_run(spark):
    rows = [(1, 0, "user", "Hi.")] * 500 + [(1, 1, "assistant", "")] * 40 + [(1, 1, "assistant", "Yes.")]
    out = repair.blocks(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.initials, r.faults, r.copies) for r in out] == [("uuaa", "-db-", [1, 499, 40, 1])]
    assert reported(spark, rows) == {1: expected([r[1:] for r in rows])}


def test_messages_long_texts_and_empty_table(spark):
    long = "word " * 300_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "user", "b."), (2, None, "tool", "x." + " " * 1_000_000)]
    repaired = repair.repair(spark.createDataFrame(rows, SCHEMA))
    found = [tuple(r) for r in repair.repaired_messages(repaired).orderBy("conv_id", "part", "seq", "nth").select("conv_id", "role", "text", "edit").collect()]
    assert found == [(1, "user", long, "K"), (1, "assistant", "b.", "R")]
    assert reported(spark, rows)[2][-2] == "D"
    assert reported(spark, []) == {}


def test_walk_keeps_few_vectors():
    """Edits of a long run of rows, with the same result from any entry state as one pass over all vectors."""
    random.seed(9)
    items = [(random.choice("uasx"), random.choice("-tbd"), random.choice([1, 1, 5])) for _ in range(500)]
    vectors = [repair.FINAL]
    for item in reversed(items):
        vectors.append(repair.before(item, vectors[-1]))
    for state in repair.STATES:
        cost = 0
        for letter, place, _ in repair.walk(items, state, repair.FINAL, True):
            truncated = place < len(items) and items[place][1] == "t"
            cost += {"": 0, "I": 3, "D": 4 * (items[place][2] if place < len(items) else 0), "K": 3 * truncated, "R": 3 + 3 * truncated}[letter]
        assert cost == vectors[-1][state]


def test_query_equals_brute_force(spark, tmp_path):
    """The damage and the digest columns of the query, over the small table with NULLs added."""
    given = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.001/conversations.parquet'").fetchall()
    given += conversations(3, 40, 8) + [(None, None, None, None), (10**6, 17, "user", "Only.")]
    spark.createDataFrame(given, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    told = lambda x: " " if x is None else str(x)
    wanted = {}
    for conv, turn, role, text in given:
        harm = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        role, text = ("user" if harm == 4 else told(role)), told(text)
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        wanted.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1))
    out = queries.QUERIES["op12_structure_repair"](spark, str(tmp_path))
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"] * 2
    found = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert found == {c: expected(r) for c, r in wanted.items()}
    assert any(not r for r in wanted.values())
