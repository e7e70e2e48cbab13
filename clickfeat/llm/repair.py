"""Repair of conversations: the cheapest edits that give a conversation the shape of turns, by a checkpointed recursion.

The roles of a repaired conversation start with ``s`` or not and then alternate between user and assistant, ending with the
assistant; it may also be empty. The automaton of that shape has four states. Going backward over the rows, a vector holds
for each state the least cost of what is still to come. Vectors are kept only at checkpoints, about the square root of the rows apart;
walking forward, the vectors of one block at a time are computed again, and among the edits that keep the least cost
the one with the smallest letter is taken. So memory grows with the square root of the rows.

Long conversations are spread over tasks: rows are range-partitioned by conversation and place, and a task packs consecutive rows of
one conversation into blocks. A block acts on cost vectors as a small matrix (sums and minima), so the vectors at the
ends of blocks are the checkpoints of the whole conversation: matrices are multiplied within a partition, then over the
partitions of a conversation. Walking a block forward takes each entry state to one exit state, and these maps are
composed in the same two levels. Only blocks of several-block conversations take these steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.llm.common import stored

BLOCK_ROWS, BLOCK_CHARS = 1024, 1 << 20
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
FINE, BLANK, DUPLICATE, TRUNCATED = "-", "b", "d", "t"
# States: nothing yet, after s, after u, after a. What a kept role leads to, and what an inserted or rerouted row becomes.
STATES = range(4)
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)
MADE = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60
SPACES = " \t\n\x0b\x0c\r"
# Rows that leave a task together.
OUT_ROWS, OUT_CHARS = 512, 4 << 20

Item = tuple[str, str, int]  # initial of the role, fault, copies (blank and duplicate rows are kept as runs)
Vector = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Vector:
    """Any number of inserted rows before what follows."""
    user = min(costs[2], INSERT_COST + costs[3])
    after = min(costs[3], INSERT_COST + user)
    return min(costs[0], INSERT_COST + user), min(costs[1], INSERT_COST + user), user, after


FINAL = _with_inserts([0, FAR, FAR, 0])


def before(item: Item, after: Vector) -> Vector:
    """The cost vector before a row from the one after it."""
    initial, fault, copies = item
    costs = [DELETE_COST * copies + c for c in after]
    if fault in (FINE, TRUNCATED):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state in STATES:
            kept = KEPT[state].get(initial)
            stay = after[kept] if kept is not None else FAR
            costs[state] = min(costs[state], extra + min(stay, REROLE_COST + after[NEXT[state]]))
    return _with_inserts(costs)


def walk(items: list[Item], state: int, end: Vector, last: bool) -> Iterator[tuple[str, int, int]]:
    """(edit, place of its row, state before it) of the cheapest edits, the least by letters; ends by yielding ("", place, state).

    ``end`` are the costs after the rows; only the ``last`` block of a conversation closes it with inserted rows.
    """
    step = isqrt(len(items)) + 1
    vector, marks = end, {len(items): end}
    for place in range(len(items) - 1, -1, -1):
        vector = before(items[place], vector)
        if place % step == 0:
            marks[place] = vector
    for low in range(0, len(items), step):
        high = min(low + step, len(items))
        vectors = [marks[high]]
        for place in range(high - 1, low - 1, -1):
            vectors.append(before(items[place], vectors[-1]))
        for place in range(low, high):
            here, after = vectors[high - place], vectors[high - place - 1]
            initial, fault, copies = items[place]
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            while DELETE_COST * copies + after[state] != here[state] and INSERT_COST + here[NEXT[state]] == here[state]:
                yield INSERT, place, state
                state = NEXT[state]
            if DELETE_COST * copies + after[state] == here[state]:
                yield DELETE, place, state
            elif initial in KEPT[state] and extra + after[KEPT[state][initial]] == here[state]:
                yield KEEP, place, state
                state = KEPT[state][initial]
            else:
                yield REROLE, place, state
                state = NEXT[state]
    while last and end[state]:
        yield INSERT, len(items), state
        state = NEXT[state]
    yield "", len(items), state


def transfer(items: list[Item]) -> list[int]:
    """Least cost from every state before the rows to every state after them, row by row of the matrix."""
    columns = []
    for target in STATES:
        vector = tuple(0 if s == target else FAR for s in STATES)
        for item in reversed(items):
            vector = before(item, vector)
        columns.append(vector)
    return [min(FAR, columns[target][state]) for state in STATES for target in STATES]


def faulty(role: Column, text: Column, first: Column) -> Column:
    """The first fault of a row; ``first`` says that no earlier row has its role and text."""
    told = F.rtrim(text, F.lit(SPACES))
    return (
        F.when(told == "", BLANK)
        .when(~first, DUPLICATE)
        .when(~F.substring(told, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
    )


_PACKED = (
    "conv_id {id}, _conv string, part int, seq int, initials string, faults string, copies array<long>, roles array<string>, "
    "texts array<string>, first_turn {turn}, last_turn {turn}, n_turns long"
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict[str, pa.DataType]]]:
    """Each row, a few at a time, with the types of the columns."""
    for batch in batches:
        kinds = {f.name: f.type for f in batch.schema}
        for start in range(0, batch.num_rows, 64):
            for row in batch.slice(start, 64).to_pylist():
                yield row, kinds


def _pack(rows: DataFrame) -> DataFrame:
    """Consecutive rows of a conversation in blocks of at most ``BLOCK_ROWS`` rows and about ``BLOCK_CHARS`` characters.

    A blank or duplicate row, and the further copies of a row, are a run without its text: they are deleted in any case.
    """
    kinds = dict(rows.dtypes)
    schema = _PACKED.format(id=kinds["conv_id"], turn=kinds["turn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, block, chars, waiting, held = TaskContext.get().partitionId(), 0, None, 0, [], 0
        target = None

        def done(block: dict) -> dict:
            turns = block.pop("turns")
            return block | {"initials": "".join(block["initials"]), "faults": "".join(block["faults"]), "n_turns": len(turns)}

        for row, kinds in _rows(batches):
            if target is None:
                texts = pa.list_(pa.string())
                target = pa.schema(
                    [
                        ("conv_id", kinds["conv_id"]), ("_conv", pa.string()), ("part", pa.int32()), ("seq", pa.int32()),
                        ("initials", pa.string()), ("faults", pa.string()), ("copies", pa.list_(pa.int64())), ("roles", texts), ("texts", texts),
                        ("first_turn", kinds["turn"]), ("last_turn", kinds["turn"]), ("n_turns", pa.int64()),
                    ]
                )
            if block is None or block["_conv"] != row["_conv"] or len(block["copies"]) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                if block:
                    waiting.append(done(block))
                    held += chars
                if len(waiting) >= OUT_ROWS or held >= OUT_CHARS:
                    yield pa.RecordBatch.from_pylist(waiting, schema=target)
                    waiting, held = [], 0
                seq, chars = seq + 1, 0
                block = {"conv_id": row["conv_id"], "_conv": row["_conv"], "part": part, "seq": seq, "first_turn": None, "turns": set()}
                block |= {c: [] for c in ("initials", "faults", "copies", "roles", "texts")}
            block["last_turn"] = row["turn"]
            if row["turn"] is not None:
                block["first_turn"] = row["turn"] if block["first_turn"] is None else block["first_turn"]
                block["turns"].add(row["turn"])
            alone = row["fault"] in (FINE, TRUNCATED)
            runs = [(row["fault"], 1, row["text"])] if alone else [(row["fault"], row["copies"], "")]
            if alone and row["copies"] > 1:
                runs.append((DUPLICATE, row["copies"] - 1, ""))
            for fault, number, text in runs:
                # An empty role stands as a blank, which no state keeps.
                values = (row["role"][:1] or " ", fault, number, row["role"], text)
                for name, value in zip(("initials", "faults", "copies", "roles", "texts"), values):
                    block[name].append(value)
                chars += len(text)
        if block:
            yield pa.RecordBatch.from_pylist([*waiting, done(block)], schema=target)

    return rows.mapInArrow(run, schema)


def blocks(messages: DataFrame) -> DataFrame:
    """All rows of (conv_id, turn, role, text) in packed blocks, stored; (_conv, part, seq) is their order."""
    # Rows without NULL keys, so that equal rows meet; _conv tells a NULL id from any text.
    named = messages.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_conv"),
        F.coalesce(F.concat(F.lit("="), F.col("turn").cast("string")), F.lit("")).alias("_turn"),
    )
    hashed = named.withColumn("_key", F.sha2(F.concat("role", F.lit("\0"), F.sha2(F.col("text").cast("binary"), 256)).cast("binary"), 256))
    # Equal rows become one with a number, so a row that is repeated very often is no hot key.
    rows = hashed.groupBy("_conv", "_turn", "_key").agg(
        F.count(F.lit(1)).alias("copies"), F.any_value(F.struct("conv_id", "turn", "role", "text")).alias("row")
    )
    slim = hashed.select("_conv", "_turn", "_key", "turn")
    earliest = slim.groupBy("_conv", "_key").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "_turn")).alias("at"))
    earliest = earliest.select("_conv", "_key", F.col("at._turn").alias("_turn"), F.lit(True).alias("first"))
    marked = rows.join(earliest, ["_conv", "_turn", "_key"], "left").select("_conv", "copies", "row.*", F.coalesce("first", F.lit(False)).alias("first"))
    judged = marked.withColumn("fault", faulty(F.col("role"), F.col("text"), F.col("first"))).drop("first")
    place = [F.col("_conv"), F.col("turn").asc_nulls_first(), F.col("role")]
    # Texts of one turn and role are told apart by their start, so that the ranges need no whole texts.
    ranged = judged.repartitionByRange(*place, F.substring("text", 1, 64)).sortWithinPartitions(*place, "text")
    return stored(_pack(ranged.select("_conv", "conv_id", "turn", "role", "text", "copies", "fault")), "repair-blocks")


def _items(initials: str, faults: str, copies: np.ndarray) -> list[Item]:
    return list(zip(initials, faults, map(int, copies)))


_ROW = T.StructType([T.StructField(c, T.StringType()) for c in ("role", "text", "edit")])
_EDITED = T.StructType([T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("kept", T.ArrayType(_ROW))])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _matrices(initials: pd.Series, faults: pd.Series, copies: pd.Series) -> pd.Series:
    return pd.Series([transfer(_items(*x)) for x in zip(initials, faults, copies)], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _exits(initials: pd.Series, faults: pd.Series, copies: pd.Series, end: pd.Series, closes: pd.Series) -> pd.Series:
    """For every state before a block the state after it."""
    found = []
    for i, f, c, costs, last in zip(initials, faults, copies, end, closes):
        items, vector = _items(i, f, c), tuple(map(int, costs))
        found.append([[x for x in walk(items, s, vector, last)][-1][2] for s in STATES])
    return pd.Series(found, dtype=object)


@F.pandas_udf(_EDITED)
def _edited(
    initials: pd.Series, faults: pd.Series, copies: pd.Series, roles: pd.Series, texts: pd.Series, start: pd.Series, end: pd.Series, closes: pd.Series
) -> pd.DataFrame:
    found = []
    for i, f, c, role, text, state, costs, last in zip(initials, faults, copies, roles, texts, start, end, closes):
        items, audit, cost, kept = _items(i, f, c), [], 0, []
        for letter, place, at in walk(items, int(state), tuple(map(int, costs)), last):
            if letter == DELETE:
                audit.append(DELETE * items[place][2])
                cost += DELETE_COST * items[place][2]
            elif letter == INSERT:
                audit.append(INSERT)
                cost += INSERT_COST
                kept.append({"role": MADE[at], "text": "", "edit": INSERT})
            elif letter:
                audit.append(letter)
                cost += REROLE_COST * (letter == REROLE) + TRUNCATED_COST * (f[place] == TRUNCATED)
                kept.append({"role": MADE[at] if letter == REROLE else role[place], "text": text[place], "edit": letter})
        found.append(("".join(audit), cost, kept))
    return pd.DataFrame(found, columns=["audit", "cost", "kept"])


def _after(matrix: list[int], vector: Vector) -> Vector:
    return tuple(min(matrix[4 * s + t] + vector[t] for t in STATES) for s in STATES)


def _product(left: list[int], right: list[int]) -> list[int]:
    return [min(FAR, min(left[4 * s + m] + right[4 * m + t] for m in STATES)) for s in STATES for t in STATES]


def _ends(given: pd.DataFrame) -> pd.DataFrame:
    """The costs after each matrix of a group, from those after the last one (column ``end``)."""
    given = given.sort_values(["part", "seq"])
    ends, vector = [], tuple(given["end"].iloc[-1])
    for matrix in reversed(list(given["matrix"])):
        ends.append(list(vector))
        vector = _after(list(matrix), vector)
    return given.assign(end=ends[::-1])


def _starts(given: pd.DataFrame) -> pd.DataFrame:
    """The state before each map of a group, from the one before the first (column ``start``)."""
    given = given.sort_values(["part", "seq"])
    starts, state = [], int(given["start"].iloc[0])
    for exits in given["exits"]:
        starts.append(state)
        state = int(exits[state])
    return given.assign(start=starts)


def _folded(given: pd.DataFrame, column: str, fold) -> pd.DataFrame:
    given = given.sort_values(["part", "seq"])
    values = [list(map(int, v)) for v in given[column]]
    total = values[0]
    for value in values[1:]:
        total = fold(total, value)
    return given.head(1).assign(**{column: [total]})


def checkpoints(packed: DataFrame) -> DataFrame:
    """(_conv, part, seq, end, start, closes) of all blocks of conversations with several blocks: the costs after a block, the
    state in which it is entered, and whether it is the conversation's last."""
    shape = packed.select("_conv", "part", "seq", "initials", "faults", "copies")
    several = shape.groupBy("_conv").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("part", "seq")).alias("final")).where("n > 1")
    final = F.struct("part", "seq") == F.col("final")
    many = stored(shape.join(several, "_conv").withColumn("closes", final).drop("n", "final"), "repair-several")
    held = stored(many.select("_conv", "part", "seq", _matrices("initials", "faults", "copies").alias("matrix")), "repair-costs")
    state = "_conv string, part int, seq int, "
    parts = held.groupBy("_conv", "part").applyInPandas(lambda g: _folded(g, "matrix", _product), state + "matrix array<long>")
    base = F.array(*[F.lit(c).cast("long") for c in FINAL])
    part_ends = parts.withColumn("end", base).groupBy("_conv").applyInPandas(_ends, state + "matrix array<long>, end array<long>")
    joined = held.join(part_ends.select("_conv", "part", "end"), ["_conv", "part"])
    ends = joined.select("_conv", "part", "seq", "matrix", "end").groupBy("_conv", "part").applyInPandas(_ends, state + "matrix array<long>, end array<long>")

    walked = many.join(ends.select("_conv", "part", "seq", "end"), ["_conv", "part", "seq"])
    made = _exits("initials", "faults", "copies", "end", "closes")
    maps = stored(walked.select("_conv", "part", "seq", "end", "closes", made.alias("exits")), "repair-maps")
    slim = maps.select("_conv", "part", "seq", "exits")
    composed = lambda f, g: [g[f[s]] for s in STATES]
    parts = slim.groupBy("_conv", "part").applyInPandas(lambda g: _folded(g, "exits", composed), state + "exits array<long>")
    begun = F.lit(0).cast("long")
    part_starts = parts.withColumn("start", begun).groupBy("_conv").applyInPandas(_starts, state + "exits array<long>, start long")
    joined = slim.join(part_starts.select("_conv", "part", "start"), ["_conv", "part"])
    starts = joined.select("_conv", "part", "seq", "exits", "start").groupBy("_conv", "part").applyInPandas(_starts, state + "exits array<long>, start long")
    return maps.drop("exits").join(starts.drop("exits"), ["_conv", "part", "seq"])


def repair(messages: DataFrame) -> DataFrame:
    """The repaired conversations of (conv_id, turn, role, text), in blocks.

    A row is blank without a character other than space and tab to carriage return, a duplicate when an earlier row of its
    conversation has its role and text, truncated when its last such character is none of ``.!?``; the first that holds counts.
    Rows are kept (0, or 3 if truncated), given the role user or assistant (3, or 6 if truncated) or deleted (4; blank and
    duplicate rows always are), and empty user or assistant rows are inserted (3), so that the initials of the roles become
    ``(s?(ua)+)?`` at the least cost; of equal costs the edits whose letters ``D I K R`` come first are taken.

    Order is by turn, NULL first, then role and text. A NULL role or text is one space; an empty role has no initial and cannot be
    kept. Rows with a NULL conv_id are one conversation. Further columns are left out. An empty table gives no rows.

    One row per block: ``conv_id``, ``_conv`` (the id as text that is never NULL), ``part`` and ``seq`` (order of the blocks),
    ``audit`` (letters of the edits), ``cost``, ``kept`` (rows that are left, with role, text and letter), and of the rows as
    given ``initials``, ``faults``, ``copies``, ``first_turn``, ``last_turn`` and ``n_turns`` (distinct, NULL not counted).
    """
    packed = blocks(messages)
    plan = stored(checkpoints(packed), "repair-plan")
    whole = F.array(*[F.lit(c).cast("long") for c in FINAL])
    given = packed.join(plan, ["_conv", "part", "seq"], "left").withColumns(
        {"end": F.coalesce("end", whole), "start": F.coalesce("start", F.lit(0).cast("long")), "closes": F.coalesce("closes", F.lit(True))}
    )

    made = _edited("initials", "faults", "copies", "roles", "texts", "start", "end", "closes")
    columns = ["conv_id", "_conv", "part", "seq", "initials", "faults", "copies", "first_turn", "last_turn", "n_turns"]
    return given.select(*columns, made.alias("_made")).select(*columns, "_made.*")


def repaired_messages(repaired: DataFrame) -> DataFrame:
    """(conv_id, part, seq, nth, role, text, edit): the rows that are left, in the order of part, seq and nth."""
    return repaired.select("conv_id", "part", "seq", F.posexplode("kept").alias("nth", "row")).select("conv_id", "part", "seq", "nth", "row.*")


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation: counts of gaps, faults and illegal neighbours, cost, audit, and the hash of the repaired text.

    A hash reads its text in order, so the blocks of a conversation stream through one task; it holds one block at a time and
    the letters of the audit.
    """
    kind = dict(repaired.dtypes)["conv_id"]
    schema = (
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    order = repaired.repartition("_conv").sortWithinPartitions("_conv", "part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        total, waiting, held, target = None, [], 0, None

        def done(total: dict) -> dict:
            spread = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
            made = total | {"gaps": spread, "audit": "".join(total["audit"]), "repaired_sha256": total["hash"].hexdigest()}
            return {n: made[n] for n in names}

        for row, kinds in _rows(batches):
            if target is None:
                plain = {"conv_id": kinds["conv_id"], "audit": pa.string(), "repaired_sha256": pa.string()}
                target = pa.schema([(n, plain.get(n, pa.int64())) for n in names])
            if total is None or total["_conv"] != row["_conv"]:
                if total:
                    waiting.append(done(total))
                    held += len(waiting[-1]["audit"])
                if len(waiting) >= OUT_ROWS or held >= OUT_CHARS:
                    yield pa.RecordBatch.from_pylist(waiting, schema=target)
                    waiting, held = [], 0
                total = {"conv_id": row["conv_id"], "_conv": row["_conv"], "low": None, "high": None, "turns": 0, "cost": 0}
                total |= {"audit": [], "hash": hashlib.sha256(), "role": "", "between": ""}
                total |= {c: 0 for c in ("blank", "duplicate", "truncated", "illegal")}
            for initial, fault, copies in _items(row["initials"], row["faults"], row["copies"]):
                if fault != FINE:
                    total[{BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}[fault]] += copies
                legal = not total["role"] or total["role"] + initial in LEGAL
                # Copies stand next to each other, and a role never follows itself.
                total["illegal"] += copies - legal
                total["role"] = initial
            if row["n_turns"]:
                # Turns come in order, so only the one at the edge of two blocks is in both.
                total["turns"] += row["n_turns"] - (total["high"] == row["first_turn"])
                total["low"] = row["first_turn"] if total["low"] is None else total["low"]
                total["high"] = row["last_turn"]
            for kept in row["kept"]:
                total["hash"].update(f"{total['between']}{kept['role']}:{kept['text']}".encode())
                total["between"] = "\n"
            total["audit"].append(row["audit"])
            total["cost"] += row["cost"]
        if total:
            yield pa.RecordBatch.from_pylist([*waiting, done(total)], schema=target)

    columns = ["conv_id", "_conv", "initials", "faults", "copies", "first_turn", "last_turn", "n_turns", "audit", "cost", "kept"]
    return order.select(*columns).mapInArrow(run, schema)
