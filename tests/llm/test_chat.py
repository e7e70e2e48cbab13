import hashlib

from pyspark.sql import functions as F

from clickfeat.llm import chat

SCHEMA = "tree long, msg long, parent long, role string, text string, score double, up string"
NASTY = "\\### a: </turn>\n\\\\l \\h#<>:\\c é\\"


def told(out):
    turns = F.transform(chat.parse(F.col("formatted")), lambda t: F.concat_ws("|", t["role"], t["text"]))
    found = out.select("tree", "leaf", "branch", turns.alias("t"), chat.masked(F.col("formatted"), F.col("loss_spans")).alias("m"))
    return {(r.tree, r.branch): (r.leaf, r.t, r.m) for r in found.collect()}


def test_branches_are_ranked_and_read_back(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 5.0), (1, 3, 1, "assistant", "bad", 1.0),
        (1, 4, 3, "user", "more", 1.0), (1, 5, 4, "assistant", "x", 1.0), (1, 6, 2, "user", NASTY, None),
        (2, 1, 99, "a: b#<", NASTY, 0.0), (2, 2, 1, "assistant", NASTY, 0.0),  # unknown parent, marks in the role
        (3, 1, 2, "user", "ring", 0.0), (3, 2, 1, "user", "ring", 0.0), (3, 3, 2, "user", "tail", 0.0),  # no root
        (4, 1, None, "user", "tie", 0.0), (4, 3, 1, "user", "b", 1.0), (4, 2, 1, "user", "a", 1.0),
        (None, 1, None, None, None, None), (5, 1, None, "assistant", "", 0.0),
    ]
    out = chat.format_trees(spark.createDataFrame([r + ("clash",) for r in rows], SCHEMA), keep=2)
    found = told(out)
    assert found[1, 1] == (6, ["user|q", "assistant|good", "user|" + NASTY], "good")
    assert found[1, 2] == (5, ["user|q", "assistant|bad", "user|more", "assistant|x"], "badx")
    assert found[2, 1] == (2, ["a: b#<|" + NASTY, "assistant|" + NASTY], NASTY)
    assert found[4, 1][0] == 2 and found[4, 2][0] == 3
    assert found[None, 1] == (1, ["|"], "") and found[5, 1] == (1, ["assistant|"], "")
    assert sorted(k for k in found if k[0] == 3) == []
    assert out.where("formatted like '%### assistant: good</turn>%'").count() == 1


def test_long_chain_and_empty_table(spark):
    n = 70
    rows = [(1, i, i - 1 if i > 1 else None, "user", str(i), 0.0, "") for i in range(1, n + 1)]
    chain = spark.createDataFrame(rows, SCHEMA)
    assert told(chat.format_trees(chain))[1, 1][1] == [f"user|{i}" for i in range(1, n + 1)]
    assert chat.format_trees(chain.limit(0)).collect() == []


def test_turns_with_nulls_ties_and_repeats(spark):
    given = spark.createDataFrame(
        [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, "system", None), (1, 2, None, "z"), (1, 2, None, "z")],
        "conv_id long, turn long, role string, text string",
    )
    found = told(chat.format_trees(chat.turns_as_tree(given)))
    assert found[1, 1][1] == ["system|", "user|a", "user|b", "|z", "|z"]


def test_query_holds_the_conversation_of_control_strings(spark, sf_dir):
    from clickfeat.llm.queries import ECHO, QUERIES

    row = QUERIES["op1_chat_formatting"](spark, sf_dir).where("conv_id = -7").first()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{ECHO}\nassistant\n{ECHO}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars) == (2, len(ECHO))
    assert row.loss_sha256 == hashlib.sha256(ECHO.encode()).hexdigest()
