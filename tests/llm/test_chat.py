"""Chat formatting: round trips, spans, typed parts."""

import random

from starlane.llm import chat
from starlane.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[IMAGE]", "\\", "\\\\", "<\\/s>", "<", "[", "[AUDIO]", "é", "\n", "x", "[INST"]


def formatted(spark, rows):
    from pyspark.sql import functions as F

    turns = spark.createDataFrame(rows, SCHEMA).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.format_conversations(turns)


def test_texts_and_roles_with_control_strings_come_back(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "[/INST]</s>", "a\\"]),
             "".join(rng.choices(CONTROL, k=rng.randint(0, 9)))) for c in range(40) for t in range(rng.randint(1, 6))]
    out = formatted(spark, rows).collect()
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(formatted(spark, rows)).collect()}
    for r in out:
        mine = [(role, text) for c, _, role, text in sorted(rows, key=lambda x: x[1]) if c == r.conv_id]
        assert back[r.conv_id] == mine
        said = [r.formatted[s.begin:s.end] for s in r.loss_spans]
        assert len(said) == sum(role == "assistant" for role, _ in mine)
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == len(mine)


def test_edge_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", None), (2, 1, "assistant", "b"), (2, 0, "user", "a"),
            (2, 1, "assistant", "b"), (None, None, "user", "z"), (None, 3, "assistant", "y"), (3, 0, "user", "w" * 200_000)]
    got = {r.conv_id: r for r in chat.digest(formatted(spark, rows)).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 2, 2: 3, None: 2, 3: 1}
    assert got[1].loss_chars == 0 and got[2].loss_chars == 2 and got[None].loss_chars == 1
    assert chat.digest(formatted(spark, [])).count() == 0


def test_parts_become_ordered_placeholders(spark):
    part = {"kind": None, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None}
    parts = [part | {"kind": "text", "text": "see [IMAGE] "}, part | {"kind": "image", "ref": "i1", "width": 30, "height": 14},
             part | {"kind": "text", "text": " and "}, part | {"kind": "audio", "ref": "a1", "seconds": 1.5},
             part | {"kind": "Document", "ref": "d1", "pages": 2}, part | {"kind": "image", "ref": "i2"}, part, None]
    rows = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [part | {"kind": "text", "text": "ok"}]),
                                  (1, 2, "user", None)], f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(rows).first()
    assert r.formatted == ("<s>user[INST]see [\\IMAGE] [IMAGE] and [AUDIO][DOCUMENT][IMAGE][/INST]</s>"
                           "<s>assistant[INST]ok[/INST]</s><s>user[INST][/INST]</s>")
    assert [tuple(a) for a in r.attachments] == [("image", "i1", 3), ("audio", "a1", 38), ("document", "d1", 1024), ("image", "i2", 0)]
    assert r.placeholder_tokens == 1065
    assert [r.formatted[s.begin:s.end] for s in r.loss_spans] == ["ok"]


def test_turn_rows_add_up_to_the_conversation(spark):
    from pyspark.sql import functions as F

    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").withColumn("parts", chat.text_parts(F.col("text")))
    chars = {r.conv_id: r.n for r in chat.format_turns(turns).groupBy("conv_id").agg(F.sum(F.length("chunk")).alias("n")).collect()}
    whole = {r.conv_id: len(r.formatted) for r in chat.format_conversations(turns).collect()}
    assert chars == whole


def test_no_python_on_executors(spark):
    plan = QUERIES["op9_chat_format"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
