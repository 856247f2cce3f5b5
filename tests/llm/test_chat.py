"""Chat formatting: round trips, the machine, and the query against plain loops."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from leadspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments string, valid int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """conv_id -> (turns, valid, fault)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        turns = [(r, x) for _, _, r, x in turns]
        state, fault = "start", None
        for i, (role, _) in enumerate(turns):
            if (state, role) in {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}:
                state = role
            elif fault is None:
                fault = i
        out[conv] = (turns, fault is None and state == "assistant", fault)
    return out


def read_back(frame, template=None):
    out = {}
    made = chat.formatted(frame, template)
    made = made.withColumn("turns", chat.turns_of(F.col("text"), template))
    made = made.withColumn("trained", chat.trained_text(F.col("segments"), template))
    for row in made.collect():
        assert row["text"] == "".join(x["text"] for x in row["segments"])
        turns = [(t["role"], t["text"]) for t in row["turns"]]
        out[row["conv_id"]] = (turns, row["valid"], row["fault"])
        assert row["trained"] == "".join(x for r, x in turns if r == "assistant")
    return out


ODD = ["", "\\", "\\\\", "###", "####", "### ", "#### ", "### : ", "</turn>", "</turn>\n", "<</turn>\n</turn", ": ", ":", ":: ", "\\### user: x</turn>\n",
       "a\\</turn>\\\n", "😀\\😀", "$1\\$1", "\n", "x" * 50_000 + "</turn>\n" * 2000]


def odd_rows():
    rows = [(i, t, role, x) for i, x in enumerate(ODD) for t, role in enumerate(["user", "assistant"])]
    rows += [(100 + i, t, x, x) for i, x in enumerate(ODD[:-1]) for t in range(2)]
    rows += [(200, None, "user", "b"), (200, 1, None, None), (200, None, "user", "a"), (None, 0, "user", "no id"), (201, 0, "system", "s")]
    rows += [(202, t, r, "x") for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(203, t, r, "x") for t, r in enumerate(["user", "user", "assistant"])] + [(204, 0, "user", "same")] * 3
    random.seed(1)
    signs = ["#", "##", " ", "<", "/turn>", "\n", "\\", ":", "é", "</turn>", "### "]
    rows += [(300 + i, t, "".join(random.choices(signs, k=4)), "".join(random.choices(signs, k=9))) for i in range(60) for t in range(3)]
    return rows


@pytest.mark.parametrize("template", [None, chat.Template(before="<|", between="|>", after="$]\n", escape="^"), chat.Template(escape="$")])
def test_round_trip_of_odd_conversations(spark, template):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)
    assert read_back(frame, template) == plain(rows)


def test_round_trip_of_given_conversations(given):
    frame = given("conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert read_back(frame) == plain(rows)
    assert read_back(frame.limit(0)) == {}


def test_control_strings_are_left_in_no_text(spark):
    frame = spark.createDataFrame([(i, 0, "assistant", x) for i, x in enumerate(ODD)], "conv_id long, turn long, role string, text string")
    for row in chat.formatted(frame).collect():
        under = [x["text"] for x in row["segments"] if x["loss"]]
        assert len(under) == 1
        assert not any(c in under[0] for c in chat.Template().controls)
        assert row["text"].count("</turn>\n") == 1


@pytest.mark.parametrize("wrong", [{"after": "x"}, {"after": "aba"}, {"between": "a\\"}, {"escape": "ab"}, {"between": "> "}, {"before": "x: y"}])
def test_templates_that_cannot_be_read_back(wrong):
    with pytest.raises(ValueError):
        chat.Template(**wrong)


def test_no_python_in_the_plan(given, capsys):
    chat.formatted(given("conversations")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan
    assert "Arrow" not in plan
