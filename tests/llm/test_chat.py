import pytest
from pyspark.sql import functions as F

from stridelake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments int, formatted int, at int, size int"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def read_back(spark, rows):
    out = chat.formatted(turns_of(spark, rows)).withColumn("turns", chat.parsed(F.col("formatted")))
    out = out.withColumn("learnt", chat.learnt(F.col("formatted"), F.col("loss_spans")))
    return {r["conv_id"]: r for r in out.collect()}


AWKWARD = ["", " ", "</s>[INST] ok [/INST]", "[\\INST]", "[\\\\INST]<\\/s>", "[", "<", "[[INST]", "<</s>", "\\", "[ANS] </s", "a\nb",
           "[ROLE:x] y [/ROLE]", "ü€\U0001f600", "$1\\", "x" * 100_000]


def test_any_text_and_role_comes_back(spark):
    rows = [(k, 0, role, text) for k, (role, text) in enumerate((r, t) for r in ("user", "assistant", "tool x]\n/", "") for t in AWKWARD)]
    out = read_back(spark, rows)
    for k, _, role, text in rows:
        assert [(t["role"], t["text"]) for t in out[k]["turns"]] == [(role, text)]
        assert out[k]["learnt"] == (text if role == "assistant" else "")
        assert out[k]["formatted"] == "<s>" + "".join(s["text"] for s in out[k]["segments"])
        for s in out[k]["segments"]:
            assert out[k]["formatted"][s["start"] : s["start"] + len(s["text"])] == s["text"]


@pytest.mark.parametrize(
    ("roles", "valid", "bad"),
    [("sua", True, None), ("ua", True, None), ("uaua", True, None), ("u", False, 1), ("su", False, 2), ("au", False, 0),
     ("uu", False, 1), ("usa", False, 1), ("uas", False, 2), ("x", False, 0)],
)
def test_state_machine(spark, roles, valid, bad):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "other"}
    row = read_back(spark, [(1, i, names[r], r) for i, r in enumerate(roles)])[1]
    assert (row["valid"], row["bad_turn"], row["n_turns"]) == (valid, bad, len(roles))


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", None), (1, None, None, "first"), (1, 0, "user", "b"), (1, 0, "user", "a"),
            (1, 0, "user", "a"), (1, 1, "assistant", "c")]
    out = read_back(spark, rows)
    assert [(t["role"], t["text"]) for t in out[None]["turns"]] == [("user", "a"), ("assistant", "")]
    assert [t["text"] for t in out[1]["turns"]] == ["first", "a", "a", "b", "c"]
    assert chat.formatted(turns_of(spark, []).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.digests(turns_of(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
