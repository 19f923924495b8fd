from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assetlens.llm import chat

TEXT = st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "<|", "|>", "<", "|", "\\", "\\\\", "\n", "assistant\n", "é", "ok", "<\\|"]), max_size=6).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), TEXT, st.none())
ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), ROLE, st.one_of(st.none(), TEXT)), max_size=14)
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_state(roles):
    state = "begin"
    for r in roles:
        state = chat.CHATML.moves.get(state, {}).get(r, "invalid")
    return state


def check(df):
    by = defaultdict(list)
    for r in df.collect():
        by[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    out = chat.format_chat(df).select("*", chat.read_back(F.col("formatted")).alias("back"),
                                      chat.loss_text(F.col("formatted"), F.col("segments")).alias("learned")).collect()
    assert {r["conv_id"] for r in out} == set(by) and len(out) == len(by)
    for r in out:
        key = lambda t: tuple((x is not None, x) for x in t)
        turns = [(role or "", text or "") for _, role, text in sorted(by[r["conv_id"]], key=key)]
        assert [(t["role"], t["text"]) for t in r["back"]] == turns
        assert r["learned"] == "".join(t for role, t in turns if role == "assistant")
        assert r["state"] == plain_state([role for role, _ in turns]) and r["valid"] == (r["state"] == "answered")
        at = 0
        for s in r["segments"]:  # segments cover the text, in order
            assert s["start"] == at
            at += s["length"]
        assert at == len(r["formatted"])


@settings(max_examples=15, deadline=None)
@given(ROWS)
def test_round_trip(spark, rows):
    check(spark.createDataFrame(rows, SCHEMA))


def test_nulls_ties_and_extra_columns(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (1, 1, "assistant", "x" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df.withColumn("formatted", F.lit(1)).withColumn("state", F.lit(2)).withColumn("start", F.lit(3)))
    assert chat.format_chat(df.limit(0)).count() == 0


def test_other_template(spark):
    t = chat.ChatTemplate(start="<|im_start|>", end="<|im_end|>\n", loss_roles=("user",), moves={"begin": {"user": "done"}}, accepting=("done",))
    r = chat.format_chat(spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA), t).first()
    assert r["valid"] and r["formatted"] == "<|im_start|>user\nhi<|im_end|>\n" and [s["loss"] for s in r["segments"]] == [False, True, False]
