"""Chat formatting: DuckDB, round trips, templates that rewrite history."""

import json

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import chat
from riskspark.llm.queries import QUERIES, SQL
from tests.conftest import SF01

pieces = st.lists(st.sampled_from([*chat.Instruct.controls, "\\", " ", "] ", "a", "é", "\n", "[", "<"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), pieces), pieces), max_size=6))
@settings(max_examples=400, deadline=None)
def test_round_trip(turns):
    t = chat.Instruct()
    out, spans, rewrites = chat.locate(turns, t)
    assert rewrites == [] and len(spans) == len(turns)
    got = [(t.role(out[s["start"] : s["text_start"]]), t.unescape(out[s["text_start"] : s["text_end"]])) for s in spans]
    assert got == turns and [s["loss"] for s in spans] == [r == "assistant" for r, _ in turns]
    assert out == t(turns) and (spans[-1]["end"] if spans else 0) == len(out)


def test_history_rewrites_are_found():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    drops = lambda ts: "".join(f"<{r}>{t}" for r, t in ts[-3:])
    assert chat.locate(turns, drops)[1:] == ([], [3])
    ends = lambda ts: "".join(f"<{r}>{t}" for r, t in ts) + "<eos>"
    assert chat.locate(turns, ends)[1:] == ([], [0, 1, 2, 3])
    plain = lambda ts: "<bos>" + "".join(f"<{r}>{t}" for r, t in ts)
    out, spans, rewrites = chat.locate(turns, plain)
    assert not rewrites and [out[s["text_start"] : s["text_end"]] for s in spans] == list("abcd")


def texts(turns, render):
    out, spans, rewrites = chat.locate(turns, render)
    assert not rewrites
    return [None if s["text_start"] is None else out[s["text_start"] : s["text_end"]] for s in spans]


TURNS = [("user", "hi there"), ("assistant", 'say "x"'), ("user", ""), ("assistant", "\x01\u00e9"), ("user", "hi"), ("assistant", "Zk3")]


def test_encoded_texts_are_located():
    coded = lambda ts: "".join(f"<{r}>{json.dumps(t)}\n" for r, t in ts)
    assert texts(TURNS, coded) == [json.dumps(t)[1:-1] for _, t in TURNS]
    whole = lambda ts: "".join(json.dumps({"role": r, "content": t}) for r, t in ts)
    assert texts(TURNS, whole) == [json.dumps(t)[1:-1] for _, t in TURNS]


def test_frames_that_change_with_the_place_are_found_again():
    dated = lambda ts: "".join(("[day %d]" % i if i % 4 == 0 else "") + f"<{r}>{t}" for i, (r, t) in enumerate(ts))
    assert texts(TURNS * 2, dated) == [t for _, t in TURNS * 2]
    bare = lambda ts: "".join(("[day %d]" % i if i % 4 == 0 else "") + t for i, (_, t) in enumerate(ts))
    assert texts(TURNS * 2, bare) == [t for _, t in TURNS * 2]


def test_texts_that_leave_no_trace_are_reported(spark):
    counted = lambda ts: "".join(f"<{r}>" if r == "assistant" else f"<{r}>{t}" for r, t in ts)
    assert texts(TURNS, counted) == ["hi there", None, "", None, "hi", None]
    odd = lambda ts: "".join(f"<{r}:{len(t)}>{t}" for r, t in ts)  # noqa: E731 -- the mark depends on the text
    assert texts([("user", "four"), ("user", "seven..")], odd)[1] in (None, "7>seven..")
    rows = [(1, i, r, t) for i, (r, t) in enumerate(TURNS)]
    row = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), counted).first()
    assert row.unlocated == [1, 3, 5] and [s.loss for s in row.spans] == [False] * 6


def duck(con):
    rel = con.execute(SQL["op7_chat_formatting"])
    return [c[0] for c in rel.description], sorted(rel.fetchall(), key=repr)


def test_query_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF01}/conversations.parquet')")
    names, want = duck(con)
    got = QUERIES["op7_chat_formatting"](spark, SF01)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == want


def test_edge_rows_equal_duckdb(spark, tmp_path):
    rows = [(1, 2, "assistant", None), (1, 1, None, "x"), (1, None, "user", ""), (2, 0, "user", "\\</s> \\\\[INST]"), (2, 0, "user", "\\</s> \\\\[INST]"), (2, 0, "assistant", "z[/ROLE]"), (None, 0, "tool] ", "é" * 100000), (None, 1, "[ROLE x", "y")]
    df = spark.createDataFrame([(*r, "extra", 5) for r in rows], "conv_id long, turn long, role string, text string, formatted string, spans int")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    names, want = duck(con)
    got = QUERIES["op7_chat_formatting"](spark, str(tmp_path))
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == want
    t = chat.Instruct()
    assert chat.read_back(chat.format_conversations(df.limit(0), t), t).collect() == []
