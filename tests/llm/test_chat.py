"""Chat formatting: folding, reversibility, and its SQL."""

import random

import duckdb
import pytest

from pintime.llm import chat
from pintime.llm.oracle import ORACLE_SQL
from tests.llm.helpers import SF


def test_render_and_read_back():
    rng = random.Random(1)
    parts = ["\\", "#", "###", "</turn>", "<", "/turn>", "\n", ": ", "a", "### assistant: ", "é😀"]
    for _ in range(2000):
        turns = [(rng.choice(["user", "assistant", "a:b", "x\\", "###", ""]),
                  "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))))
                 for _ in range(rng.randint(0, 5))]
        text, starts, ends = chat.render(turns)
        assert chat.read_back(text) == turns
        loss = [chat.unescape(text[s:e]) for s, e in zip(starts, ends, strict=True)]
        assert loss == [t for r, t in turns if r == "assistant"]
    with pytest.raises(ValueError):
        chat.read_back("no turn")


def test_fold_of_deltas_edits_and_regenerations(spark):
    events = [
        (1, 0, 10, "start", "user", "Hel"), (1, 1, 10, "delta", None, "lo"),
        (1, 2, 11, "start", "assistant", ""), (1, 3, 11, "delta", None, "first"),
        (1, 4, 12, "start", "user", "gone"), (1, 5, 11, "regenerate", None, None),
        (1, 6, 11, "delta", None, "sec"), (1, 7, 11, "delta", None, "ond"),
        (1, 8, 10, "edit", None, "Hi"), (1, 9, 99, "edit", None, "unknown"),
        (1, 10, 13, "ping", None, "x"), (2, 0, 1, "delta", "user", "opens"), (2, 1, 1, "delta", "", None),
        (None, 0, 1, "start", None, None)]
    random.Random(3).shuffle(events)
    df = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, "
                                       "role string, text string")
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_events(df).collect()}
    assert got == {1: [("user", "Hi"), ("assistant", "second")], 2: [("user", "opens")],
                   None: [("", "")]}
    assert chat.format_events(df.limit(0)).count() == 0


def test_turns_stream_back_whole(spark):
    long = "0123456789é😀" * 500
    rows = [(1, 1, "assistant", long), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"),
            (3, None, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    events = chat.turn_events(df, delta_chars=7)
    assert events.count() > 800
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_events(events).collect()}
    assert got == {1: [("user", ""), ("assistant", long)], 2: [("", "x"), ("", "x")],
                   3: [("user", "")]}


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(ORACLE_SQL["op9_chat"]).fetchdf().sort_values("conv_id")
    got = chat.op9_chat(spark, SF).toPandas().sort_values("conv_id")
    assert got[list(want.columns)].values.tolist() == want.values.tolist()
    assert -7 in set(got.conv_id)
