"""Conversations against SQL, and quotations in hand-written threads."""

import duckdb
import pytest
from llm_tables import documents, duck  # noqa: F401

from nearfold.llm import queries, threads

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, chat string, n_links int"

THREAD = [
    (1, 0, "user", "First line here.\nSecond  LINE here."),
    (1, 1, "assistant", "> First line here.\n> Second line here.\n\nMy answer."),
    (1, 2, "user", "> > first line here.\n> My answer.\nThanks\n>> Second line here.\nBye"),
    (1, 3, "assistant", ">nobody said this\nfine"),
    (1, 4, "assistant", "> Thanks\nWelcome"),
    (1, 5, "user", "Thanks"),
    (1, 6, "user", "> Thanks"),
    (2, 0, "user", "> My answer.\nFrom another conversation"),
    (2, 4, None, "> FROM another conversation\n\n  \n"),
    (2, 4, None, "> FROM another conversation\n\n  \n"),
    (2, 4, "assistant", "same turn"),
    (None, 0, "user", "no id"),
    (None, 1, "user", ">no id\nyes"),
    (3, None, "user", "> no turn\nx"),
    (3, 0, "user", None),
    (3, 1, "user", ""),
    (4, 0, "user", "é\t\nÉ > not a quote\n >neither"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def links(spark, rows):
    found = threads.link_quotes(frame(spark, rows)).collect()
    return {(r.conv_id, r.turn, r.role): (r.content, r.n_quotes, r.n_links, r.reply_to) for r in found}


def test_links(spark):
    got = links(spark, THREAD)
    assert got[1, 0, "user"] == ("First line here.\nSecond  LINE here.", 0, 0, None)
    assert got[1, 1, "assistant"] == ("My answer.", 1, 1, 0)
    # The least deep quotation decides; both turns are linked.
    assert got[1, 2, "user"] == ("Thanks\nBye", 3, 2, 1)
    assert got[1, 3, "assistant"] == ("fine", 1, 0, 2)
    assert got[1, 4, "assistant"] == ("Welcome", 1, 1, 2)
    assert got[1, 6, "user"] == ("", 1, 1, 2)  # the first to say it, not the latest
    assert got[2, 0, "user"] == ("From another conversation", 1, 0, None)
    assert got[2, 4, None] == ("", 1, 1, 0)
    assert got[None, 1, "user"] == ("yes", 1, 1, 0)
    assert got[3, None, "user"] == ("x", 1, 0, None)
    assert got[3, 0, "user"] == ("", 0, 0, None) and got[3, 1, "user"] == ("", 0, 0, 0)
    assert got[4, 0, "user"] == ("é\t\nÉ > not a quote\n >neither", 0, 0, None)
    assert len(got) == len(set(THREAD))


def oracle(con):
    return sorted(con.sql(queries.ORACLE["op9_chat_formatting"]).fetchall(), key=str)


def test_thread_as_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", THREAD)
    got = threads.format_chats(frame(spark, THREAD))
    assert sorted((tuple(r) for r in got.collect()), key=str) == oracle(con)
    chat = next(r.chat for r in got.collect() if r.conv_id == 2)
    assert chat == "<|user|>\nFrom another conversation\n<|unknown|>\n\n<|assistant|>\nsame turn\n"


def test_query_as_sql(spark, duck):
    got = queries.QUERIES["op9_chat_formatting"](spark, SF_DIR)
    assert sorted((tuple(r) for r in got.collect()), key=str) == oracle(duck)


@pytest.mark.parametrize("turns", [7, 1024])
def test_long_conversation_in_parts(spark, monkeypatch, turns):
    monkeypatch.setattr(threads, "TURNS", turns)
    rows = [(1, 3 * k, "user", f"message {k}") for k in range(200)] + [(2, 0, "user", "x")]
    parts = threads.format_chats(frame(spark, rows), part=20).orderBy("conv_id", "part").collect()
    assert [(r.conv_id, r.part, r.n_messages) for r in parts] == [(1, k, 20) for k in range(10)] + [(2, 0, 1)]
    assert "".join(r.chat for r in parts[:10]) == "".join(f"<|user|>\nmessage {k}\n" for k in range(200))


def test_no_python_in_the_plan(spark):
    df = threads.link_quotes(frame(spark, THREAD))
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_nothing(spark):
    assert threads.format_chats(frame(spark, [])).count() == 0
