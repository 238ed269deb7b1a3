from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm.shapes import rows_of
from tillscope.llm import quotes

SCHEMA = "message_id long, sent long, role string, text string, depth string"


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF_DIR}/conversations.parquet'")
    columns = ["conv_id", "turn", "parent_conv_id", "parent_turn", "first_conv_id", "first_turn", "depth", "place", "role", "text"]
    expected = con.execute(f"select {', '.join(columns)} from ({quotes.ORACLE})").fetchall()
    assert rows_of(quotes.query(spark, SF_DIR), *columns) == sorted(expected, key=repr)


def threads(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {
        (r.message_id, r.text): (r.conversation_id, r.parent_id, r.depth, r.place)
        for r in quotes.conversations(df.repartition(3)).collect()
    }


def test_nested_interleaved_and_partial_quotes(spark):
    got = threads(spark, [
        (1, 10, "user", "Shall we meet?\n\nAnd where?"),
        (2, 20, "assistant", "Yes.\n\nThe user wrote:\n> shall  WE meet?\n>\n> And where?"),
        (3, 30, "user", "> Shall we meet?\nGladly.\n> And where?\nAt home."),
        (4, 40, "user", "Fine\n>> Shall we meet?\n>>\n>> And where?\n> Yes."),
        (5, 50, "user", "no quote here"),
        (6, 60, "user", "what\n> never said"),
        (7, 70, "user", "deep\n> > > Gladly."),
        (8, 5, "user", "early\n> Yes."),
        (9, 80, "user", "> no quote here"),
    ])
    assert got == {
        (1, "Shall we meet?\n\nAnd where?"): (1, None, 0, 0),
        (2, "Yes."): (1, 1, 1, 1),
        (3, "Gladly.\nAt home."): (1, 1, 1, 2),
        (4, "Fine"): (1, 2, 2, 3),
        (5, "no quote here"): (5, None, 0, 0),
        (6, "what"): (6, None, 0, 0),
        (7, "deep"): (1, 3, 2, 4),
        (8, "early"): (8, None, 0, 0),
        (9, ""): (5, 5, 1, 1),
    }


def test_nested_announcements_and_trimmed_quotes(spark):
    long = "The user of the old address, who moved away" + " a long time ago" * 40 + ", wrote:"
    got = threads(spark, [
        (1, 10, "user", "First line here.\nSecond line there.\n\nLast one."),
        (2, 20, "assistant", "Yes.\nA wrote:\n> First line here.\n> Second line there.\n>\n> Last one."),
        (3, 30, "user", "So?\nB wrote:\n> Yes.\n> A wrote:\n>> First line here.\n>> Second line there."),
        (4, 40, "assistant", "Trimmed\n> Second line there."),
        (5, 50, "user", f"Late\n{long}\n> So?"),
        (6, 60, "user", "She wrote:\nnothing quoted"),
    ])
    assert {k: v[1] for k, v in got.items()} == {
        (1, "First line here.\nSecond line there.\n\nLast one."): None, (2, "Yes."): 1, (3, "So?"): 2,
        (4, "Trimmed"): 1, (5, "Late"): 3, (6, "She wrote:\nnothing quoted"): None,
    }


def test_ids_of_any_size_and_nulls(spark):
    """Pairs as ids: nothing is computed with them, so no id overflows or meets another."""
    big = (1 << 62) + 5
    turns = [(big, 0, "user", "one thing"), (big, 1, "assistant", "another"), (big, 70_000, "user", "far"), (1, 65_536, "user", "a"),
             (2, 0, "user", "b"), (None, 1, "user", "no conversation"), (3, None, "user", "no turn")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.text: r for r in quotes.conversations(quotes.quoting_messages(df)).collect()}
    assert len(got) == 7 and got["another"].parent_id == (big, 0) and got["far"].parent_id is None
    assert got["a"].message_id == (1, 65_536) and got["b"].conversation_id == (2, 0)
    assert got["no turn"].message_id is None and got["no conversation"].conversation_id is None


def test_nulls_repeats_and_ties(spark):
    got = threads(spark, [
        (1, 1, "user", "same words"), (2, 1, "user", "same words"), (None, 1, "user", "x\n> same words"),
        (3, None, "user", "y\n> same words"), (4, 2, None, "z\n> same words"), (5, 3, "user", None), (6, 3, "user", ""),
        (4, 2, None, "part\n> same words"),
    ])
    assert got[1, "same words"] == (1, None, 0, 0) and got[2, "same words"] == (2, None, 0, 0)
    assert got[None, "x"] == (None, None, None, None) and got[3, "y"] == (None, None, None, None)
    assert {got[4, "z"][:3], got[4, "part"][:3]} == {(1, 1, 1)} and {got[4, "z"][3], got[4, "part"][3]} == {1, 2}
    assert got[5, ""] == (5, None, 0, 0) and got[6, ""] == (6, None, 0, 0)


def test_long_chain_and_empty_table(spark):
    rows = [(1, 1, "user", "message 1")]
    rows += [(k, k, "user", f"message {k}\n> message {k - 1}") for k in range(2, 40)]
    got = threads(spark, rows)
    assert all(got[k, f"message {k}"] == (1, k - 1 if k > 1 else None, k - 1, k - 1) for k in range(1, 40))
    assert quotes.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_message(spark):
    lines = "\n".join(("> " if k % 2 else "") + f"line {k}" for k in range(20_000))
    got = threads(spark, [(1, 1, "user", "line 7"), (2, 2, "user", lines)])
    (text,) = [t for i, t in got if i == 2]
    assert got[2, text][:2] == (1, 1) and text.count("\n") == 9_999


@pytest.mark.parametrize("line, level, content", [
    ("plain", 0, "plain"), ("> a", 1, "a"), (">> a", 2, "a"), ("> > a > b", 2, "a > b"), (">", 1, ""), ("  > x", 1, "x"), ("a > b", 0, "a > b"), (">  two", 1, " two"),
])
def test_quote_levels(spark, line, level, content):
    row = spark.createDataFrame([(line,)], "text string").select(quotes.parsed_lines(F.col("text")).alias("l")).first()
    assert [tuple(x) for x in row.l] == [(level, content)]
