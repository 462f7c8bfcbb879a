"""Conversations without an id."""

import duckdb

from vitrine.llm import chat


def test_null_conversation(spark, tmp_path):
    """Rows with a null conv_id are one conversation; the others are as the SQL, which leaves these out, has them."""
    rows = [(None, 1, "assistant", "b"), (1, 0, "user", "q"), (None, 0, "user", "a"), (1, 1, "assistant", "r<s>")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op10_chat(spark, str(tmp_path)).collect()}
    assert set(got) == {None, -1, 1} and (got[None].n_turns, got[None].loss_chars) == (2, 1)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    rel = con.execute(chat.ORACLE)
    names = [d[0] for d in rel.description]
    assert {r[names.index("conv_id")]: dict(zip(names, r)) for r in rel.fetchall()} == {i: got[i].asDict() for i in (-1, 1)}
