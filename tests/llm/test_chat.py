import duckdb
import pandas as pd

from pactum.llm.chat import OP10_SQL, maximal_conversations

TURNS = [
    (1, 0, "user", "hi", "n"), (1, 1, "assistant", "hello", "n"),
    (2, 0, "user", "hi", "n"), (2, 1, "assistant", "hello", "n"), (2, 2, "user", "more", "n"),
    (3, 0, "user", "hi", "n"), (3, 1, "assistant", "hello", "n"), (3, 2, "user", "more", "n"),
    (4, 5, "user", "hi", "n"), (4, 9, "assistant", "other", "n"),
    (5, 0, "user", None, "n"), (5, 1, None, "x", "n"), (6, 0, "user", "", "n"), (6, None, "user", "first", "n"),
    (7, 0, "user", "hi", "n"), (7, 0, "user", "hi", "n"), (8, 1, "assistant", "same", "n"), (8, 1, "user", "same", "n"),
    (None, 0, "user", "lost", "n"), (9, 0, "system", "<|user|> in text", "n"), (10, 0, "user", "long " * 20000, "n"),
]
SCHEMA = "conv_id long, turn long, role string, text string, at string"


def test_matches_sql(spark):
    got = maximal_conversations(spark.createDataFrame(TURNS, SCHEMA).repartition(3)).collect()
    con = duckdb.connect()
    frame = pd.DataFrame(TURNS, columns=["conv_id", "turn", "role", "text", "at"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("given", frame)
    con.execute("CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM given")
    assert sorted(map(tuple, got)) == sorted(con.execute(OP10_SQL).fetchall())
    by_id = {r["conv_id"]: r for r in got}
    assert set(by_id) == {2, 4, 5, 6, 8, 9, 10} and by_id[2]["n_same"] == 2 and by_id[2]["n_turns"] == 3
    assert by_id[9]["rendered"].count("<|user|>") == 0


def test_empty(spark):
    assert maximal_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
