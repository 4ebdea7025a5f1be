"""Script queries beside their SQL where quoted options have white space of every kind at their ends."""

import random

import duckdb
import pytest

from weftline.plans import catalog

NAMES = ["branching_walk", "choice_rows_walk", "unanswered_rest"]


@pytest.fixture(scope="module")
def talks(spark, tmp_path_factory):
    rng, path = random.Random(5), str(tmp_path_factory.mktemp("talks"))
    white = [" ", "\t", "\n", "\r", "\x0b", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "a"]
    word = lambda: "".join(rng.choice([*white, "b"]) for _ in range(2)) + "c" * 16 + "".join(rng.choice(white) for _ in range(2)) + "d" * rng.randrange(9)
    rows = [(c, t, "user", word()) for c in range(90) for t in range(rng.randrange(1, 6))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", NAMES)
def test_ends_of_options(spark, talks, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{talks}/conversations.parquet/*.parquet'")
    want = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = catalog.queries()[name](spark, talks).select(names).collect()
    assert got and sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
