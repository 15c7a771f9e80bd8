"""Ties of the survivors."""

from postlens.llm import survivor


def test_equal_times_go_to_the_smallest_row(spark):
    rows = spark.createDataFrame([("g", 1, 9, 5, "x"), ("g", 2, 1, 5, "y"), ("g", 3, 1, 4, "z")], "g string, r bigint, trust int, ms bigint, at string")
    won = survivor.winners(rows, "g", "r", [survivor.Policy("at", ("time",))], "trust", "ms")
    assert [r["r"] for r in won.collect()] == [1]


def _won(spark, rows, policy, **options):
    df = spark.createDataFrame(rows, "g string, r bigint, trust int, ms bigint, v string, bound bigint")
    return {r["g"]: r["r"] for r in survivor.winners(df, "g", "r", [policy], "trust", "ms", **options).collect()}


DAY = 86_400_000


def test_votes_without_times_and_old_votes_count(spark):
    votes, now = survivor.Policy("v", ("votes",)), 1_780_000_000_000
    undated = [("u", 1, 1, None, "x", None), ("u", 2, 5, None, "y", None), ("u", 3, 5, None, "Y ", None), ("u", 4, 5, None, "y", None), ("u", 5, 5, None, " y", None)]
    # fifteen years old, two votes against one, while another group is up to date
    old = [("o", 10 + i, 3, now - 5500 * DAY, v, None) for i, v in enumerate("abb")] + [("n", 20, 3, now, "z", None)]
    future = [("f", 30, 3, now + 90_000 * DAY, "a", now), ("f", 31, 3, now, "b", now), ("f", 32, 3, now, "b", now)]
    got = _won(spark, [*undated, *old, *future], votes, latest_ms="bound")
    assert got == {"u": 2, "o": 11, "n": 20, "f": 31}


def test_groups_with_too_few_rows_are_left_out(spark):
    rows = [("a", 1, 1, 1, "x", None), ("b", 2, 1, 1, "x", None), ("b", 3, 1, 1, None, None), ("b", 3, 1, 1, None, None)]
    assert _won(spark, rows, survivor.Policy("v"), least_rows=2) == {"b": 2}


def test_unknown_trust_counts_less_than_any(spark):
    rows = [("a", 1, None, 5, "x", None), ("a", 2, 50, 5, "y", None)]
    assert _won(spark, rows, survivor.Policy("v", ("votes",))) == {"a": 2}
