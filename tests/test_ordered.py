import random
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cascata.operators.lookups import add_member_flag, exact_or_latest, keys_of_both
from cascata.operators.ordered import add_delta, add_previous, first_per, latest_per

SCHEMA = "k string, m date, s int, v string"


def by_hand(rows, default=None):
    low = (date(1, 1, 1), -(10**9))
    order = lambda r: (r[1] or low[0], low[1] if r[2] is None else r[2])
    out = []
    for key in {r[0] for r in rows}:
        before = default
        for r in sorted((r for r in rows if r[0] == key), key=order):
            out.append((*r, before))
            before = r[3]
    return sorted(out, key=str)


def skewed(n, keys, seed):
    """A third of the rows belong to one key; (key, month, step) is unique."""
    rng, seen = random.Random(seed), set()
    while len(seen) < n:
        key = "hot" if rng.random() < 0.4 else rng.choice(keys)
        seen.add((key, rng.choice([None, *(date(2020, m, 1) for m in range(1, 13))]), rng.randrange(400)))
    return [(*r, rng.choice(["a", "b", "c", None])) for r in sorted(seen, key=str)]


def test_split_lag_equals_plain_lag(spark):
    rows = skewed(900, ["x", "y", None], 1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for default in (None, "first"):
        for hot in (10**9, 100, 1):
            got = add_previous(frame, ["k"], ["m", "s"], {"p": "v"}, default, hot_rows=hot)
            assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows, default)
    got = add_previous(frame, ["k"], ["m", "s"], {"p": "v"}, bounded=True)
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.integers(1, 40))
def test_split_lag_any_threshold(spark, seed, hot):
    rows = skewed(60, ["x", "y", "z", None], seed)
    got = add_previous(spark.createDataFrame(rows, SCHEMA), ["k"], ["m", "s"], {"p": "v"}, hot_rows=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows)


def test_ties_form_one_chain_whatever_the_split(spark):
    rows = [("k", date(2020, 1, 1), 0, str(i)) for i in range(200)]
    rows += [("k", date(2020, 2, 1), 0, f"n{i}") for i in range(50)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for hot in (10**9, 5):
        got = add_previous(frame, ["k"], ["m"], {"p": "v"}, hot_rows=hot).collect()
        assert len(got) == 250 and sum(r.p is None for r in got) == 1
        assert len({r.p for r in got}) == 250  # every row but the last is followed once
        firsts = [r for r in got if r.v.startswith("n") and not (r.p or "").startswith("n")]
        assert len(firsts) == 1


def test_identical_rows_follow_one_another(spark):
    rows = [("k", date(2020, 1, 1), 1, "a")] * 30 + [("k", date(2020, 2, 1), 1, "b")] * 50
    rows += [("k", date(2020, 2, 1), None, "n")] * 20 + [("other", None, None, "o")]
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = by_hand(rows)
    for hot in (10**9, 10):
        got = add_previous(frame, ["k"], ["m", "s"], {"p": "v"}, hot_rows=hot)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected


def test_delta_with_a_hot_account(spark):
    rows = [(1, date(2020, 1 + i % 12, 1), i, float(i * i % 17)) for i in range(300)] + [(2, date(2020, 1, 1), 1, 5.0)]
    frame = spark.createDataFrame(rows, "a int, m date, s int, v double")
    plain = add_delta(frame, ["a"], ["m", "s"], "v", bounded=True)
    split = add_delta(frame, ["a"], ["m", "s"], "v", hot_rows=20)
    assert sorted(plain.collect(), key=str) == sorted(split.collect(), key=str)


def test_latest_and_first(spark):
    rows = [("a", date(2020, 1, 1), 1, "x"), ("a", date(2020, 3, 1), 1, "y"), ("a", date(2020, 3, 1), 2, "z"), (None, None, 1, "n")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {r.v for r in latest_per(frame, ["k"], F.col("m")).collect()} == {"z", "n"}
    assert {r.v for r in first_per(frame, ["k"], F.col("m")).collect()} == {"x", "n"}


def test_exact_or_latest(spark):
    history = spark.createDataFrame(
        [("a", date(2020, 1, 1), "old"), ("a", date(2020, 5, 1), "new"), ("b", date(2020, 1, 1), "b")], "k string, h date, v string"
    )
    rows = spark.createDataFrame(
        [("a", date(2020, 1, 1)), ("a", date(2020, 2, 1)), ("b", date(2021, 1, 1)), ("c", date(2020, 1, 1)), (None, date(2020, 1, 1))],
        "k string, m date",
    )
    got = exact_or_latest(rows, history, "k", "m", "h")
    assert sorted(((r.k or "", r.m, r.v) for r in got.collect()), key=str) == [
        ("", date(2020, 1, 1), None), ("a", date(2020, 1, 1), "old"), ("a", date(2020, 2, 1), "new"),
        ("b", date(2021, 1, 1), "b"), ("c", date(2020, 1, 1), None),
    ]


def test_member_flags_and_key_sets(spark):
    rows = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "A"), (None, "A"), (None, "B")], "k string, c string")
    flagged = add_member_flag(rows, "k", rows.where("c = 'B'"), "f")
    assert {(r.k, r.f) for r in flagged.collect()} == {("1", True), ("2", False), (None, False)}
    both = keys_of_both(rows, "k", F.col("c") == "A", F.col("c") != "A")
    assert [r.k for r in both.collect()] == ["1"]
    numbers = spark.createDataFrame([(1,), (3,)], "k int")
    assert {(r.k, r.f) for r in add_member_flag(numbers, "k", rows, "f").collect()} == {(1, True), (3, False)}
