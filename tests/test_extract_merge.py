import datetime as dt
import random

import golden
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from ordervane.operators import extract, merge

NOW = dt.datetime(2024, 3, 1, 12, 30, 15, 999)


def source(spark):
    at = dt.datetime
    return golden.frame(
        spark, [
            (1, "active", at(2024, 2, 8, 23, 59)), (2, "active", at(2024, 2, 9)),
            (3, "active", at(2024, 2, 9, 0, 1)), (4, "active", at(2024, 2, 11)),
            (5, "Active", at(2024, 2, 11)), (6, "active", None),
        ],
        "id int, status string, created_at timestamp_ntz",
    )


def test_extract_is_strictly_after_mark_less_a_day(spark):
    rows = extract.incremental_extract(source(spark), "2024-02-10T00:00:00", ordered_by="id").collect()
    assert [r.id for r in rows] == [3, 4]


def test_extract_pushes_both_conditions(spark, tmp_path):
    source(spark).write.parquet(str(tmp_path / "s"))
    df = extract.incremental_extract(spark.read.parquet(str(tmp_path / "s")), "2024-02-10T00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(status,active)" in pushed and "GreaterThan(created_at" in pushed


@pytest.mark.parametrize("mark, start", [
    ("2024-02-10T00:00:00", "2024-02-09 00:00:00"),
    (dt.datetime(2024, 2, 10, 5, 0, 0, 123), "2024-02-09 05:00:00"),
    ("2024-02-10T03:00:00+03:00", "2024-02-09 00:00:00"),
    (None, "2024-01-30 12:30:15"),
    ("no mark", "2024-01-31 12:30:15"),
])
def test_extract_start(mark, start):
    assert str(extract.extract_start(mark, NOW)) == start


def test_next_mark(spark):
    found = extract.high_water_mark(source(spark)).first()
    assert (found.extract_count, found.new_mark) == (6, dt.datetime(2024, 2, 11))
    assert extract.next_mark(6, found.new_mark, NOW) == "2024-02-11T00:00:00"
    assert extract.next_mark(0, None, NOW) is None
    only_null = extract.high_water_mark(source(spark).filter("created_at is null")).first()
    assert extract.next_mark(only_null.extract_count, only_null.new_mark, NOW) == NOW.isoformat()


SCHEMA = "k int, seq int, v string"


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_later_row_of_a_batch_wins_and_repeats_change_nothing(spark):
    target = golden.frame(spark, [(1, 1, "old"), (2, 9, "kept")], SCHEMA)
    batch = golden.frame(spark, [(1, 1, "a"), (1, 2, "b"), (3, 1, "new")], SCHEMA)
    once = merge.upsert(target, batch, ["k"], ["seq"])
    assert as_set(once) == [(1, 2, "b"), (2, 9, "kept"), (3, 1, "new")]
    assert as_set(merge.upsert(once, batch, ["k"], ["seq"])) == as_set(once)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from("xyz"))), min_size=1, max_size=20))
def test_latest_per_key_against_brute_force(spark, rows):
    def rank(row):  # nulls lowest
        return tuple((value is not None, value if value is not None else 0) for value in row[1:])

    best = {}
    for row in rows:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    seen = merge.latest_per_key(golden.frame(spark, rows, SCHEMA), ["k"], ["seq"])
    assert as_set(seen) == sorted(best.values(), key=repr)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    shuffled = random.Random(7).sample(range(30_000), 30_000)
    rows = [(0 if i % 3 == 0 else i, i, "v") for i in shuffled]
    df = golden.frame(spark, rows, SCHEMA)
    latest = merge.latest_per_key(df, ["k"], ["seq"])
    assert latest.count() == 20_001
    assert latest.filter("k = 0").first().seq == 29_997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(k")


def test_columns_that_are_all_keys(spark):
    df = golden.frame(spark, [(1, "a"), (1, "a")], "k int, v string")
    assert as_set(merge.latest_per_key(df, ["k", "v"], [])) == [(1, "a")]
