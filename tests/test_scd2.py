import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from parcelake import sizing
from parcelake.operators import scd2
from parcelake.operators.scd2 import Dimension

DIM = Dimension("dim_test", "k", ("a", "b"))
COLUMNS = "k string, a string, b int"


def load(make, day, *rows_):
    return scd2.first_versions(make(COLUMNS, *rows_), DIM, F.lit(day))


def merge(make, existing, day, *rows_):
    return scd2.merge(existing, make(COLUMNS, *rows_), DIM, F.lit(day))


def versions(rows, df, key):
    return sorted(
        [(str(r["effective_from"]), str(r["effective_to"]), r["is_current"], r["a"])
         for r in rows(df) if r["k"] == key], key=lambda v: (v[0], v[1], v[2]))


def check_invariants(df):
    current = df.where("is_current").groupBy("k").count()
    assert current.where("count <> 1").count() == 0
    assert current.count() == df.select("k").distinct().count()
    assert df.select("surrogate_key").distinct().count() == df.count()
    a, b = df.alias("a"), df.alias("b")
    overlap = a.join(b, (F.col("a.k") == F.col("b.k"))
                     & (F.col("a.surrogate_key") != F.col("b.surrogate_key"))
                     & (F.col("a.effective_from") < F.col("b.effective_to"))
                     & (F.col("b.effective_from") < F.col("a.effective_to")))
    assert overlap.count() == 0


def test_merge_changed_unchanged_new_and_absent_keys(make, rows):
    first = load(make, "2024-01-01", ("chg", "x", 1), ("same", "y", 1), ("gone", "z", 1))
    df = merge(make, first, "2024-02-01", ("chg", "x2", 1), ("same", "y", 1), ("new", "n", 1))
    assert versions(rows, df, "chg") == [
        ("2024-01-01", "2024-02-01", False, "x"), ("2024-02-01", "9999-12-31", True, "x2")]
    assert versions(rows, df, "same") == [("2024-01-01", "9999-12-31", True, "y")]
    assert versions(rows, df, "gone") == [("2024-01-01", "9999-12-31", True, "z")]
    assert versions(rows, df, "new") == [("2024-02-01", "9999-12-31", True, "n")]
    check_invariants(df)


def test_run_again_on_the_same_day_changes_nothing(make, rows):
    first = load(make, "2024-01-01", ("a", "x", 1), ("b", "y", 1))
    new = [("a", "x2", 1), ("b", "y", 1), ("c", "n", 1)]
    once = merge(make, first, "2024-02-01", *new)
    twice = merge(make, once, "2024-02-01", *new)
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(twice)))


def test_change_and_revert_on_one_day_keeps_keys_apart(make, rows):
    df = load(make, "2024-01-01", ("a", "x", 1))
    for value in ("y", "x", "y"):
        df = merge(make, df, "2024-01-01", ("a", value, 1))
    assert df.count() == 4 and df.where("effective_from = effective_to").count() == 3
    check_invariants(df)


def test_change_then_revert_later(make, rows):
    df = load(make, "2024-01-01", ("a", "x", 1))
    df = merge(make, df, "2024-02-01", ("a", "y", 1))
    df = merge(make, df, "2024-03-01", ("a", "x", 1))
    assert [v[3] for v in versions(rows, df, "a")] == ["x", "y", "x"]
    check_invariants(df)


@pytest.mark.parametrize("before, after", [
    (("a", None, None), ("a", "1", None)),
    (("a", "1", None), ("a", None, 1)),        # same text, other column
    (("a", "x|1", None), ("a", "x", 1)),
    (("a", "\\N", 1), ("a", None, 1)),
    (("a", "\\|", 1), ("a", "|", 1)),
])
def test_hash_sees_nulls_and_separators(make, before, after):
    first = load(make, "2024-01-01", before)
    assert scd2.changes(first, make(COLUMNS, after), DIM, F.lit("2024-02-01")).count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_loads_equal_a_row_by_row_model(make, rows, seed):
    rng = random.Random(seed)
    model: dict[str, list[list]] = {}       # key -> [from, to, value]
    table = None
    for day in ("2024-01-01", "2024-01-01", "2024-01-05", "2024-01-09", "2024-01-09"):
        incoming = {f"k{i}": rng.choice(["x", "y", None]) for i in range(12) if rng.random() < 0.7}
        for key, value in incoming.items():
            history = model.setdefault(key, [])
            if not history or history[-1][2] != value:
                if history:
                    history[-1][1] = day
                history.append([day, "9999-12-31", value])
        batch = [(k, v, 1) for k, v in incoming.items()]
        table = load(make, day, *batch) if table is None else merge(make, table, day, *batch)
    got = sorted((r["k"], str(r["effective_from"]), str(r["effective_to"]), str(r["a"]),
                  r["is_current"]) for r in rows(table))
    assert got == sorted((k, a, b, str(v), b == "9999-12-31")
                         for k, history in model.items() for a, b, v in history)
    check_invariants(table)


def test_null_keys_never_enter(make):
    first = load(make, "2024-01-01", ("a", "x", 1))
    df = merge(make, first, "2024-02-01", (None, "x", 1), ("a", "x", 1))
    assert df.count() == 1


def test_closed_history_is_not_shuffled(make):
    first = load(make, "2024-01-01", ("a", "x", 1))
    df = merge(make, first, "2024-02-01", ("a", "y", 1))
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Join") == 1


def test_as_of_picks_the_version_of_the_day(make, rows):
    df = load(make, "2024-01-01", ("a", "x", 1), ("hot", "h", 1))
    df = merge(make, df, "2024-02-01", ("a", "y", 1))
    df = merge(make, df, "2024-02-01", ("a", "z", 1))       # y was never valid
    facts = make("id int, k string, d date", (1, "a", "2023-12-31"), (2, "a", "2024-01-01"),
                 (3, "a", "2024-01-31"), (4, "a", "2024-02-01"), (5, "q", "2024-02-01"),
                 (6, None, "2024-02-01"), (7, "a", None))
    out = rows(scd2.as_of_version(facts, df, "k", "d", ["a"], spread_by="id"), "id")
    assert {i: r["a"] for i, r in out.items()} == {
        1: None, 2: "x", 3: "x", 4: "z", 5: None, 6: None, 7: None}


@pytest.mark.parametrize("limit", [None, -1])
def test_as_of_by_sorted_days_equals_a_search_of_every_version(make, rows, monkeypatch, limit):
    """Keys with gaps, versions that were never valid, days before, between and after, nulls, repeats,
    a key with a version for each of 300 days, and one key with most rows."""
    if limit is not None:
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    rng = random.Random(5)
    day = lambda n: str(date(2024, 1, 1) + timedelta(days=n))
    versions = [("busy", day(n), day(n + 1), f"v{n}") for n in range(300)]
    for key in ("a", "b", "c"):
        cuts = sorted(rng.sample(range(400), 6))
        versions += [(key, day(x), day(y), f"{key}{x}") for x, y in zip(cuts[::2], cuts[1::2])]
        versions.append((key, day(cuts[1]), day(cuts[1]), "never"))
    versions += [("a", day(500), "9999-12-31", "last"), (None, day(0), day(900), "no key")]
    facts = [(i, rng.choice(["a", "b", "c", "busy", "busy", "busy", "none", None]),
              rng.choice([None, *map(day, range(-5, 600, 3))])) for i in range(400)]
    table = make("k string, effective_from date, effective_to date, v string", *versions)
    asked = make("id int, k string, d date", *facts)
    want = {i: next((v for key, start, end, v in versions
                     if key == k and None not in (k, d) and start <= d < end), None)
            for i, k, d in facts}
    for resolve in (scd2.as_of_sorted, scd2.as_of_version):
        out = rows(resolve(asked, table, "k", "d", ["v"], spread_by="id"))
        assert len(out) == 400 and {r["id"]: r["v"] for r in out} == want


def test_no_group_of_the_sorted_pass_grows_with_versions_or_rows(spark, make):
    """100 000 versions of one key, asked for by 100 000 rows of one day."""
    days = spark.range(100_000).select(
        F.lit("k").alias("k"), F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("effective_from"),
        F.date_add(F.lit("1800-01-02").cast("date"), F.col("id").cast("int")).alias("effective_to"),
        F.col("id").alias("v"))
    asked = spark.range(100_000).select("id", F.lit("k").alias("k"), F.lit("1800-01-11").cast("date").alias("d"))
    out = scd2.as_of_sorted(asked, days, "k", "d", ["v"], spread_by="id")
    assert out.groupBy("v").count().collect() == [(10, 100_000)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
