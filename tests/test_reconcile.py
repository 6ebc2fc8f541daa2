import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import reconcile as module
from sluicegate.operators.reconcile import reconcile

SCHEMA = "id bigint, v string, w double"


def brute(source, snapshot):
    a, b = Counter(source), Counter(snapshot)
    out = set()
    for row in a | b:
        if a[row] == b[row]:
            continue
        here, there = (sum(n for r, n in c.items() if r[0] == row[0]) for c in (a, b))
        if not there:
            kind = "lost"
        elif not here:
            kind = "extra"
        elif a[row] and b[row]:
            kind = "doubled" if b[row] > a[row] else "thinned"
        else:
            kind = "changed"
        out.add((kind, a[row], b[row], *row))
    return out


def found(spark, source, snapshot, schema=SCHEMA, key="id", **options):
    frames = (spark.createDataFrame(rows, schema) for rows in (source, snapshot))
    rows = [tuple(r) for r in reconcile(*frames, key, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def damaged(rng, rows):
    out = []
    for r in rows:
        draw = rng.random()
        if draw < 0.01:
            continue
        out.append((r[0], "other", r[2]) if draw < 0.02 else r)
        if draw > 0.99:
            out.append(r)
    return out + [(r[0] + 10**7 if r[0] is not None else None, "new", 0.0) for r in rng.sample(rows, 3)]


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 10, "first": 8, "radix": 8}])
@pytest.mark.parametrize("key", [lambda i: i * i * i - 10**6, lambda i: None if i % 50 == 0 else i // 7])
def test_against_brute_force(spark, key, options):
    rng = random.Random(str(options))
    source = [(key(i), rng.choice(["x", None, ""]), rng.choice([0.0, None, float(i)])) for i in range(600)]
    snapshot = damaged(rng, source)
    rng.shuffle(snapshot)
    assert found(spark, source, snapshot, **options) == brute(source, snapshot)


def test_text_keys(spark):
    rng = random.Random(1)
    source = [(f"k{i % 300}", i) for i in range(500)] + [(None, 1)]
    snapshot = [r for r in source if rng.random() > 0.02] + [("new", 1), (None, 1)]
    assert found(spark, source, snapshot, "id string, v int", leaf_rows=5) == brute(source, snapshot)


def test_equal_and_empty_tables(spark):
    rows = [(i, "x", 1.0) for i in range(50)] + [(None, "x", None)] * 2
    for a, b in ((rows, rows[::-1]), ([], []), (rows, []), ([], rows[:3]), ([(None, "x", None)], [])):
        assert found(spark, a, b) == brute(a, b)


def test_few_rounds_that_read_what_differs(spark, tmp_path, monkeypatch):
    """Three damaged rows among a hundred thousand: the rounds are the logarithm, and each reads a part of the last."""
    spark.range(0, 100_000, 1, 20).select("id", F.col("id").cast("string").alias("v")).write.parquet(str(tmp_path / "a"))
    source = spark.read.parquet(str(tmp_path / "a"))
    snapshot = source.where("id <> 777").withColumn("v", F.when(F.col("id") == 50_123, "?").otherwise(F.col("v")))
    snapshot = snapshot.unionByName(snapshot.where("id = 99999"))
    rounds, plans = [], []
    original = module._within

    def within(df, *args):
        out = original(df, *args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(module, "_within", within)
    rows = reconcile(source, snapshot, "id", watch=rounds.append, leaf_rows=10, first=64, radix=16).collect()
    assert {(r["kind"], r["id"]) for r in rows} == {("lost", 777), ("changed", 50_123), ("doubled", 99_999)}
    read = [r.rows for r in rounds]
    assert len(rounds) <= 5 and rounds[-1].missing_keys is False and all(b < a / 4 for a, b in zip(read, read[1:])) and read[-1] <= 10
    assert all(len(r.ranges) == 3 for r in rounds)
    assert "GreaterThanOrEqual(id," in plans[2] and "LessThanOrEqual(id," in plans[2]


def test_columns_of_one_side_and_of_other_types(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "id int, v int")
    b = spark.createDataFrame([(1, 1, None), (2, 2, "x")], "id bigint, v bigint, w string")
    rows = {tuple(r) for r in reconcile(a, b, "id").collect()}
    assert rows == {("changed", 1, 0, 2, 2, None), ("changed", 0, 1, 2, 2, "x")}


def test_maps_and_odd_names(spark):
    a = spark.sql("select 1 as `a.key`, map('x', 1, 'y', 2) as m, array(1) as l union all select 2, map('x', 1), null")
    b = spark.sql("select 1 as `a.key`, map('y', 2, 'x', 1) as m, array(1) as l union all select 2, map('x', 3), null")
    assert {(r["kind"], r["a.key"]) for r in reconcile(a, b, "a.key").collect()} == {("changed", 2)}


def test_many_ranges_are_read_in_stretches(spark, monkeypatch):
    ranges = [(10 * i, 10 * i + 3) for i in range(50)] + [(10_000, 10_001)]
    some = module._stretches(ranges, 5)
    assert len(some) == 5 and all(any(a <= x and y <= b for a, b in some) for x, y in ranges) and some[-1] == (10_000, 10_001)
    assert module._stretches([(0, 4), (5, 9), (20, 21)]) == [(0, 9), (20, 21)]
    original = module._stretches
    monkeypatch.setattr(module, "_stretches", lambda r: original(r, 2))
    source = [(i, "x", 1.0) for i in range(500)]
    snapshot = [r for r in source if r[0] % 60]
    assert found(spark, source, snapshot, leaf_rows=1) == brute(source, snapshot)
