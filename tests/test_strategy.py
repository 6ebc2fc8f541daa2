from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import (
    Bounds,
    bucket_predicates,
    date_tag,
    file_count,
    interval_sql,
    layout,
    date_bounds,
    needs_key_range,
    read_strategy,
    resolve_bounds,
    snapshot_path,
    stride_cuts,
    stride_predicates,
)


@pytest.mark.parametrize(
    "dated, keyed, strategy, shape",
    [
        (True, True, "incremental", "sized"),
        (True, False, "incremental", "sized"),
        (False, True, "stride", "sized"),
        (False, False, "bucket", "bucketed"),
    ],
)
def test_decision_table(dated, keyed, strategy, shape):
    spec = TableSpec(
        "t", last_update_column="ts" if dated else None, partition_column="id" if keyed else None, primary_key="id"
    )
    assert (read_strategy(spec), layout(spec)) == (strategy, shape)


@pytest.mark.parametrize("rows, files", [(0, 0), (1, 1), (1_000_000, 1), (1_000_001, 2), (10**13, 10**7)])
def test_file_count(rows, files):
    assert file_count(rows) == files


def spec(**fields):
    return TableSpec("t", partition_column="id", **fields)


@pytest.mark.parametrize("low", [None, "min", "MIN", 0])
@pytest.mark.parametrize("high", [None, "max", "MAX", "Max"])
def test_open_bounds_under_the_count_rule(low, high):
    bounds = resolve_bounds(spec(lower_bound=low, upper_bound=high, bounds="count"), 25_001)
    assert bounds == Bounds(0, 25_001, 3)


def test_other_bounds():
    assert resolve_bounds(spec(bounds="count"), 1_500).partitions == 1
    assert resolve_bounds(spec(lower_bound=100, upper_bound="500", num_partitions=4), 0) == Bounds(100, 500, 4)
    assert resolve_bounds(spec(num_partitions=0, bounds="count"), 9).partitions == 1
    assert resolve_bounds(spec(), 7, (-5, 29_999)) == Bounds(-5, 30_000, 4)
    assert resolve_bounds(spec(), 0, (None, None)) == Bounds(0, 0, 1)
    assert resolve_bounds(spec(), 0, (Decimal("2.00"), Decimal("9.50"))) == Bounds(2, 10, 1)
    assert resolve_bounds(spec(), 0, (0, 10**15)).partitions == 10**11 + 1
    assert resolve_bounds(spec(num_partitions=50_000), 0, (0, 10**9)).partitions == 50_000
    assert resolve_bounds(spec(lower_bound=900), 0, (-50, -1)) == Bounds(900, 900, 1)
    assert resolve_bounds(spec(lower_bound=900, upper_bound="max", bounds="count"), 5) == Bounds(900, 900, 1)
    assert resolve_bounds(spec(lower_bound=0, upper_bound=8, num_partitions="4"), 0) == Bounds(0, 8, 4)
    assert not needs_key_range(spec(lower_bound=0, upper_bound=9))
    with pytest.raises(ValueError):
        resolve_bounds(spec(lower_bound=9, upper_bound=3), 0)


def test_bounds_of_a_date_column():
    day, later = datetime(2024, 1, 1), datetime(2024, 3, 1)
    expected = Bounds(day, later, 4)
    for low, high in [("2024-01-01", "2024-03-01"), (day, later), (day.date(), later.date())]:
        bounds = resolve_bounds(spec(lower_bound=low, upper_bound=high, num_partitions=4), 0)
        assert bounds == expected and bounds.strides == 4
    assert resolve_bounds(spec(num_partitions=4), 0, (day, later)) == expected
    first, *_, last, nulls = stride_predicates("ts", expected)
    assert first == "ts < timestamp '2024-01-16 00:00:00'" and nulls == "ts is null"
    assert last == "ts >= timestamp '2024-02-15 00:00:00'"
    assert stride_predicates("ts", Bounds(day, later, 1)) == ["1 = 1"]
    dated = TableSpec("t", last_update_column="ts")
    assert date_bounds(dated, 25_000, (day, later)) == Bounds(day, later, 3)
    assert date_bounds(dated, 25_000, (day, day)) is None and date_bounds(dated, 0, (None, None)) is None
    for bad in [
        spec(lower_bound="2024-01-01", upper_bound="2024-03-01"),
        spec(lower_bound=0, upper_bound="2024-03-01", num_partitions=4),
        spec(lower_bound="2024-03-01", upper_bound="2024-01-01", num_partitions=4),
        spec(lower_bound="x", upper_bound=3, num_partitions=4),
    ]:
        with pytest.raises(ValueError):
            resolve_bounds(bad, 0)


@pytest.fixture(scope="module")
def keys(spark):
    values = [None, None, -(2**63), 2**63 - 1, 0, *range(-40, 40), *range(90, 520, 3)]
    return spark.createDataFrame([(v,) for v in values], "id bigint").cache()


def oracle_stride(key, b):
    """By the definition, from the ends: stride i begins at lower + span * i / n, rounded down."""
    n = min(b.partitions, b.upper - b.lower) or 1
    if key is None:
        return n if n > 1 else 0
    return sum(key >= b.lower + (b.upper - b.lower) * i // n for i in range(1, n))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(-300, 300), st.integers(0, 700), st.integers(1, 12))
def test_every_key_has_one_stride(keys, lower, span, n):
    bounds = Bounds(lower, lower + span, n)
    texts = stride_predicates("id", bounds)
    assert len(texts) == (bounds.strides + 1 if bounds.strides > 1 else 1)
    taken = F.array(*(F.coalesce(F.expr(t), F.lit(False)) for t in texts))
    for key, hits in keys.select("id", taken).collect():
        assert hits.count(True) == 1 and hits.index(True) == oracle_stride(key, bounds)


def test_cuts_that_do_not_divide_evenly():
    assert stride_cuts(Bounds(0, 1500, 7)) == [214, 428, 642, 857, 1071, 1285]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 9))
def test_bucket_predicates_take_every_row_once(keys, n):
    taken = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in bucket_predicates("id", n)]
    assert {r[0] for r in keys.select(sum(taken, F.lit(0))).collect()} == {1}


def test_text_bucket_predicates():
    first, second, nulls = bucket_predicates("id", 2, "postgresql")
    assert first == "mod(abs(cast(hashtext(cast(id as text)) as bigint)), 2) = 0" and nulls == "id is null"
    assert second == "mod(abs(cast(hashtext(cast(id as text)) as bigint)), 2) = 1"
    assert bucket_predicates("id", 3, "mysql")[2] == "mod(crc32(id), 3) = 2"
    with pytest.raises(ValueError):
        bucket_predicates("id) or (1=1", 2)


def test_interval_text():
    start, end = datetime(2024, 1, 2, 3, 4, 5, 60), datetime(2024, 2, 1)
    assert interval_sql("ts", start, end) == (
        "ts >= timestamp '2024-01-02 03:04:05.000060' and ts < timestamp '2024-02-01 00:00:00'"
    )
    with pytest.raises(AttributeError):
        interval_sql("ts", "2024' or '1'='1", None)


def test_paths_hold_source_and_database():
    one = snapshot_path("hdfs://h/lake/", TableSpec("t", source="pg", database="a"), date(2024, 9, 1))
    two = snapshot_path("hdfs://h/lake", TableSpec("t", source="pg", database="b"), datetime(2024, 9, 1, 5))
    assert one == "hdfs://h/lake/pg/a/t/get_data=20240901"
    assert two == "hdfs://h/lake/pg/b/t/get_data=20240901050000"
    assert date_tag(date(2024, 1, 31)) == "20240131"


def test_moments_with_a_zone_are_taken_as_utc():
    hanoi = datetime(2024, 9, 1, 3, tzinfo=timezone(timedelta(hours=7)))
    assert date_tag(hanoi) == "20240831200000"
    with pytest.raises(ValueError, match="second"):
        date_tag(datetime(2024, 9, 1, 0, 0, 0, 5))
    assert interval_sql("ts", hanoi, None) == "ts >= timestamp '2024-08-31 20:00:00'"


def test_no_key_no_buckets():
    assert (read_strategy(TableSpec("t")), layout(TableSpec("t"))) == ("bucket", "sized")
