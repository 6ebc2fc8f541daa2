from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluicegate.operators.latest import latest_state

VERSION = st.tuples(
    st.sampled_from([None, "a", "b", "c"]), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(VERSION, max_size=20))
def test_latest_against_brute_force(spark, versions):
    df = spark.createDataFrame([(v, k, t, v) for v, (k, t, _) in enumerate(versions)], "v int, k string, t int, w int")
    newest = {}
    for v, (k, t, _) in enumerate(versions):
        rank = (-1 if t is None else t, v)
        newest[k] = max(newest.get(k, (-2, -1)), rank)
    found = latest_state(df, ["k"], ["t", "v"])
    assert found.columns == ["v", "k", "t", "w"]
    assert {r["k"]: (-1 if r["t"] is None else r["t"], r["v"]) for r in found.collect()} == newest
    assert all(r["v"] == r["w"] for r in found.collect())


def test_composite_key(spark):
    rows = [(1, "x", 1, "old"), (1, "x", 2, "new"), (1, "y", 1, "only")]
    df = spark.createDataFrame(rows, "a int, b string, t int, v string")
    assert {r["v"] for r in latest_state(df, ["a", "b"], ["t"]).collect()} == {"new", "only"}


def test_odd_names_and_nested_columns(spark):
    df = spark.sql(
        """select * from values
           (1, 1, map('k', 1), array('x'), named_struct('p', 1)), (1, 2, map('k', 2), array('y'), named_struct('p', 2))
           as t(`a.key`, `when `, `m.ap`, arr, `st``r`)"""
    )
    (row,) = latest_state(df, ["a.key"], ["when "]).collect()
    assert row.asDict(recursive=True) == {"a.key": 1, "when ": 2, "m.ap": {"k": 2}, "arr": ["y"], "st`r": {"p": 2}}


def test_nothing_but_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    assert latest_state(df, ["a"], ["a"]).count() == 2


def test_reduced_before_the_shuffle(lake, plan):
    text = plan(latest_state(lake.table("events"), ["user_id"], ["ts", "event_id"]))
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning(user_id")
    assert text.count("Exchange") == 1
