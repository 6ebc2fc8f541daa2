from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluicegate.functions.columns import hash_bucket, is_uuid
from sluicegate.operators.buckets import self_join_counted, with_bucket, with_group_size

SMALL = [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)]


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_buckets_part_the_rows(lake, method):
    df = with_bucket(lake.table("customer"), "c_custkey", 5, method)
    assert {r[0] for r in df.select("mod_hash_id").distinct().collect()} == {0, 1, 2, 3, 4}
    assert df.count() == lake.table("customer").count()
    assert dict(df.dtypes)["mod_hash_id"] == "bigint"


def test_bucket_of_odd_keys(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (-1,), (None,)], "k bigint")
    found = [r[0] for r in df.select(hash_bucket("k", 3)).collect()]
    assert found[3] is None and all(0 <= b < 3 for b in found[:3])
    with pytest.raises(ValueError):
        hash_bucket("k", 3, "sha1")


def literal_join(df, key, buckets):
    """The join as it stands, small tables only."""
    u1, u2 = df.alias("u1"), df.alias("u2")
    joined = u1.join(u2, F.expr(f"u1.{key} = u2.{key}"), "full")
    return joined.select(hash_bucket(F.col(f"u1.{key}"), buckets).alias("mod_hash_id"), "u2.*")


@pytest.mark.parametrize("rows", [SMALL, SMALL[:1], [(None, 1)], [], [("h", i) for i in range(30)] + SMALL])
def test_counted_self_join_is_the_full_join(spark, rows):
    df = spark.createDataFrame(rows, "id string, v int")
    literal = Counter(tuple(r) for r in literal_join(df, "id", 2).collect())
    counted = Counter()
    for *row, copies in self_join_counted(df, "id", 2).collect():
        counted[tuple(row)] += copies
    assert counted == literal


def test_odd_names_and_nested_columns(spark):
    df = spark.sql("select * from values ('a', map('k', 1), 1), ('a', map('k', 2), 2) as t(id, `m.ap`, `v v`)")
    found = self_join_counted(df, "id", 2)
    assert found.columns == ["mod_hash_id", "id", "m.ap", "v v", "copies"]
    assert sorted((r["m.ap"]["k"], r["copies"]) for r in found.collect()) == [(1, 2), (2, 2)]


def shape(plan_text):
    """The operators of a plan, without the names and numbers in it."""
    import re

    return re.findall(r"(\w+)(?: \(| \[|$)", re.sub(r"#\d+L?|plan_id=\d+", "", plan_text), re.M)


def test_one_plan_whatever_the_keys(spark, plan):
    """Few keys, many, hot ones and ties: no job runs to build the plan, and it is always the same."""
    tables = [
        [("h", i) for i in range(40)] + [(f"k{i % 7}", i) for i in range(30)] + [(None, 1), (None, 2)],
        [(f"k{i}", i) for i in range(3000)] + [(f"k{i % 1500}", i) for i in range(3000)],
        [("only", 1)],
    ]
    jobs = spark.sparkContext.statusTracker()
    shapes = set()
    for rows in tables:
        df = spark.createDataFrame(rows, "id string, v int")
        spark.sparkContext.setJobGroup("plan", "building a plan")
        sized = with_group_size(df, "id", "n")
        assert not jobs.getJobIdsForGroup("plan")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        sizes = Counter(k for k, _ in rows if k is not None)
        found = sized.collect()
        assert len(found) == len(rows)
        assert all(n == (sizes[key] if key is not None else 1) for key, _, n in found)
        shapes.add(tuple(shape(plan(with_group_size(df, "id", "n")))))
    assert len(shapes) == 1


def test_unique_keys_give_one_copy_each(lake, rows):
    customers = lake.table("customer")
    joined = self_join_counted(customers, "c_custkey", 2)
    assert {r[0] for r in joined.select("copies").distinct().collect()} == {1}
    plain = with_bucket(customers, "c_custkey", 2)
    assert rows(joined, "mod_hash_id", *customers.columns) == rows(plain, "mod_hash_id", *customers.columns)


@pytest.mark.parametrize("value", ["id", "0"])
@pytest.mark.parametrize("other", ["id", "id div 6"])
def test_hot_key_does_not_meet_in_one_task(spark, value, other):
    """A third of the rows has one key, another third has none, and the rows may all be copies."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        df = spark.range(0, 30_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, -7).when(F.col("id") % 3 == 1, F.expr(other)).alias("k"),
                F.expr(value).alias("v"),
        )
        sized = with_group_size(df, "k", "n").withColumn("task", F.spark_partition_id())
        per_task = [r["rows"] for r in sized.groupBy("task").agg(F.count("*").alias("rows"), F.max("n")).collect()]
        assert max(per_task) < 2 * 30_000 / 16
        assert sized.where("k >= 0").agg(F.min("n"), F.max("n")).first() == ((1, 1) if other == "id" else (2, 2))
        assert sized.where("k = -7").agg(F.min("n"), F.max("n")).first() == (10_000, 10_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_uuid_shape(spark):
    df = spark.createDataFrame([("0b7e8a52-7c1e-4b55-9d0f-0c6f3a1d2e4f",), ("0b7e8a52",), ("",), (None,)], "u string")
    assert [r[0] for r in df.select(is_uuid("u")).collect()] == [True, False, False, None]
