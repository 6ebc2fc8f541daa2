import pytest
from pyspark.sql import functions as F

from sluicegate.operators.colocated import join_colocated, latest_colocated, read_colocated, write_colocated
from sluicegate.operators.latest import latest_state

SCHEMA = "id bigint, part string, t int, v string"


@pytest.fixture
def dates(spark, tmp_path):
    """Three dates; keys come twice in one, in several and in one alone, a third of the rows have one key, and some have none."""
    out = []
    for day in range(3):
        rows = [(i % (40 + day), "ab"[i % 2], (i * 7 + day) % 11, f"{day}-{i}") for i in range(day * 5, 120)]
        rows += [(7, "b", i % 9, f"{day}-hot-{i}") for i in range(60)] + [(None, "a", day, f"{day}-none")]
        path = str(tmp_path / f"d{day}")
        write_colocated(spark.createDataFrame(rows, SCHEMA), path, ["id", "part"], 5)
        out.append(path)
    return out


def exchanges(plan_text):
    return [line for line in plan_text.splitlines() if "Exchange" in line]


def test_a_join_without_a_shuffle(spark, dates, plan, rows):
    a, b = (read_colocated(spark, p) for p in dates[:2])
    joined = join_colocated(a.withColumnsRenamed({"t": "ta", "v": "va"}), b, ["id", "part"])
    assert not exchanges(plan(joined)) and "SortMergeJoin" in plan(joined)
    plain = [spark.read.parquet(p) for p in dates[:2]]
    expected = plain[0].withColumnsRenamed({"t": "ta", "v": "va"}).join(plain[1], ["id", "part"])
    assert rows(joined) == rows(expected) and joined.count() > 100


@pytest.mark.parametrize("count", [1, 2, 3])
def test_the_latest_per_key_without_a_shuffle(spark, dates, plan, rows, count):
    found = latest_colocated([read_colocated(spark, p) for p in dates[:count]], ["id", "part"], ["t"])
    assert len(exchanges(plan(found))) == max(0, count - 2) and found.columns == ["id", "part", "t", "v"]
    tagged = [spark.read.parquet(p).withColumn("day", F.lit(d)) for d, p in enumerate(dates[:count])]
    every = tagged[0]
    for more in tagged[1:]:
        every = every.unionByName(more)
    expected = latest_state(every, ["id", "part"], ["t", "day"]).drop("day")
    # Rows of one date that are equal in key and order are a tie: either may be the newest.
    keyed = "id is not null"
    assert rows(found.where(keyed), "id", "part", "t") == rows(expected.where(keyed), "id", "part", "t")
    assert rows(found.where("id is null"), "v") == [(f"{d}-none",) for d in range(count)]
    days = {(r["id"], r["part"], r["t"]): r["v"][0] for r in expected.where(keyed).collect()}
    assert {(r["id"], r["part"], r["t"]): r["v"][0] for r in found.where(keyed).collect()} == days


def test_the_folder_says_how_it_lies(spark, dates, tmp_path):
    with pytest.raises(FileExistsError):
        write_colocated(spark.range(3).toDF("id"), dates[0], ["id"], 2)
    with pytest.raises(FileNotFoundError):
        read_colocated(spark, str(tmp_path / "absent"))
    spark.sql("show tables").where("tableName like 'sluicegate_%'").collect()
    again = read_colocated(spark, dates[0])
    assert again.count() == read_colocated(spark, dates[0]).count() == spark.read.parquet(dates[0]).count()
    assert len({f.rsplit("_", 1)[1] for f in again.inputFiles()}) == 5


def test_a_write_that_breaks_off(spark, tmp_path):
    bad = spark.range(3).select(F.expr("assert_true(id < 1)").cast("int").alias("id"))
    with pytest.raises(Exception, match="not true"):
        write_colocated(bad, str(tmp_path / "bad"), ["id"], 2)
    assert not (tmp_path / "bad").exists()
