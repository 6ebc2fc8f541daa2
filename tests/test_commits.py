from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import commits, extract, snapshot
from sluicegate.operators.commits import clean, date_folders, publish, published
from sluicegate.operators.extract import extract_days
from sluicegate.operators.snapshot import completed_dates, has_earlier_date, read_snapshots, write_rows, write_snapshot
from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import table_root

JOB = "get_data"
SPEC = TableSpec("t", last_update_column="ts", primary_key="id", initial="since_start")
DAYS = [datetime(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "lake" / "t")


def write(spark, folder, tag, *ids, **options):
    return write_snapshot(spark.createDataFrame([(i,) for i in ids], "id int"), f"{folder}/{JOB}={tag}", 1, **options)


def state(spark, folder):
    out = {}
    for r in read_snapshots(spark, folder, JOB).collect():
        out.setdefault(str(r[JOB]), []).append(r["id"])
    return {tag: sorted(ids) for tag, ids in out.items()}


def test_a_rewritten_date_is_read_from_its_newest_version(spark, folder):
    write(spark, folder, "20240101", 1, 2)
    write(spark, folder, "20240102", 3)
    assert published(spark, folder) == (-1, {})
    for n, ids in enumerate([(4,), (5, 6), (7, 8, 9)]):
        write(spark, folder, "20240102", *ids)
        assert state(spark, folder) == {"20240101": [1, 2], "20240102": list(ids)}
        assert published(spark, folder)[0] == n
    assert completed_dates(spark, folder, JOB) == ["20240101", "20240102"]
    assert read_snapshots(spark, folder, JOB).columns == ["id", JOB]
    assert read_snapshots(spark, folder, JOB, dates=["20240102"]).count() == 3
    # What was there first is still there, for those who read it when the date was rewritten.
    assert spark.read.parquet(f"{folder}/{JOB}=20240102").count() == 1


class Killed(BaseException):
    """The driver is lost here: nothing after it runs, no cleaning up either."""


STEPS = ["the rows are being written", "they are written", "the manifest is being written", "it is there"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("first", [True, False])
def test_a_driver_lost_at_any_step_leaves_the_old_date_or_the_new_one(spark, folder, monkeypatch, step, first):
    write(spark, folder, "20240101", 1)
    if not first:
        write(spark, folder, "20240102", 2)
    old = state(spark, folder)

    def kill(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        if step == STEPS[0]:
            m.setattr(snapshot, "remove_folder", lambda *_: None)
            bad = spark.range(3).select(F.expr("assert_true(id < 1)").cast("int").alias("id"))
            with pytest.raises(Exception, match="not true"):
                write_snapshot(bad, f"{folder}/{JOB}=20240102", 1)
        else:
            if step == STEPS[1] and not first:
                m.setattr(snapshot, "publish", kill)
            elif step == STEPS[2] and not first:
                m.setattr(commits, "create_text", kill)
            else:
                original = snapshot.publish
                m.setattr(snapshot, "publish", lambda *a: (original(*a), kill()))
            try:
                write(spark, folder, "20240102", 9)
            except Killed:
                pass
    done = step == STEPS[3] or (first and step != STEPS[0])
    assert state(spark, folder) == (old | {"20240102": [9]} if done else old)
    # The next run goes on from there, and what is left over goes.
    write(spark, folder, "20240102", 10)
    assert state(spark, folder) == {"20240101": [1], "20240102": [10]}
    clean(spark, folder, older_than_hours=0)
    assert state(spark, folder) == {"20240101": [1], "20240102": [10]}
    assert len(list(Path(folder).parent.rglob("part-*.parquet"))) == 2


def test_dates_are_published_at_once(spark, write_table, tmp_path, monkeypatch):
    df = spark.range(12).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + id * interval 6 hours").alias("ts"))
    source, root = write_table("t", df), str(tmp_path / "out")
    where = table_root(root, SPEC)
    with monkeypatch.context() as m:
        written = []

        def failing(rows, target, *args, **kwargs):
            if written:
                raise OSError("disk")
            written.append(target)
            return write_rows(rows, target, *args, **kwargs)

        m.setattr(extract, "write_rows", failing)
        with pytest.raises(OSError):
            extract_days(spark, source, SPEC, DAYS, root)
    assert completed_dates(spark, where, JOB) == [] and not has_earlier_date(spark, where, JOB, "20250101")
    results = extract_days(spark, source, SPEC, DAYS, root, end=datetime(2024, 1, 3, 12))
    assert [(r.first_run, r.rows) for r in results] == [(True, 4), (False, 4), (False, 2)]
    assert published(spark, where)[0] == 0 and has_earlier_date(spark, where, JOB, "20240102")
    assert state(spark, where) == {"20240101": [0, 1, 2, 3], "20240102": [4, 5, 6, 7], "20240103": [8, 9]}
    later = extract_days(spark, source, SPEC, [datetime(2030, 1, 1)], root)
    assert not later[0].written and published(spark, where)[0] == 0


def test_two_publishers_at_once(spark, folder, monkeypatch):
    """The second one finds its number taken and lays its date over what the first one said."""
    for tag in ("1", "2"):
        write(spark, folder, tag, 0)
    paths = {tag: commits.new_version(folder, f"{JOB}={tag}") for tag in ("1", "2")}
    for tag, path in paths.items():
        write_rows(spark.createDataFrame([(int(tag),)], "id int"), path, 1)
    original, came = commits.create_text, []

    def slower(spark_, path, text):
        if not came:
            came.append(publish_first())
        return original(spark_, path, text)

    def publish_first():
        with monkeypatch.context() as m:
            m.setattr(commits, "create_text", original)
            return publish(spark, folder, {f"{JOB}=1": paths["1"]})

    monkeypatch.setattr(commits, "create_text", slower)
    assert publish(spark, folder, {f"{JOB}=2": paths["2"]}) == 1 and came == [0]
    assert state(spark, folder) == {"1": [1], "2": [2]}


def test_a_withdrawn_date_is_gone_and_can_come_back(spark, folder):
    write(spark, folder, "1", 1)
    write(spark, folder, "2", 2)
    publish(spark, folder, {f"{JOB}=2": None})
    assert state(spark, folder) == {"1": [1]} and not has_earlier_date(spark, folder, JOB, "1")
    write(spark, folder, "2", 5)
    assert state(spark, folder) == {"1": [1], "2": [5]}


def test_cleaning_spares_what_is_young_or_read(spark, folder):
    for n in range(13):
        write(spark, folder, "1", n)
    assert clean(spark, folder) == []
    assert len(clean(spark, folder, older_than_hours=0)) == 1 + 11 + 2
    assert state(spark, folder) == {"1": [12]} and published(spark, folder)[0] == 11
    assert clean(spark, folder, older_than_hours=0) == []
    assert clean(spark, f"{folder}/absent") == []


def test_bucketed_versions_and_columns_that_widen(spark, folder, plan):
    def rows(kind, extra):
        df = spark.range(6).select(F.col("id").cast(kind).alias("id"), (F.col("id") % 3).alias(snapshot.BUCKET_COLUMN))
        return df.withColumn("w", F.lit(extra)) if extra else df

    for tag, kind, extra in [("1", "int", None), ("2", "int", "x"), ("2", "bigint", "y"), ("3", "bigint", None)]:
        write_snapshot(rows(kind, extra), f"{folder}/{JOB}={tag}", 1, buckets=3)
    df = read_snapshots(spark, folder, JOB, merge_schema=True)
    assert sorted(df.dtypes) == [(JOB, "bigint"), ("id", "bigint"), (snapshot.BUCKET_COLUMN, "int"), ("w", "string")]
    assert {(r[JOB], r["w"], r["n"]) for r in df.groupBy(JOB, "w").agg(F.count("*").alias("n")).collect()} == {(1, None, 6), (2, "y", 6), (3, None, 6)}
    assert len(df.where(f"{snapshot.BUCKET_COLUMN} = 1 and {JOB} = 2").collect()) == 2
    assert "PartitionFilters: [isnotnull" in plan(df.where(f"{snapshot.BUCKET_COLUMN} = 1"))


def test_an_empty_rerun_publishes_nothing(spark, folder):
    write(spark, folder, "1", 1)
    assert write(spark, folder, "1", skip_empty=True) == 0
    assert state(spark, folder) == {"1": [1]} and published(spark, folder)[0] == -1
    assert date_folders(spark, folder, JOB) == ({f"{JOB}=1": f"{folder}/{JOB}=1"}, [])
