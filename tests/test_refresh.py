import random
from datetime import datetime

import pytest

from sluicegate.operators import refresh
from sluicegate.operators.commits import clean, publish
from sluicegate.operators.latest import latest_table
from sluicegate.operators.refresh import base_root, read_latest, refresh_latest
from sluicegate.operators.snapshot import write_snapshot
from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import table_root

DATED = TableSpec("t", last_update_column="ts", primary_key=("id", "part"))
UNDATED = TableSpec("t", primary_key="id")
SCHEMA = "id bigint, part string, ts timestamp_ntz, v string"
SMALL = {"buckets": 3, "target_rows": 12, "least_rows": 2}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def write(spark, root, spec, tag, rows, schema=SCHEMA):
    write_snapshot(spark.createDataFrame(rows, schema), f"{table_root(root, spec)}/{spec.job}={tag}", 1)


def same(spark, root, spec, rows):
    found, expected = read_latest(spark, root, spec), latest_table(spark, root, spec)
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found, *sorted(found.columns)) == rows(expected, *sorted(found.columns))


def test_any_history_equals_the_latest_table(spark, root, rows):
    """Dates come, in any order and with tags of both lengths, are rewritten, withdrawn and come back."""
    rng = random.Random(9)
    tags = ["20240101", "20240102", "20240102120000", "20240103", "20240104", "20240105"]
    there, folded = set(), []
    for step in range(14):
        tag = rng.choice(tags)
        if tag in there and len(there) > 1 and rng.random() < 0.35:
            publish(spark, table_root(root, DATED), {f"{DATED.job}={tag}": None})
            there.discard(tag)
        else:
            keys = {(rng.randrange(25), rng.choice("ab")) for _ in range(rng.randrange(1, 25))}
            moments = [datetime(2024, 1, 1, rng.randrange(24)) for _ in keys]
            write(spark, root, DATED, tag, [(i, p, t, f"{step}-{i}{p}") for (i, p), t in zip(sorted(keys), moments)])
            there.add(tag)
        if rng.random() < 0.75 or step == 13:
            folded.append(refresh_latest(spark, root, DATED, **SMALL))
            same(spark, root, DATED, rows)
            if rng.random() < 0.3:
                clean(spark, table_root(root, DATED), older_than_hours=0)
    assert len(folded) > 6 and refresh_latest(spark, root, DATED) == []


def test_a_superseded_version_does_not_come_back(spark, root, rows):
    """Date 2 outdoes date 1, date 1 is rewritten with an older row, and then date 2 is withdrawn."""
    early, late, latest = (datetime(2024, 1, 1, h) for h in (1, 5, 9))
    write(spark, root, DATED, "20240101", [(1, "a", late, "first")])
    refresh_latest(spark, root, DATED)
    write(spark, root, DATED, "20240102", [(1, "a", latest, "second")])
    refresh_latest(spark, root, DATED, least_rows=0, ratio=0)
    write(spark, root, DATED, "20240101", [(1, "a", early, "again")])
    refresh_latest(spark, root, DATED, least_rows=0, ratio=0)
    same(spark, root, DATED, rows)
    publish(spark, table_root(root, DATED), {f"{DATED.job}=20240102": None})
    refresh_latest(spark, root, DATED)
    same(spark, root, DATED, rows)
    assert [r["v"] for r in read_latest(spark, root, DATED).collect()] == ["again"]


def test_all_dates_withdrawn(spark, root):
    write(spark, root, DATED, "20240101", [(1, "a", datetime(2024, 1, 1), "x")])
    refresh_latest(spark, root, DATED)
    publish(spark, table_root(root, DATED), {f"{DATED.job}=20240101": None})
    assert refresh_latest(spark, root, DATED) == ["get_data=20240101"]
    assert read_latest(spark, root, DATED).count() == 0


def test_a_new_date_reads_itself_and_the_buckets_it_touches(spark, root, monkeypatch, rows):
    write(spark, root, DATED, "20240101", [(i, "a", datetime(2024, 1, 1), "x") for i in range(60)])
    refresh_latest(spark, root, DATED, buckets=16, least_rows=100)
    write(spark, root, DATED, "20240102", [(7, "a", datetime(2024, 1, 2), "y")])
    seen = {}
    fold, rows_in = refresh.fold, refresh.fold.__globals__["_rows_in"]

    def folding(spark_, path, changes, *args, **kwargs):
        seen["changes"] = changes.inputFiles()
        return fold(spark_, path, changes, *args, **kwargs)

    def reading(*args):
        df = rows_in(*args)
        seen["base"] = df.inputFiles()
        return df

    monkeypatch.setattr(refresh, "fold", folding)
    monkeypatch.setitem(fold.__globals__, "_rows_in", reading)
    assert refresh_latest(spark, root, DATED, least_rows=100) == ["get_data=20240102"]
    assert seen["changes"] and all("get_data=20240102" in f for f in seen["changes"])
    assert len(seen["base"]) == 1 and base_root(root, DATED) in seen["base"][0]
    monkeypatch.undo()
    same(spark, root, DATED, rows)


def test_a_rewritten_date_rebuilds_its_keys_only(spark, root, monkeypatch, rows):
    days = [datetime(2024, 1, d) for d in (1, 2)]
    write(spark, root, DATED, "20240101", [(i, "a", days[0], "x") for i in range(60)])
    write(spark, root, DATED, "20240102", [(i, "a", days[1], "y") for i in (3, 4, 5)])
    refresh_latest(spark, root, DATED, buckets=16)
    write(spark, root, DATED, "20240102", [(4, "a", days[1], "z")])
    seen = {}
    fold = refresh.fold

    def folding(spark_, path, changes, *args, **kwargs):
        seen.update(changes=changes.count(), keys=sorted(r["id"] for r in kwargs["rebuilt"].collect()))
        return fold(spark_, path, changes, *args, **kwargs)

    monkeypatch.setattr(refresh, "fold", folding)
    refresh_latest(spark, root, DATED)
    assert seen == {"changes": 1 + 3, "keys": [3, 4, 5]}
    same(spark, root, DATED, rows)


def test_columns_that_come_and_widen(spark, root, rows):
    write(spark, root, UNDATED, "20240101", [(1, 1), (2, 2)], "id int, v int")
    refresh_latest(spark, root, UNDATED)
    write(spark, root, UNDATED, "20240102", [(2, 2**40, "new")], "id bigint, v bigint, w string")
    refresh_latest(spark, root, UNDATED)
    same(spark, root, UNDATED, rows)
    assert rows(read_latest(spark, root, UNDATED), "id", "v", "w") == [(1, 1, None), (2, 2**40, "new")]


def test_tags_of_both_lengths(spark, root, rows):
    """The noon of January 2 comes before September 3, though its tag is the larger number."""
    write(spark, root, UNDATED, "20240102120000", [(1, "old")], "id int, v string")
    write(spark, root, UNDATED, "20240903", [(1, "new")], "id int, v string")
    assert latest_table(spark, root, UNDATED).first()["v"] == "new"
    refresh_latest(spark, root, UNDATED)
    same(spark, root, UNDATED, rows)


def test_without_a_key_or_a_refresh(spark, root):
    with pytest.raises(ValueError, match="names none"):
        refresh_latest(spark, root, TableSpec("t"))
    with pytest.raises(FileNotFoundError):
        read_latest(spark, root, DATED)
