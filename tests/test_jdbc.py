"""JDBC without a database: the options, and the SQL texts run by Spark on the same tables.

With SLUICEGATE_JDBC_URL (and _DATABASE, _USER, _PASSWORD, _DRIVER, _TABLE, _KEY) set to a database of your
own, the last test reads from it.
"""

import os
from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.operators.extract import extract_table
from sluicegate.operators.snapshot import read_snapshots
from sluicegate.plans.spec import Connection, TableSpec
from sluicegate.plans.strategy import Bounds, bucket_predicates, stride_predicates, table_root
from sluicegate.sources.base import count_rows, find_bounds
from sluicegate.sources.jdbc import JdbcSource, url_dialect

ORDERS = TableSpec("orders", partition_column="o_orderkey", last_update_column="o_orderdate", primary_key="o_orderkey")
SINCE, UNTIL = datetime(1998, 1, 1), datetime(1999, 1, 1)


@pytest.fixture
def source(spark, monkeypatch):
    monkeypatch.setenv("PG_PASS", "s3cret")
    return JdbcSource(spark, Connection("me", "jdbc:postgresql://h:5432/", "PG_PASS"), "shop")


@pytest.fixture
def views(lake):
    for name in ("orders", "customer"):
        lake.table(name).createOrReplaceTempView(name)


def test_base_options(source):
    assert source.base_options() == {
        "url": "jdbc:postgresql://h:5432/shop",
        "user": "me",
        "password": "s3cret",
        "fetchsize": "100000",
        "preferTimestampNTZ": "true",
    }


@pytest.mark.parametrize(
    "url, dialect",
    [("jdbc:postgresql://h/", "postgresql"), ("jdbc:mysql://h/", "mysql"), ("jdbc:oracle:thin:@h", "integer")],
)
def test_dialect_follows_the_url(url, dialect):
    assert url_dialect(url) == dialect


@pytest.mark.parametrize("since, until", [(None, None), (SINCE, None), (SINCE, UNTIL), (None, UNTIL)])
def test_sql_text_gives_what_the_frame_gives(spark, lake, views, source, since, until):
    frame = lake.read(ORDERS, since=since, until=until)
    assert spark.sql(source.count_query(ORDERS, since, until)).first()["n"] == frame.count()
    keys = spark.sql(source.key_range_query(ORDERS, since, until)).first()
    assert keys == lake.key_range_frame(ORDERS, since, until).first()
    read = spark.sql(f"select * from {source.table_text(ORDERS, since, until)}")
    assert read.exceptAll(frame).isEmpty() and frame.exceptAll(read).isEmpty()


def test_chosen_columns_reach_the_database(spark, lake, views, source):
    spec = TableSpec("orders", columns=("o_orderkey", "o_custkey"))
    assert source.table_text(spec) == "(select o_orderkey, o_custkey from orders) src"
    assert spark.sql(f"select * from {source.table_text(spec)}").columns == ["o_orderkey", "o_custkey"]
    assert lake.read(spec).columns == ["o_orderkey", "o_custkey"]


def test_key_range(spark, views, source):
    assert tuple(spark.sql(source.key_range_query(ORDERS)).first()) == (0, 1499)


def test_bounds_are_asked_for_only_where_needed(spark, views, source, monkeypatch):
    asked = []
    monkeypatch.setattr(source, "_load", lambda query: asked.append(query) or spark.sql(query))
    fields = {"partition_column": "o_orderkey"}
    assert source.split(TableSpec("orders")) is None
    # Keyless tables: pieces by the rows to be read, and no fewer than the table has buckets.
    keyless = TableSpec("orders", primary_key="o_orderkey", buckets=3)
    assert source.split(keyless, 2_500_000) == source.split(keyless, 9) == Bounds(0, 3, 3)
    assert source.split(keyless, 70_000_001) == Bounds(0, 71, 71)
    assert source.split(TableSpec("orders", primary_key="o_orderkey", num_partitions=50_000), 9).strides == 50_000
    assert not asked
    assert source.split(TableSpec("orders", lower_bound=5, upper_bound=9, **fields)) == Bounds(5, 9, 1)
    assert source.split(TableSpec("orders", bounds="count", **fields), 30_000) == Bounds(0, 30_000, 3)
    assert source.split(TableSpec("orders", rows_per_partition=500, **fields), 30_000) == Bounds(0, 1500, 3)
    assert source.split(TableSpec("orders", bounds="count", **fields)) == Bounds(0, 1500, 1)
    # Dated tables without a split column: strides of the date column, as many as the rows ask for.
    plain = TableSpec("orders", last_update_column="o_orderdate", rows_per_partition=100)
    found = source.split(plain, 1500)
    assert found.moments and found.strides == 15 and asked.pop().startswith("select min(o_orderdate)")
    assert source.split(plain, 100) is None
    source.split(plain, None, SINCE)
    assert asked.pop().endswith("where o_orderdate >= timestamp '1998-01-01 00:00:00'")
    assert asked.pop().startswith("select count(*) as n from orders where")
    dated = TableSpec("orders", last_update_column="o_orderdate", **fields)
    source.split(dated, None, SINCE)
    assert asked.pop().endswith(" from orders where o_orderdate >= timestamp '1998-01-01 00:00:00'")
    assert asked == [
        "select min(o_orderkey) as lo, max(o_orderkey) as hi from orders",
        "select count(*) as n from orders",
    ]


class Recorder:
    """Stands where ``spark.read`` is and keeps what it was asked."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self


@pytest.mark.parametrize(
    "spec, bounds, since, expected",
    [
        (
            TableSpec("t", partition_column="id"),
            Bounds(0, 100, 4),
            None,
            {"dbtable": "t", "predicates": stride_predicates("id", Bounds(0, 100, 4))},
        ),
        (
            TableSpec("t", partition_column="id", num_partitions=50_000),
            Bounds(0, 10**9, 50_000),
            None,
            {"dbtable": "t", "predicates": stride_predicates("id", Bounds(0, 10**9, 50_000))},
        ),
        (
            TableSpec("t", partition_column="id", last_update_column="ts"),
            Bounds(0, 100, 4),
            SINCE,
            {
                "dbtable": "(select * from t where ts >= timestamp '1998-01-01 00:00:00') src",
                "predicates": stride_predicates("id", Bounds(0, 100, 4)),
            },
        ),
        (
            TableSpec("t", last_update_column="ts"),
            Bounds(SINCE, UNTIL, 3),
            SINCE,
            {
                "dbtable": "(select * from t where ts >= timestamp '1998-01-01 00:00:00') src",
                "predicates": stride_predicates("ts", Bounds(SINCE, UNTIL, 3)),
            },
        ),
        (
            TableSpec("t", last_update_column="ts"),
            None,
            SINCE,
            {"dbtable": "(select * from t where ts >= timestamp '1998-01-01 00:00:00') src"},
        ),
        (
            TableSpec("t", primary_key="id", buckets=3),
            Bounds(0, 3, 3),
            None,
            {"dbtable": "t", "predicates": bucket_predicates("id", 3, "postgresql")},
        ),
        (
            TableSpec("t", primary_key="id", num_partitions=5),
            Bounds(0, 5, 5),
            None,
            {"dbtable": "t", "predicates": bucket_predicates("id", 5, "postgresql")},
        ),
        (
            TableSpec("t", last_update_column="ts", primary_key="id", num_partitions=2),
            Bounds(0, 2, 2),
            SINCE,
            {
                "dbtable": "(select * from t where ts >= timestamp '1998-01-01 00:00:00') src",
                "predicates": bucket_predicates("id", 2, "postgresql"),
            },
        ),
        (TableSpec("t"), None, None, {"dbtable": "t"}),
    ],
)
def test_each_strategy_asks_for_its_read(source, spec, bounds, since, expected):
    source.spark = recorder = Recorder()
    source.read(spec, bounds, since)
    (call,) = recorder.calls
    assert expected.items() <= call.items()
    assert call["url"] == "jdbc:postgresql://h:5432/shop" and call["password"] == "s3cret"
    assert ("predicates" in call) == ("predicates" in expected)
    assert not {"query", "partitionColumn", "numPartitions"} & call.keys()


@pytest.mark.parametrize("bounds", [Bounds(0, 1500, 4), Bounds(100, 500, 4), Bounds(0, 1500, 7), Bounds(0, 3, 10)])
def test_strides_lose_no_row(spark, lake, bounds):
    table = lake.table("orders")
    checks = [F.expr(t) for t in stride_predicates("o_orderkey", bounds)]
    assert len(checks) == bounds.strides + 1
    hits = sum((F.coalesce(c, F.lit(False)).cast("int") for c in checks), F.lit(0))
    assert [tuple(r) for r in table.groupBy(hits).count().collect()] == [(1, 1500)]


@pytest.mark.parametrize("pieces", [1, 5])
def test_strides_of_a_date_column(lake, source, pieces):
    table = lake.table("orders")
    spec = TableSpec("orders", partition_column="o_orderdate", num_partitions=pieces)
    bounds = find_bounds(lake, spec)
    source.spark = recorder = Recorder()
    source.read(spec, bounds)
    texts = recorder.calls[0].get("predicates", ["1 = 1"])
    assert len(texts) == (pieces + 1 if pieces > 1 else 1)
    hits = [F.coalesce(F.expr(t), F.lit(False)).cast("int") for t in texts]
    assert [tuple(r) for r in table.groupBy(sum(hits, F.lit(0))).count().collect()] == [(1, 1500)]
    assert all(n > 200 for n in table.agg(*(F.sum(h) for h in hits)).first()[:pieces])


class Views(JdbcSource):
    """A database played by Spark's own views: the same texts and predicates, no connection."""

    def _load(self, query=None, dbtable=None):
        return self.spark.sql(query or f"select * from {dbtable}")

    def _load_pieces(self, table, predicates):
        pieces = [self.spark.sql(f"select * from {table} where {p}") for p in predicates]
        return reduce(DataFrame.unionAll, pieces)


@pytest.mark.parametrize(
    "spec",
    [
        ORDERS,
        TableSpec("orders", last_update_column="o_orderdate"),
        TableSpec("orders", last_update_column="o_orderdate", rows_per_partition=200),
        TableSpec("orders", last_update_column="o_orderdate", primary_key="o_orderkey", num_partitions=3),
        TableSpec("orders", last_update_column="o_orderdate", partition_column="o_orderdate", num_partitions=4),
        TableSpec("orders", partition_column="o_orderkey", columns=("o_orderkey", "o_custkey")),
        TableSpec("orders", partition_column="o_orderdate", num_partitions=3),
        TableSpec("orders", primary_key="o_orderkey", buckets=3),
    ],
)
def test_extract_gives_what_the_files_give(spark, lake, views, tmp_path, rows, spec):
    source = Views(spark, Connection("me", "jdbc:other:x"), "")
    found = []
    for name, origin in (("views", source), ("lake", lake)):
        root = str(tmp_path / name)
        for day, end in ((SINCE, UNTIL), (UNTIL, None)):
            extract_table(spark, origin, spec, day, root, end)
        found.append(rows(read_snapshots(spark, table_root(root, spec), spec.job)))
    assert found[0] == found[1] and len(found[0]) > 1000


@pytest.mark.skipif("SLUICEGATE_JDBC_URL" not in os.environ, reason="no database given")
def test_live_database(spark):
    env = {k: os.environ.get(f"SLUICEGATE_JDBC_{k}") for k in ("URL", "DATABASE", "USER", "DRIVER", "TABLE", "KEY")}
    connection = Connection(env["USER"] or "", env["URL"], "SLUICEGATE_JDBC_PASSWORD", env["DRIVER"])
    source = JdbcSource(spark, connection, env["DATABASE"] or "")
    keyed = TableSpec(env["TABLE"], partition_column=env["KEY"], num_partitions=4)
    keyless = TableSpec(env["TABLE"], primary_key=env["KEY"], buckets=4)
    n = count_rows(source, keyed)
    strided = source.read(keyed, find_bounds(source, keyed))
    bucketed = source.read(keyless, source.split(keyless, n))
    assert strided.count() == bucketed.count() == n
    assert strided.exceptAll(bucketed).isEmpty()
