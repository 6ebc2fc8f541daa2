"""Queries over the given tables, and the SQL each one is checked against."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluicegate.functions.columns import files_for, is_uuid  # noqa: E402
from sluicegate.functions.intervals import gaps, islands, overlaps  # noqa: E402
from sluicegate.operators.buckets import self_join_counted, with_bucket  # noqa: E402
from sluicegate.operators.documents import assign_ids, flatten_quotes, user_records  # noqa: E402
from sluicegate.operators.colocated import join_colocated, latest_colocated, read_colocated, write_colocated  # noqa: E402
from sluicegate.operators.commits import clean, publish  # noqa: E402
from sluicegate.operators.extract import extract_all, extract_days, extract_missing, extract_table  # noqa: E402
from sluicegate.operators.latest import latest_state, latest_table  # noqa: E402
from sluicegate.operators.reconcile import reconcile  # noqa: E402
from sluicegate.operators.refresh import read_latest, refresh_latest  # noqa: E402
from sluicegate.operators.runs import covered, read_twice  # noqa: E402
from sluicegate.operators.snapshot import read_snapshots, write_snapshot  # noqa: E402
from sluicegate.operators.variants import first_users, flatten_series  # noqa: E402
from sluicegate.plans.spec import TableSpec, parse_specs, read_yaml  # noqa: E402
from sluicegate.plans.strategy import (  # noqa: E402
    bucket_predicates,
    file_count,
    layout,
    read_strategy,
    resolve_bounds,
    stride_predicates,
    table_root,
)
from sluicegate.sources.base import find_bounds  # noqa: E402
from sluicegate.sources.depth import equal_row_bounds  # noqa: E402
from sluicegate.sources.lake import LakeSource  # noqa: E402
from sluicegate.sources.rest import request_frame  # noqa: E402
from sluicegate.session import new_work_dir  # noqa: E402
from sluicegate.streaming.messages import (  # noqa: E402
    USER_MESSAGE,
    decode_messages,
    encode_messages,
    message_text,
    split_messages,
)
from sluicegate.streaming.stream import (  # noqa: E402
    append_stream,
    compact,
    current_state,
    keyed_upsert_stream,
    rejected_messages,
    replay_rejects,
)

# The one place that does without the training-data subpackage and its pipeline where they are not installed.
try:
    import corpus_pipeline
    from sluicegate.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "sluicegate.llm", "sluicegate.llm.queries"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
ORDERS_START = datetime(1998, 1, 1)
EVENT_DAYS = [datetime(2024, 1, d) for d in (1, 2, 3)]
HALF_DAYS = [datetime(2024, 1, 2), datetime(2024, 1, 2, 12), datetime(2024, 1, 3)]
SNAPSHOT_DAY = datetime(2024, 9, 1)
ENDPOINT, PERIOD = "https://example.invalid/q", "MAX"
ONCE = {"availableNow": True}
FILES_PER_BATCH = 1000

ORDERS = TableSpec("orders", last_update_column="o_orderdate", primary_key="o_orderkey", partition_column="o_orderkey")
EVENTS = TableSpec("events", last_update_column="ts", primary_key="event_id")
CUSTOMER_KEYED = TableSpec("customer", partition_column="c_custkey", primary_key="c_custkey")
CUSTOMER_KEYLESS = TableSpec("customer", primary_key="c_custkey")
SUPPLIER_KEYLESS = TableSpec("supplier", primary_key="s_suppkey")

# The key names of the table list.
FANOUT_YAML = """
config:
- user: warehouse
  databases:
    - db_name: sales
      job: get_data
      tbl_list:
        - {table_name: customer, numPartitions: 4, lowerBound: 0, upperBound: max, partitionColumn: c_custkey,
           primaryKey_col: c_custkey, lastUpdate_col: }
        - {table_name: supplier, numPartitions: , lowerBound: , upperBound: , partitionColumn: ,
           primaryKey_col: s_suppkey, lastUpdate_col: }
        - {table_name: orders, numPartitions: 4, lowerBound: min, upperBound: max, partitionColumn: o_orderkey,
           primaryKey_col: [o_orderkey, o_custkey], lastUpdate_col: o_orderdate}
    - db_name: empty
      job: get_data
      tbl_list:
- user: reference_data
  databases:
    - db_name: places
      job: get_data
      tbl_list:
        - {primaryKey_col: r_regionkey, table_name: region}
        - {primaryKey_col: n_nationkey, table_name: nation}
"""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _tag(day: datetime) -> int:
    return int(day.strftime("%Y%m%d"))


# --- counts, bounds, strides, buckets ---------------------------------------------------------


def count_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LakeSource(spark, sf_dir).count_frame(ORDERS)


def filtered_count_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LakeSource(spark, sf_dir).count_frame(ORDERS, ORDERS_START)


def _bounds_frame(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    source = LakeSource(spark, sf_dir)
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey"}
    rows = []
    for table, key in keys.items():
        b = find_bounds(source, TableSpec(table, partition_column=key, upper_bound="MAX", bounds=rule))
        rows.append((table, b.lower, b.upper, b.partitions))
    return spark.createDataFrame(
        rows, "table_name string, lower_bound bigint, upper_bound bigint, num_partitions bigint"
    )


def bounds_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounds_frame(spark, sf_dir, "count")


def bounds_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounds_frame(spark, sf_dir, "minmax")


def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LakeSource(spark, sf_dir).read(ORDERS, since=ORDERS_START)


def incremental_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LakeSource(spark, sf_dir).read(EVENTS, since=EVENT_DAYS[1], until=EVENT_DAYS[2])


def stride_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = LakeSource(spark, sf_dir)
    spec = TableSpec("orders", partition_column="o_orderkey", num_partitions=7, upper_bound="max", bounds="count")
    bounds = find_bounds(source, spec)
    return source.read(spec, bounds).withColumn("stride", _piece(stride_predicates("o_orderkey", bounds)))


def stride_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("customer", partition_column="c_custkey", num_partitions=6, lower_bound=100, upper_bound=501)
    df = LakeSource(spark, sf_dir).read(spec)
    stride = _piece(stride_predicates("c_custkey", resolve_bounds(spec, 0)))
    return df.groupBy(stride.alias("stride")).agg(F.count("*").alias("n"))


def hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = LakeSource(spark, sf_dir).read(CUSTOMER_KEYLESS)
    return with_bucket(df, "c_custkey", 2, "md5").select("c_custkey", "mod_hash_id")


def hash_bucket_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A key with repeats and NULLs: the customer of an order, left out for urgent orders.
    urgent = F.col("o_orderpriority") == "1-URGENT"
    t = LakeSource(spark, sf_dir).table("orders").select(
        F.when(~urgent, F.col("o_custkey")).alias("id"), "o_orderkey", "o_orderpriority", "o_totalprice"
    )
    return self_join_counted(t, "id", 2, "md5")


def _piece(predicates: list[str]) -> Column:
    """Which part of a split read takes a row: the number of the text sent for it."""
    return F.coalesce(*(F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)))


def _rows_per_predicate(df: DataFrame, predicates: list[str], name: str) -> DataFrame:
    """How many rows each part of a split read takes, in one pass."""
    counts = df.agg(*(F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(predicates)))
    pairs = (F.struct(F.lit(i).alias(name), F.col(f"n{i}").alias("n")) for i in range(len(predicates)))
    return counts.select(F.inline(F.array(*pairs)))


def bucketed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows_per_predicate(
        LakeSource(spark, sf_dir).table("lineitem"), bucket_predicates("l_orderkey", 4), "bucket"
    )


def date_strides(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = LakeSource(spark, sf_dir)
    spec = TableSpec("orders", partition_column="o_orderdate", num_partitions=6)
    predicates = stride_predicates("o_orderdate", find_bounds(source, spec))
    return _rows_per_predicate(source.read(spec), predicates, "stride")


def _fits(df: DataFrame, column: str, predicates: list[str], pieces: int) -> DataFrame:
    """Each row with the number of predicates that take it, and whether theirs takes no more rows than two pieces would on
    average, or a single key."""
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    df = df.withColumns({"pieces": hits, "piece": _piece(predicates)})
    per = df.groupBy("piece").agg(F.count("*").alias("n"), F.count_distinct(column).alias("keys"))
    total = F.sum("n").over(Window.partitionBy())
    fits = ((F.col("n") * pieces <= 2 * total) | (F.col("keys") <= 1)).alias("fits")
    return df.join(per.select("piece", fits), "piece").drop("piece")


def equal_row_strides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strides of a key of which a third lies in a hundredth of its range, and a tenth is one key."""
    folder = new_work_dir(spark, "skewed")
    key = F.col("o_orderkey")
    squeezed = F.when(key % 3 == 0, key.cast("long") % 50).when(key % 10 == 1, 77).otherwise(key * 100)
    orders = LakeSource(spark, sf_dir).table("orders").select("o_orderkey", squeezed.cast("long").alias("id"))
    orders.write.parquet(f"{folder}/orders.parquet")
    source = LakeSource(spark, folder)
    spec = TableSpec("orders", partition_column="id", bounds="rows", num_partitions=20)
    predicates = stride_predicates("id", equal_row_bounds(source, spec))
    return _fits(source.read(spec), "id", predicates, 20)


def text_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text key cut into ranges of its own order."""
    source = LakeSource(spark, sf_dir)
    spec = TableSpec("customer", primary_key="c_name", columns=("c_name", "c_custkey"), bounds="rows", num_partitions=16)
    predicates = stride_predicates("c_name", equal_row_bounds(source, spec))
    return _fits(source.read(spec), "c_name", predicates, 16)


def sized_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LakeSource(spark, sf_dir).count_frame(EVENTS).select("n", files_for(F.col("n"), 1000).alias("files"))


def strategy_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = LakeSource(spark, sf_dir)
    frames = []
    for kind, spec in {"dated": ORDERS, "keyed": CUSTOMER_KEYED, "keyless": SUPPLIER_KEYLESS}.items():
        strategy = read_strategy(spec)
        since = ORDERS_START if strategy == "incremental" else None
        frames.append(
            source.count_frame(spec, since).select(
                F.lit(kind).alias("spec"),
                F.lit(strategy).alias("read_strategy"),
                F.lit(layout(spec)).alias("layout"),
                "n",
                files_for(F.col("n"), 1000).alias("files"),
            )
        )
    return _union(frames)


# --- snapshots --------------------------------------------------------------------------------


def _extract_days(spark: SparkSession, sf_dir: str, spec: TableSpec, days: list[datetime], label: str) -> str:
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, label)
    for day in days:
        extract_table(spark, source, spec, day, root)
    return root


def _rows_per(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def first_run_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _extract_days(spark, sf_dir, ORDERS, [SNAPSHOT_DAY], "first_run")
    return read_snapshots(spark, table_root(root, ORDERS), ORDERS.job)


def incremental_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _extract_days(spark, sf_dir, EVENTS, EVENT_DAYS, "incremental")
    return read_snapshots(spark, table_root(root, EVENTS), EVENTS.job)


def half_day_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs within a day, each with an end: neither replaces the other."""
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, "half_days")
    spec = TableSpec("events", last_update_column="ts", primary_key="event_id", initial="since_start")
    for start, end in zip(HALF_DAYS, HALF_DAYS[1:]):
        extract_table(spark, source, spec, start, root, end)
    return read_snapshots(spark, table_root(root, spec), spec.job)


def overwrite_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _extract_days(spark, sf_dir, EVENTS, EVENT_DAYS[:2], "overwrite")
    extract_table(spark, LakeSource(spark, sf_dir), EVENTS, EVENT_DAYS[1], root, end=datetime(2024, 1, 15))
    return read_snapshots(spark, table_root(root, EVENTS), EVENTS.job)


def published_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days published together, one of them rewritten with a shorter interval, another withdrawn, and the rest cleaned away."""
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, "published")
    spec = TableSpec("events", last_update_column="ts", primary_key="event_id", initial="since_start")
    days = [datetime(2024, 1, d) for d in range(2, 7)]
    extract_days(spark, source, spec, days, root, end=datetime(2024, 1, 7))
    extract_table(spark, source, spec, days[1], root, end=datetime(2024, 1, 3, 12))
    publish(spark, table_root(root, spec), {f"{spec.job}={_tag(days[3])}": None})
    clean(spark, table_root(root, spec), older_than_hours=0)
    return read_snapshots(spark, table_root(root, spec), spec.job)


def empty_extract_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, "empty")
    spec = TableSpec("orders", last_update_column="o_orderdate", initial="since_start")
    rows = []
    for start in (ORDERS_START, datetime(2999, 1, 1)):
        result = extract_table(spark, source, spec, start, root)
        rows.append((_tag(start), result.rows, result.written))
    return spark.createDataFrame(rows, "start_tag int, rows_found bigint, written boolean")


def bucketed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, root = CUSTOMER_KEYLESS, new_work_dir(spark, "bucketed")
    for day in (SNAPSHOT_DAY, datetime(2024, 9, 2)):
        extract_table(spark, LakeSource(spark, sf_dir), spec, day, root, hash_method="md5")
    return read_snapshots(spark, table_root(root, spec), spec.job)


def _colocated_events(spark: SparkSession, sf_dir: str, label: str, keys: list[str], days: list[datetime]) -> list[DataFrame]:
    """The events since each of some days, every day as a bucketed snapshot."""
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, label)
    paths = [f"{root}/get_data={_tag(day)}" for day in days]
    for day, path in zip(days, paths):
        write_colocated(source.read(EVENTS, since=day), path, keys, 8)
    return [read_colocated(spark, p) for p in paths]


def colocated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two bucketed dates both have."""
    first, second = _colocated_events(spark, sf_dir, "colocated_join", ["event_id"], EVENT_DAYS[:2])
    return join_colocated(first, second.select("event_id", F.col("value").alias("value_again")), ["event_id"])


def colocated_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["user_id", "event_type"]
    dates = _colocated_events(spark, sf_dir, "colocated_latest", keys, EVENT_DAYS[:2])
    return latest_colocated(dates, keys, ["ts", "event_id"])


def config_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_work_dir(spark, "fanout")
    specs = parse_specs(read_yaml(FANOUT_YAML))
    extract_all(spark, lambda spec: LakeSource(spark, sf_dir), specs, SNAPSHOT_DAY, root)
    frames = []
    for spec in specs:
        df = read_snapshots(spark, table_root(root, spec), spec.job).drop(spec.job)
        name = F.lit(f"{spec.source}.{spec.database}.{spec.table}").alias("table_name")
        key, text = df.columns[0], next(c for c, t in df.dtypes if t == "string")
        frames.append(df.select(name, F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")))
    return _union(frames)


def latest_over_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _extract_days(spark, sf_dir, EVENTS, EVENT_DAYS, "latest")
    versions = read_snapshots(spark, table_root(root, EVENTS), EVENTS.job)
    return latest_state(versions, ["user_id", "event_type"], ["ts", "event_id", "get_data"]).drop("get_data")


LATEST_YAML = """
config:
- user: warehouse
  databases:
    - db_name: sales
      tbl_list:
        - {table_name: events, lastUpdate_col: ts, primaryKey_col: [user_id, event_type]}
"""


def latest_of_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping days of a table whose key, of two columns, is in the table list."""
    (spec,) = parse_specs(read_yaml(LATEST_YAML))
    root = _extract_days(spark, sf_dir, spec, EVENT_DAYS, "latest_table")
    return latest_table(spark, root, spec)


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that leave a gap and lie over one another, one rewritten with a shorter interval; what they cover, how often, and the
    events in it; then what is missing is extracted."""
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, "ledger")
    spec = TableSpec("events", last_update_column="ts", primary_key="event_id", initial="since_start")
    days = {d: datetime(2024, 1, d) for d in range(2, 9)}
    for start, end in ((2, 4), (3, 5), (6, 8), (2, 3)):
        extract_table(spark, source, spec, days[start], root, days[end])
    before = [covered(spark, root, spec).withColumn("what", F.lit("covered"))]
    extract_table(spark, source, spec, datetime(2024, 1, 4, 12), root, days[6])
    before.append(read_twice(spark, root, spec).withColumnRenamed("depth", "intervals").withColumn("what", F.lit("twice")))
    extract_missing(spark, source, spec, datetime(2024, 1, 1), datetime(2024, 1, 10), root)
    before.append(covered(spark, root, spec).withColumn("what", F.lit("at last")))
    found = _union(before)
    events = source.table("events").select("ts")
    met = found.join(events, (F.col("ts") >= F.col("since")) & (F.col("ts") < F.col("until")), "left")
    return met.groupBy("what", "since", "until", "intervals").agg(F.count("ts").alias("events"))


def reconciled_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the orders with a few rows changed, lost, doubled and added, compared with its source."""
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, "reconciled")
    path = f"{root}/get_data={_tag(SNAPSHOT_DAY)}"
    orders, key = source.table("orders"), F.col("o_orderkey")
    kept = orders.where(key % 401 != 7)
    changed = kept.withColumn("o_totalprice", F.when(key % 307 == 5, 0.0).otherwise(F.col("o_totalprice")))
    added = orders.where(key % 503 == 11).withColumn("o_orderkey", -1 - key)
    files = file_count(orders.count())
    write_snapshot(changed.unionByName(changed.where(key % 211 == 3)).unionByName(added), path, files)
    snapshot = read_snapshots(spark, root, "get_data").drop("get_data")
    found = reconcile(orders, snapshot, "o_orderkey", leaf_rows=100)
    return found.select("kind", "in_source", "in_snapshot", "o_orderkey", "o_totalprice")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as six hours of its user."""
    events = LakeSource(spark, sf_dir).table("events")
    return events.select("user_id", F.col("ts").alias("since"), (F.col("ts") + F.expr("interval 6 hours")).alias("until"))


def interval_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return islands(_visits(spark, sf_dir), ["user_id"])


def interval_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-20"))
    return gaps(_visits(spark, sf_dir), *ends, ["user_id"])


def interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(_visits(spark, sf_dir), ["user_id"])


def latest_of_two_tag_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a date, taken at a noon and, months later, at a midnight: half of its rows have changed by then."""
    spec, root = CUSTOMER_KEYED, new_work_dir(spark, "two_lengths")
    customers = LakeSource(spark, sf_dir).table("customer")
    changed = customers.where("c_custkey % 2 = 0").withColumn("c_acctbal", -F.col("c_acctbal"))
    files = file_count(customers.count())
    for tag, rows in (("20240102120000", customers), ("20240903", changed)):
        write_snapshot(rows, f"{table_root(root, spec)}/{spec.job}={tag}", files)
    return latest_table(spark, root, spec)


def refreshed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows kept up day by day; then a day is rewritten with fewer rows, one is withdrawn and one comes late."""
    (spec,) = parse_specs(read_yaml(LATEST_YAML.replace("lastUpdate_col: ts", "lastUpdate_col: ts, initial: since_start")))
    source, root = LakeSource(spark, sf_dir), new_work_dir(spark, "refreshed")

    def refresh(day: int, end: datetime) -> None:
        extract_table(spark, source, spec, datetime(2024, 1, day), root, end=end)
        refresh_latest(spark, root, spec, buckets=4, target_rows=200, least_rows=20)

    for day in (2, 3, 5, 6):
        refresh(day, datetime(2024, 1, day + 1))
    refresh(3, datetime(2024, 1, 3, 12))
    publish(spark, table_root(root, spec), {f"{spec.job}=20240105": None})
    refresh(4, datetime(2024, 1, 5))
    return read_latest(spark, root, spec)


# --- documents --------------------------------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_frame(LakeSource(spark, sf_dir).table("customer"), "c_name", ENDPOINT, PERIOD)


def _quote_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a response of two quotes: its own, and one a day later that has no volume."""

    def second(moment):
        return F.regexp_replace(moment.cast("string"), r"\.\d+$", "")

    def quote(price, volume):
        return F.struct(
            price.alias("price"),
            (price - 1).alias("change"),
            (price / 100).alias("change_percent"),
            volume.alias("volume"),
        )

    value, ts, event = F.col("value"), F.col("ts"), F.col("event_id")
    series = F.create_map(
        second(ts),
        quote(value, event),
        second(ts + F.expr("interval 1 day")),
        quote(value * 2, F.lit(None).cast("bigint")),
    )
    symbol = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    data = F.struct(symbol.alias("symbol"), F.lit("stock").alias("type"), series.alias("time_series"))
    events = LakeSource(spark, sf_dir).table("events")
    return events.select(F.to_json(F.struct(data.alias("data"))).alias("body"))


def timeseries_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_quotes(_quote_bodies(spark, sf_dir))


def quotes_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{new_work_dir(spark, 'quotes')}/quotes"
    quotes = flatten_quotes(_quote_bodies(spark, sf_dir))
    write_snapshot(quotes, f"{folder}/get_data={_tag(SNAPSHOT_DAY)}", 1, filtered=True)
    return read_snapshots(spark, folder, "get_data")


def drifting_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose quotes have fields that no list names: a venue in some, a number of trades in others."""
    event = F.col("event_id")
    quote = F.struct(
        F.col("value").alias("price"),
        event.alias("volume"),
        F.when(event % 3 == 0, F.col("event_type")).alias("venue"),
        F.when(event % 5 == 0, F.col("user_id")).alias("trades so far"),
        F.when(event % 7 == 0, F.array("event_id", "user_id")).alias("ids"),
    )
    moment = F.regexp_replace(F.col("ts").cast("string"), r"\.\d+$", "")
    symbol = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    data = F.struct(symbol.alias("symbol"), F.lit("stock").alias("type"), F.create_map(moment, quote).alias("time_series"))
    events = LakeSource(spark, sf_dir).table("events")
    return flatten_series(events.select(F.to_json(F.struct(data.alias("data"))).alias("body")))


def drifting_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User documents with a field more in some of them."""
    customers = LakeSource(spark, sf_dir).table("customer")
    user = F.struct(
        F.concat("c_name", F.lit("@example.invalid")).alias("email"),
        F.when(F.col("c_custkey") % 4 == 1, F.col("c_mktsegment")).alias("nat"),
        F.col("c_nationkey").alias("region_code"),
    )
    bodies = customers.select(F.to_json(F.struct(F.array(user).alias("results"))).alias("body"))
    return first_users(bodies, {"email": "string", "gender": "string"})


def _user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as a document of one result."""
    source = LakeSource(spark, sf_dir)
    people = (
        source.table("customer")
        .join(source.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(source.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    name, key = F.col("c_name"), F.col("c_custkey")
    user = F.struct(
        F.struct(name.alias("first"), F.col("c_mktsegment").alias("last")).alias("name"),
        F.lit("female").alias("gender"),
        F.struct(
            F.struct(key.alias("number"), name.alias("name")).alias("street"),
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("country"),
            F.col("c_nationkey").alias("postcode"),
        ).alias("location"),
        F.concat(name, F.lit("@example.invalid")).alias("email"),
        F.struct(name.alias("username")).alias("login"),
        F.struct(F.lit("1990-01-01").alias("date")).alias("dob"),
        F.struct(F.lit("2020-01-01").alias("date")).alias("registered"),
        key.cast("string").alias("phone"),
        F.struct(F.concat(name, F.lit(".jpg")).alias("medium")).alias("picture"),
    )
    return people.select(F.to_json(F.struct(F.array(user).alias("results"))).alias("body"))


def user_record_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_records(_user_documents(spark, sf_dir))


def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = LakeSource(spark, sf_dir).table("customer").select("c_custkey", "c_name")
    with_ids = assign_ids(customers, new_work_dir(spark, "ids"))
    holders = F.count("*").over(Window.partitionBy("id")).alias("rows_with_id")
    return with_ids.select("c_custkey", "c_name", is_uuid("id").alias("id_is_uuid"), holders)


# --- messages and streams ---------------------------------------------------------------------


def binary_value_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = LakeSource(spark, sf_dir).table("customer")
    return message_text(encode_messages(customers.select(F.col("c_custkey").cast("string").alias("id"))))


def to_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = LakeSource(spark, sf_dir).table("events")
    messages = encode_messages(events, key="event_id")
    return messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _finish(query) -> None:
    query.awaitTermination()


def json_parse_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "parsed")
    # The text is put together by hand, so that an error of the encoder cannot undo one of the parser.
    customers = LakeSource(spark, sf_dir).stream("customer", FILES_PER_BATCH)
    fields = []
    for i, (name, kind) in enumerate(customers.dtypes):
        quote = '"' if kind == "string" else ""
        fields += [F.lit(f'{"," if i else "{"} "{name}" : {quote}'), F.col(name).cast("string"), F.lit(quote)]
    messages = customers.select(F.encode(F.concat(*fields, F.lit("}")), "UTF-8").alias("value"))
    parsed = decode_messages(messages, customers.schema)
    _finish(append_stream(parsed, f"{path}/rows", f"{path}/checkpoint", ONCE))
    return spark.read.parquet(f"{path}/rows")


def malformed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The message of a customer in debt breaks off before its closing brace.
    path = new_work_dir(spark, "split")
    customers = LakeSource(spark, sf_dir).stream("customer", FILES_PER_BATCH)
    messages = encode_messages(customers, carry=["c_acctbal"]).select(
        F.when(F.col("c_acctbal") < 0, F.encode(F.rtrim(F.col("value").cast("string"), F.lit("}")), "UTF-8"))
        .otherwise(F.col("value"))
        .alias("value")
    )
    split = split_messages(messages, customers.schema, required=["c_custkey"])
    _finish(append_stream(split, f"{path}/rows", f"{path}/checkpoint", ONCE, partition_by=["status"]))
    return _rows_per(spark.read.parquet(f"{path}/rows"), "status")


def rejected_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected messages of a keyed stream, each with its whole text."""
    path = new_work_dir(spark, "rejected")
    customers = LakeSource(spark, sf_dir).stream("customer", FILES_PER_BATCH)
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    users = customers.select(key.alias("id"), name.alias("first_name"), "c_acctbal")
    whole = F.to_json(F.struct("id", "first_name"))
    text = F.when(F.col("c_acctbal") < 0, F.rtrim(whole, F.lit("}"))).otherwise(whole)
    messages = users.select(F.encode(text, "UTF-8").alias("value"), F.col("id").cast("bigint").alias("offset"))
    split = split_messages(messages, USER_MESSAGE, required=["id"], carry=["offset"])
    _finish(keyed_upsert_stream(split, path, f"{path}/checkpoint", ["id"], ["offset"], ONCE))
    return rejected_messages(spark, path).select("offset", "rejected_text")


def replayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of customers in debt break off; they are mended and replayed, twice. Some of these customers have sent a whole
    message since, which stays."""
    path = new_work_dir(spark, "replayed")
    customers = LakeSource(spark, sf_dir).stream("customer", FILES_PER_BATCH)
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    whole = F.to_json(F.struct(key.cast("string").alias("id"), F.col("c_name").alias("first_name")))
    later = F.to_json(F.struct(key.cast("string").alias("id"), F.lit("later").alias("first_name")))
    broken = F.when(balance < 0, F.rtrim(whole, F.lit("}"))).otherwise(whole)
    sent = F.array(F.struct(broken.alias("text"), key.alias("offset")), F.struct(later.alias("text"), (key + 10**9).alias("offset")))
    # The later message comes first here; the offset decides.
    both = customers.select(F.explode(F.when((balance < 0) & (key % 3 == 0), F.reverse(sent)).otherwise(F.slice(sent, 1, 1))).alias("m"))
    messages = both.select(F.encode("m.text", "UTF-8").alias("value"), "m.offset")
    split = split_messages(messages, USER_MESSAGE, required=["id"], carry=["offset"])
    _finish(keyed_upsert_stream(split, path, f"{path}/checkpoint", ["id"], ["offset"], ONCE))
    for _ in range(2):
        replay_rejects(
            spark, path, ["id"], ["offset"], USER_MESSAGE, lambda text: F.concat(text, F.lit("}")), ["offset"], required=["id"]
        )
    return current_state(spark, path, ["id"], ["offset"]).select("id", "first_name", "offset")


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "append")
    for _ in range(2):
        orders = LakeSource(spark, sf_dir).stream("orders", FILES_PER_BATCH)
        _finish(append_stream(orders, f"{path}/rows", f"{path}/checkpoint", ONCE))
    return spark.read.parquet(f"{path}/rows")


def _upsert_events(spark: SparkSession, sf_dir: str, fold: bool = False) -> tuple[str, list[str], list[str]]:
    path, keys, order = new_work_dir(spark, "keyed"), ["user_id"], ["timestamp", "offset"]
    events = LakeSource(spark, sf_dir).stream("events", FILES_PER_BATCH)
    messages = encode_messages(events, key="user_id", carry=["ts", "event_id"])
    messages = messages.withColumnsRenamed({"ts": "timestamp", "event_id": "offset"})
    decoded = decode_messages(messages, events.schema, carry=order)
    # The second query has a checkpoint of its own, and of the source only what a topic would still hold.
    for half, checkpoint in ((F.col("offset") % 2 == 0, "first"), (F.col("offset") % 2 == 1, "second")):
        _finish(keyed_upsert_stream(decoded.where(half), path, f"{path}/{checkpoint}", keys, order, ONCE))
        if fold:
            compact(spark, path, keys, order)
    return path, keys, order


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, keys, order = _upsert_events(spark, sf_dir)
    return current_state(spark, path, keys, order).drop(*order)


def keyed_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, keys, order = _upsert_events(spark, sf_dir, fold=True)
    return current_state(spark, path, keys, order).drop(*order)


def keyed_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight queries and as many compactions, small buckets that are split several times and runs of several sizes."""
    path, keys, order = new_work_dir(spark, "levels"), ["user_id", "event_type"], ["ts", "event_id"]
    for part in range(8):
        events = LakeSource(spark, sf_dir).stream("events", FILES_PER_BATCH).where(F.col("event_id") % 8 == part)
        _finish(keyed_upsert_stream(events, path, f"{path}/{part}", keys, order, ONCE))
        compact(spark, path, keys, order, buckets=2, remove=True, target_rows=100, least_rows=10)
    return current_state(spark, path, keys, order)


def drifting_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three queries over orders: a column that comes, one that goes, and a key that widens, folded twice."""
    path, keys, order = new_work_dir(spark, "drift"), ["o_orderkey"], ["o_orderdate"]
    versions = [
        [F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_orderdate", F.col("o_custkey").cast("int").alias("o_custkey"), "o_totalprice"],
        ["o_orderkey", "o_orderdate", "o_orderpriority", "o_custkey"],
        ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"],
    ]
    for part, columns in enumerate(versions):
        orders = LakeSource(spark, sf_dir).stream("orders", FILES_PER_BATCH).where(F.col("o_orderkey") % 3 == part)
        _finish(keyed_upsert_stream(orders.select(*columns), path, f"{path}/{part}", keys, order, ONCE))
        if part:
            compact(spark, path, keys, order, remove=True)
    return current_state(spark, path, keys, order)


# --- contract ---------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Extract the orders since a start date into a dated snapshot and read it back."""
    root = new_work_dir(spark, "entry")
    spec = TableSpec("orders", last_update_column="o_orderdate", partition_column="o_orderkey", initial="since_start")
    extract_table(spark, LakeSource(spark, SMOKE_DIR), spec, ORDERS_START, root)
    return read_snapshots(spark, table_root(root, spec), spec.job)


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "count_probe": count_probe,
        "filtered_count_probe": filtered_count_probe,
        "bounds_resolution": bounds_resolution,
        "bounds_minmax": bounds_minmax,
        "incremental_read": incremental_read,
        "incremental_interval": incremental_interval,
        "stride_read": stride_read,
        "stride_assignment": stride_assignment,
        "hash_bucket": hash_bucket,
        "hash_bucket_self_join": hash_bucket_self_join,
        "bucketed_read": bucketed_read,
        "date_strides": date_strides,
        "equal_row_strides": equal_row_strides,
        "text_key_ranges": text_key_ranges,
        "sized_file_count": sized_file_count,
        "read_strategy": strategy_choice,
        "first_run_snapshot": first_run_snapshot,
        "incremental_snapshots": incremental_snapshots,
        "half_day_snapshots": half_day_snapshots,
        "overwrite_one_date": overwrite_one_date,
        "published_days": published_days,
        "empty_extract_skip": empty_extract_skip,
        "bucketed_snapshot": bucketed_snapshot,
        "colocated_join": colocated_join,
        "colocated_latest": colocated_latest,
        "config_fanout": config_fanout,
        "latest_state": latest_over_snapshots,
        "latest_table": latest_of_spec,
        "run_ledger": run_ledger,
        "reconciled_snapshot": reconciled_snapshot,
        "interval_islands": interval_islands,
        "interval_gaps": interval_gaps,
        "interval_overlaps": interval_overlaps,
        "latest_of_two_tag_lengths": latest_of_two_tag_lengths,
        "refreshed_latest": refreshed_latest,
        "request_frame": requests,
        "timeseries_flatten": timeseries_flatten,
        "quotes_snapshot": quotes_snapshot,
        "drifting_quotes": drifting_quotes,
        "drifting_users": drifting_users,
        "user_record_format": user_record_format,
        "record_ids": record_ids,
        "binary_value_cast": binary_value_cast,
        "to_json_messages": to_json_messages,
        "json_parse_stream": json_parse_stream,
        "malformed_split": malformed_split,
        "rejected_messages": rejected_texts,
        "replayed_messages": replayed_messages,
        "append_stream": append_twice,
        "keyed_upsert_stream": keyed_upsert,
        "keyed_compaction": keyed_compaction,
        "keyed_levels": keyed_levels,
        "drifting_columns": drifting_columns,
    }


MD5_BUCKET = "cast('0x' || substr(md5(cast({key} as varchar)), 1, 8) as bigint) % 2"

LATEST_PER_USER = """
    select * from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
"""

QUOTES = """
    select 'U' || user_id as symbol, 'stock' as type, date_trunc('second', ts) as last_update_utc,
           value as price, value - 1 as change, value / 100 as change_percent, event_id as volume
    from events
    union all
    select 'U' || user_id, 'stock', date_trunc('second', ts) + interval 1 day,
           value * 2, value * 2 - 1, value * 2 / 100, null
    from events
"""


# Six hours of each event's user; those that lie over or touch one another as one.
ISLANDS = """
    visits as (select user_id, ts as since, ts + interval 6 hours as until from events),
    marked as (
        select *, coalesce(since > max(until) over (partition by user_id order by since, until
                           rows between unbounded preceding and 1 preceding), true) as apart from visits),
    numbered as (select *, sum(apart::int) over (partition by user_id order by since, until rows unbounded preceding) as island from marked),
    islands as (
        select user_id, min(since) as since, max(until) as until, count(*) as intervals from numbered group by user_id, island)
"""


def _bounds_sql(lower: str, upper: str) -> str:
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey"}
    parts = [
        f"select '{t}' as table_name, {lower.format(key=k)} as lo, {upper.format(key=k)} as hi from {t}"
        for t, k in keys.items()
    ]
    return f"""
        select table_name, lo::bigint as lower_bound, hi::bigint as upper_bound,
               greatest(1, ceil((hi - lo) / 10000.0))::bigint as num_partitions
        from ({" union all ".join(parts)})
    """


def library_sql() -> dict[str, str]:
    return {
        "count_probe": "select count(*) as n from orders",
        "filtered_count_probe": "select count(*) as n from orders where o_orderdate >= timestamp '1998-01-01'",
        "bounds_resolution": _bounds_sql("0", "count(*)"),
        "bounds_minmax": _bounds_sql("min({key})", "max({key}) + 1"),
        "incremental_read": "select * from orders where o_orderdate >= timestamp '1998-01-01'",
        "incremental_interval": """
            select * from events where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-03'
        """,
        "stride_read": """
            select orders.*, (case when o_orderkey < n * 1 // 7 then 0 when o_orderkey < n * 2 // 7 then 1
                                   when o_orderkey < n * 3 // 7 then 2 when o_orderkey < n * 4 // 7 then 3
                                   when o_orderkey < n * 5 // 7 then 4 when o_orderkey < n * 6 // 7 then 5
                                   when o_orderkey is null then 7 else 6 end)::int as stride
            from orders, (select count(*) as n from orders)
        """,
        "stride_assignment": """
            select case when c_custkey is null then 6 when c_custkey < 166 then 0 when c_custkey < 233 then 1
                        when c_custkey < 300 then 2 when c_custkey < 367 then 3 when c_custkey < 434 then 4
                        else 5 end as stride, count(*) as n
            from customer group by 1
        """,
        "hash_bucket": f"select c_custkey, {MD5_BUCKET.format(key='c_custkey')} as mod_hash_id from customer",
        "hash_bucket_self_join": f"""
            with t as (
                select case when o_orderpriority <> '1-URGENT' then o_custkey end as id,
                       o_orderkey, o_orderpriority, o_totalprice, row_number() over () as place
                from orders)
            select * exclude (place) from (
                select {MD5_BUCKET.format(key='u1.id')} as mod_hash_id, u2.*, count(*) as copies
                from t u1 full join t u2 on u1.id = u2.id
                group by all)
        """,
        "bucketed_read": """
            select bucket::int as bucket, count(l_orderkey) as n from range(5) b(bucket)
            left join lineitem on l_orderkey % 4 = bucket group by 1
        """,
        "date_strides": """
            with b as (select epoch_us(min(o_orderdate)) as lo, epoch_us(max(o_orderdate)) as hi from orders)
            select stride::int as stride, count(o_orderkey) as n from range(7) s(stride)
            left join (select o_orderkey, least(5, (epoch_us(o_orderdate) - lo) * 6 // (hi - lo)) as place from orders, b)
            on place = stride group by 1
        """,
        "equal_row_strides": """
            select o_orderkey, (case when o_orderkey % 3 = 0 then o_orderkey % 50 when o_orderkey % 10 = 1 then 77
                                     else o_orderkey * 100 end)::bigint as id, 1 as pieces, true as fits
            from orders
        """,
        "text_key_ranges": "select c_name, c_custkey, 1 as pieces, true as fits from customer",
        "sized_file_count": "select count(*) as n, cast(ceil(count(*) / 1000.0) as bigint) as files from events",
        "read_strategy": """
            select *, ceil(n / 1000.0)::bigint as files from (
                select 'dated' as spec, 'incremental' as read_strategy, 'sized' as layout, count(*) as n
                from orders where o_orderdate >= timestamp '1998-01-01'
                union all select 'keyed', 'stride', 'sized', count(*) from customer
                union all select 'keyless', 'bucket', 'bucketed', count(*) from supplier)
        """,
        "first_run_snapshot": "select *, 20240901::bigint as get_data from orders",
        "incremental_snapshots": """
            select *, 20240101::bigint as get_data from events
            union all select *, 20240102 from events where ts >= timestamp '2024-01-02'
            union all select *, 20240103 from events where ts >= timestamp '2024-01-03'
        """,
        "half_day_snapshots": """
            select *, case when ts < timestamp '2024-01-02 12:00:00' then 20240102 else 20240102120000 end as get_data
            from events where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-03'
        """,
        "overwrite_one_date": """
            select *, 20240101::bigint as get_data from events
            union all select *, 20240102 from events
            where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-15'
        """,
        "published_days": """
            select *, strftime(ts, '%Y%m%d')::bigint as get_data from events
            where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-07'
              and not (ts >= timestamp '2024-01-03 12:00:00' and ts < timestamp '2024-01-04')
              and not (ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-06')
        """,
        "empty_extract_skip": """
            select start_tag::int as start_tag, count(o_orderkey) as rows_found, count(o_orderkey) > 0 as written
            from (values (19980101, timestamp '1998-01-01'), (29990101, timestamp '2999-01-01')) v(start_tag, s)
            left join orders on o_orderdate >= s
            group by 1
        """,
        "bucketed_snapshot": f"""
            select customer.*, d::bigint as get_data, ({MD5_BUCKET.format(key='c_custkey')})::int as mod_hash_id
            from customer, (values (20240901), (20240902)) v(d)
        """,
        "colocated_join": """
            select a.*, b.value as value_again from events a join events b using (event_id)
            where a.ts >= timestamp '2024-01-01' and b.ts >= timestamp '2024-01-02'
        """,
        "colocated_latest": """
            select * from events where ts >= timestamp '2024-01-01'
            qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
        """,
        "config_fanout": """
            select 'warehouse.sales.customer' as table_name, c_custkey as key, c_name as text from customer
            union all select 'warehouse.sales.supplier', s_suppkey, s_name from supplier
            union all select 'warehouse.sales.orders', o_orderkey, o_orderstatus from orders
            union all select 'reference_data.places.region', r_regionkey, r_name from region
            union all select 'reference_data.places.nation', n_nationkey, n_name from nation
        """,
        "latest_state": """
            select * from events
            qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
        """,
        "latest_table": """
            select * from events
            qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
        """,
        "run_ledger": """
            select what, since, until, intervals::bigint as intervals, count(ts) as events
            from (values ('covered', timestamp '2024-01-02', timestamp '2024-01-05', 2),
                         ('covered', timestamp '2024-01-06', timestamp '2024-01-08', 1),
                         ('twice', timestamp '2024-01-04 12:00:00', timestamp '2024-01-05', 2),
                         ('at last', timestamp '2024-01-01', timestamp '2024-01-10', 6)) v(what, since, until, intervals)
            left join events on ts >= since and ts < until
            group by all
        """,
        "reconciled_snapshot": """
            with kept as (
                select * replace (case when o_orderkey % 307 = 5 then 0.0 else o_totalprice end as o_totalprice)
                from orders where o_orderkey % 401 <> 7),
            snapshot as (
                select * from kept union all select * from kept where o_orderkey % 211 = 3
                union all select * replace (-1 - o_orderkey as o_orderkey) from orders where o_orderkey % 503 = 11),
            counted as (
                select * exclude (s, t), sum(s)::bigint as in_source, sum(t)::bigint as in_snapshot
                from (select *, 1 as s, 0 as t from orders union all select *, 0, 1 from snapshot) group by all),
            keys as (
                select o_orderkey, sum(in_source) as a, sum(in_snapshot) as b from counted group by o_orderkey)
            select case when b = 0 then 'lost' when a = 0 then 'extra' when in_source > 0 and in_snapshot > in_source then 'doubled'
                        when in_snapshot > 0 and in_source > in_snapshot then 'thinned' else 'changed' end as kind,
                   in_source, in_snapshot, o_orderkey, o_totalprice
            from counted join keys using (o_orderkey) where in_source <> in_snapshot
        """,
        "interval_islands": f"with {ISLANDS} select * from islands",
        "interval_gaps": f"""
            with {ISLANDS},
            ends as (
                select user_id, timestamp '2024-01-05' as a, timestamp '2024-01-20' as b from islands group by user_id),
            stops as (
                select user_id, coalesce(lag(until) over (partition by user_id order by since), timestamp '1900-01-01') as since, since as until
                from islands
                union all select user_id, max(until), timestamp '2900-01-01' from islands group by user_id)
            select user_id, greatest(since, a) as since, least(until, b) as until from stops join ends using (user_id)
            where greatest(since, a) < least(until, b)
        """,
        "interval_overlaps": """
            with steps as (
                select user_id, ts as moment, 1 as step from events union all select user_id, ts + interval 6 hours, -1 from events),
            added as (select user_id, moment, sum(step) as step from steps group by all having sum(step) <> 0),
            swept as (
                select user_id, moment as since, lead(moment) over w as until, sum(step) over w as depth
                from added window w as (partition by user_id order by moment))
            select user_id, since, until, depth::bigint as depth from swept where depth >= 2
        """,
        "latest_of_two_tag_lengths": """
            select * replace (case when c_custkey % 2 = 0 then -c_acctbal else c_acctbal end as c_acctbal) from customer
        """,
        "refreshed_latest": """
            select * from events
            where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-07'
              and not (ts >= timestamp '2024-01-03 12:00:00' and ts < timestamp '2024-01-04')
              and not (ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-06')
            qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
        """,
        "request_frame": f"select '{ENDPOINT}' as endpoint, c_name as symbol, '{PERIOD}' as period from customer",
        "timeseries_flatten": QUOTES,
        "quotes_snapshot": f"select *, 20240901::bigint as get_data from ({QUOTES})",
        "drifting_quotes": """
            select 'U' || user_id as symbol, 'stock' as type, date_trunc('second', ts) as last_update_utc, value as price,
                   null::double as change, null::double as change_percent, event_id as volume,
                   case when event_id % 3 = 0 then event_type end as venue,
                   case when event_id % 5 = 0 then user_id end as "trades so far",
                   case when event_id % 7 = 0 then '[' || event_id || ',' || user_id || ']' end as ids
            from events
        """,
        "drifting_users": """
            select c_name || '@example.invalid' as email, null::varchar as gender,
                   case when c_custkey % 4 = 1 then c_mktsegment end as nat, c_nationkey::bigint as region_code
            from customer
        """,
        "user_record_format": """
            select c_name as first_name, c_mktsegment as last_name, 'female' as gender,
                   c_custkey || ' ' || c_name || ', ' || c_mktsegment || ', ' || n_name || ', ' || r_name as address,
                   c_nationkey::varchar as post_code, c_name || '@example.invalid' as email, c_name as username,
                   '1990-01-01' as dob, '2020-01-01' as registered_date, c_custkey::varchar as phone,
                   c_name || '.jpg' as picture
            from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        """,
        "record_ids": "select c_custkey, c_name, true as id_is_uuid, 1::bigint as rows_with_id from customer",
        "binary_value_cast": """select '{"id":"' || c_custkey || '"}' as value from customer""",
        "to_json_messages": """
            select event_id::varchar as key,
                   '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' ||
                   user_id || ',"event_type":"' || event_type || '","value":' || value || ',"props":' ||
                   to_json(props)::varchar || '}' as value
            from events
        """,
        "json_parse_stream": "select * from customer",
        "malformed_split": """
            select case when c_acctbal < 0 then 'rejected' else 'accepted' end as status, count(*) as n
            from customer group by 1
        """,
        "rejected_messages": """
            select c_custkey as offset, '{"id":"' || c_custkey || '","first_name":"' || c_name || '"' as rejected_text
            from customer where c_acctbal < 0
        """,
        "replayed_messages": """
            select c_custkey::varchar as id, case when newer then 'later' else c_name end as first_name,
                   c_custkey + case when newer then 1000000000 else 0 end as offset
            from (select *, c_acctbal < 0 and c_custkey % 3 = 0 as newer from customer)
        """,
        "append_stream": "select * from orders",
        "keyed_upsert_stream": LATEST_PER_USER,
        "keyed_compaction": LATEST_PER_USER,
        "keyed_levels": """
            select * from events
            qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
        """,
        "drifting_columns": """
            select distinct o_orderkey, o_orderdate, case when o_orderkey % 3 < 2 then o_custkey end as o_custkey,
                   case when o_orderkey % 3 <> 1 then o_totalprice end as o_totalprice,
                   case when o_orderkey % 3 > 0 then o_orderpriority end as o_orderpriority
            from orders
        """,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return library_queries()
    return library_queries() | llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return library_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return library_sql() | llm_queries.oracle_sql() | pipeline
