"""The jobs a deployment submits: extract tables, fetch quotes, send and take user messages.

For example ``python -m sluicegate.jobs extract --tables t.yml --env e.yml --start 2024-09-01``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluicegate.operators.documents import assign_ids, flatten_quotes, user_records
from sluicegate.operators.commits import clean
from sluicegate.operators.extract import ExtractResult, extract_all, extract_missing
from sluicegate.operators.latest import latest_table
from sluicegate.operators.refresh import refresh_latest
from sluicegate.operators.snapshot import write_snapshot
from sluicegate.plans.spec import Connection, TableSpec, load_connections, load_specs, read_yaml
from sluicegate.plans.strategy import date_tag, file_count, table_root
from sluicegate.session import build_session, new_work_dir
from sluicegate.sources.jdbc import JdbcSource
from sluicegate.sources.kafka import read_topic, send_batch
from sluicegate.sources.rest import Fetcher, fetch_bodies, http_fetcher, land_bodies, request_frame
from sluicegate.sources.storage import remove_folder
from sluicegate.streaming.messages import USER_FIELDS, USER_MESSAGE, encode_messages, split_messages
from sluicegate.streaming.stream import compact, keyed_upsert_stream, sink_stream

REQUESTS_PER_TASK = 8
# Across partitions offsets are no order in time; within one they are.
KAFKA_ORDER = ("timestamp", "partition", "offset")
FILES = ("parquet", "json", "orc", "csv")


def jdbc_sources(
    spark: SparkSession, connections: Mapping[str, Connection]
) -> Callable[[TableSpec], JdbcSource]:
    """The source of a spec by the connection and database it names."""

    def source_of(spec: TableSpec) -> JdbcSource:
        if spec.source not in connections:
            raise KeyError(f"{spec.table}: no connection for source {spec.source!r}")
        return JdbcSource(spark, connections[spec.source], spec.database)

    return source_of


def connected_specs(tables_path: str, connections: Mapping[str, Connection]) -> list[TableSpec]:
    """Every table of the list; a source without a connection is an error that names all of them."""
    specs = load_specs(tables_path)
    missing = sorted({s.source for s in specs} - set(connections))
    if missing:
        raise KeyError(f"no connection for source {', '.join(map(repr, missing))}")
    return specs


def extract_tables(
    spark: SparkSession, tables_path: str, env_path: str, start: datetime, end: datetime | None = None
) -> list[ExtractResult]:
    """Every table of the list into a snapshot of the start date, which may hold a time of day."""
    connections, root = load_connections(env_path)
    specs = connected_specs(tables_path, connections)
    return extract_all(spark, jdbc_sources(spark, connections), specs, start, root, end)


def extract_open(
    spark: SparkSession, tables_path: str, env_path: str, start: datetime, end: datetime
) -> list[ExtractResult]:
    """For every dated table of the list, what of the interval no run has read yet."""
    connections, root = load_connections(env_path)
    source_of = jdbc_sources(spark, connections)
    specs = [s for s in connected_specs(tables_path, connections) if s.last_update_column]
    return [r for s in specs for r in extract_missing(spark, source_of(s), s, start, end, root)]


def write_latest(spark: SparkSession, tables_path: str, env_path: str, target: str) -> dict[str, int]:
    """The current rows of every table of the list that names a primary key, below ``target``; rows by table."""
    _, root = load_connections(env_path)
    specs = [s for s in load_specs(tables_path) if s.primary_key]
    return {
        f"{s.source}.{s.database}.{s.table}": write_snapshot(
            latest_table(spark, root, s), table_root(target, s), 1, s.rows_per_file, filtered=True
        )
        for s in specs
    }


def refresh_tables(spark: SparkSession, tables_path: str, env_path: str, remove: bool = False) -> dict[str, list[str]]:
    """Fold what is new into the current rows of every table of the list that names a primary key; dates by table."""
    _, root = load_connections(env_path)
    specs = [s for s in load_specs(tables_path) if s.primary_key]
    return {f"{s.source}.{s.database}.{s.table}": refresh_latest(spark, root, s, remove) for s in specs}


def clean_tables(spark: SparkSession, tables_path: str, env_path: str, older_than_hours: float) -> list[str]:
    """Remove what no reader of the listed tables asks for any more; returns it."""
    _, root = load_connections(env_path)
    return [p for s in load_specs(tables_path) for p in clean(spark, table_root(root, s), older_than_hours)]


def fetch_quotes(
    spark: SparkSession,
    config: Mapping,
    endpoint: str,
    fetcher: Fetcher,
    root: str,
    day: datetime,
    job: str = "get_data",
) -> int:
    """Request every configured symbol, keep the answers, and write their quotes as a dated snapshot.

    The answers are landed as they came, failed requests with their error; returns the quotes written.
    """
    symbols = spark.createDataFrame([(s,) for s in config["symbol"]], "symbol string")
    requests = request_frame(symbols, "symbol", endpoint, config["period"])
    tasks = max(1, file_count(symbols.count(), REQUESTS_PER_TASK))
    bodies = land_bodies(fetch_bodies(requests, fetcher, tasks=tasks), f"{root}/bodies/{job}={date_tag(day)}")
    path = f"{root}/quotes/{job}={date_tag(day)}"
    return write_snapshot(flatten_quotes(bodies), path, 1, filtered=True, skip_empty=True)


def user_messages(documents: DataFrame, path: str) -> DataFrame:
    """User documents as messages keyed by an id given once, one message per document."""
    return encode_messages(assign_ids(user_records(documents), path), key="id")


def send_users(documents: DataFrame, servers: str, topic: str) -> None:
    """Send the users of landed documents to a topic. Their ids are landed while they are sent, and removed after."""
    path = new_work_dir(documents.sparkSession, "users")
    try:
        send_batch(user_messages(documents, path), servers, topic)
    finally:
        remove_folder(documents.sparkSession, path)


def decoded_users(messages: DataFrame) -> DataFrame:
    """User messages decoded; one that does not parse or has no UUID as its id is marked as rejected."""
    return split_messages(messages, USER_MESSAGE, required=["id"], carry=KAFKA_ORDER, uuids=["id"])


def take_users(
    spark: SparkSession,
    servers: str,
    topic: str,
    path: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    sink: str = "keyed",
    options: Mapping[str, str] | None = None,
    columns: Sequence[str] = (),
    **settings,
) -> StreamingQuery:
    """Keep the last message per user id below ``path``; read it with ``current_state``.

    Any other ``sink`` than ``keyed`` names a format that accepted messages are appended in, with its own ``options`` (a keyspace and a
    table, say) and the ``columns`` it has, those of a user unless given; files go to ``path``/rows where no option says
    otherwise. Rejected messages are kept below ``path`` either way; read them with ``rejected_messages``.
    """
    users = decoded_users(read_topic(spark, servers, topic, **settings))
    if sink == "keyed":
        return keyed_upsert_stream(users, path, checkpoint, ["id"], KAFKA_ORDER, trigger)
    given = dict(options or {})
    if sink in FILES:
        given.setdefault("path", f"{path}/rows")
    return sink_stream(users, sink, checkpoint, path, columns or USER_FIELDS, given, trigger)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sluicegate")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *required: str) -> argparse.ArgumentParser:
        made = jobs.add_parser(name, help=text)
        for option in required:
            made.add_argument(f"--{option}", required=True)
        return made

    extract = job("extract", "tables over JDBC into dated snapshots", "tables", "env")
    extract.add_argument("--start", required=True, type=datetime.fromisoformat)
    extract.add_argument("--end", type=datetime.fromisoformat)
    extract.add_argument("--missing", action="store_true", help="dated tables: only what no run has read, up to the end")
    job("latest", "current rows of the listed tables", "tables", "env", "target")
    refresh = job("refresh", "fold new dates into the current rows of the listed tables", "tables", "env")
    refresh.add_argument("--remove", action="store_true", help="remove what is no longer needed")
    clean_ = job("clean", "remove superseded versions of the listed tables", "tables", "env")
    clean_.add_argument("--older-than-hours", type=float, default=24.0)
    quotes = job("quotes", "quotes of the configured symbols into a dated snapshot", "config", "endpoint", "root")
    quotes.add_argument("--day", required=True, type=datetime.fromisoformat)
    quotes.add_argument("--key-env", default="key")
    quotes.add_argument("--host-env", default="host")
    job("send", "users of landed JSON documents to a topic", "documents", "servers", "topic")
    users = job("users", "user messages of a topic into a keyed log", "servers", "topic", "path", "checkpoint")
    users.add_argument("--starting-offsets", default="earliest")
    users.add_argument("--ignore-data-loss", action="store_true")
    users.add_argument("--max-offsets", type=int)
    users.add_argument("--min-partitions", type=int)
    users.add_argument("--every", help="time between micro-batches, such as '10 seconds'")
    users.add_argument("--available-now", action="store_true", help="take what is there and end")
    users.add_argument("--sink", default="keyed", help="'keyed' or a format, such as that of a database's connector")
    users.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="an option of the format")
    users.add_argument("--columns", help="the columns the format takes, by commas")
    compact_ = job("compact", "fold a keyed log into its base", "path")
    compact_.add_argument("--remove", action="store_true", help="remove what is folded")
    compact_.add_argument("--keys", default="id", help="the columns of the key, by commas")
    compact_.add_argument("--order", default=",".join(KAFKA_ORDER), help="what decides between rows of a key, by commas")
    compact_.add_argument("--buckets", type=int, default=64, help="for the first time; they split as the log grows")
    compact_.add_argument("--target-rows", type=int, default=1_000_000, help="rows a bucket has before it is split")
    return parser


def main(arguments: list[str] | None = None) -> None:
    parser = _arguments()
    asked = parser.parse_args(arguments)
    if asked.job == "extract" and asked.missing and not asked.end:
        parser.error("--missing needs --end")
    spark = build_session(f"sluicegate-{asked.job}")
    if asked.job == "extract":
        extract = extract_open if asked.missing else extract_tables
        for r in extract(spark, asked.tables, asked.env, asked.start, asked.end):
            name = f"{r.spec.source}.{r.spec.database}.{r.spec.table}"
            print(f"{name}: {r.strategy}, {r.rows} rows, {r.path or 'nothing written'}")
    elif asked.job == "latest":
        for name, rows in write_latest(spark, asked.tables, asked.env, asked.target).items():
            print(f"{name}: {rows} rows")
    elif asked.job == "refresh":
        for name, dates in refresh_tables(spark, asked.tables, asked.env, asked.remove).items():
            print(f"{name}: {', '.join(dates) or 'nothing new'}")
    elif asked.job == "clean":
        for path in clean_tables(spark, asked.tables, asked.env, asked.older_than_hours):
            print(path)
    elif asked.job == "quotes":
        with open(asked.config, encoding="utf-8") as f:
            config = read_yaml(f.read())
        fetcher = http_fetcher(asked.key_env, asked.host_env)
        print(fetch_quotes(spark, config, asked.endpoint, fetcher, asked.root, asked.day), "quotes")
    elif asked.job == "send":
        documents = spark.read.text(asked.documents).withColumnRenamed("value", "body")
        send_users(documents, asked.servers, asked.topic)
    elif asked.job == "compact":
        generation = compact(
            spark, asked.path, asked.keys.split(","), asked.order.split(","), asked.buckets, asked.remove,
            target_rows=asked.target_rows,
        )
        print("generation", generation)
    else:
        trigger = {"processingTime": asked.every} if asked.every else None
        trigger = {"availableNow": True} if asked.available_now else trigger
        wrong = [o for o in asked.option if "=" not in o]
        if wrong:
            parser.error(f"--option takes NAME=VALUE, not {wrong[0]}")
        more = {"options": dict(o.split("=", 1) for o in asked.option)} if asked.option else {}
        more |= {"columns": asked.columns.split(",")} if asked.columns else {}
        query = take_users(
            spark, asked.servers, asked.topic, asked.path, asked.checkpoint, trigger, asked.sink,
            starting_offsets=asked.starting_offsets, fail_on_data_loss=not asked.ignore_data_loss,
            max_offsets_per_trigger=asked.max_offsets, min_partitions=asked.min_partitions, **more,
        )
        query.awaitTermination()


if __name__ == "__main__":
    main()
