import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluicegate import jobs
from sluicegate.operators.documents import user_records
from sluicegate.operators.snapshot import read_snapshots
from sluicegate.plans.spec import Connection, TableSpec
from sluicegate.plans.strategy import table_root
from sluicegate.streaming.messages import USER_FIELDS
from sluicegate.streaming.stream import current_state, keyed_upsert_stream, rejected_messages

DAY = datetime(2024, 9, 1)


def test_each_spec_finds_its_source(spark):
    source_of = jobs.jdbc_sources(spark, {"pg": Connection("pg", "jdbc:postgresql://h/")})
    assert source_of(TableSpec("t", source="pg", database="shop")).base_options()["url"] == "jdbc:postgresql://h/shop"
    with pytest.raises(KeyError, match="other"):
        source_of(TableSpec("t", source="other"))


def test_extract_tables_from_files(spark, lake, tmp_path, monkeypatch):
    root = tmp_path / "lake_out"
    (tmp_path / "env.yml").write_text(f'hdfs: "{root}/"\ndb:\n- {{user: pg, url: "jdbc:postgresql://h/"}}\n')
    (tmp_path / "tables.yml").write_text(
        """
config:
- user: pg
  databases:
  - {db_name: shop, job: get_data, tbl_list: [{table_name: customer, partitionColumn: c_custkey, primaryKey_col: c_custkey}]}
- user: not_connected
  databases:
  - {db_name: shop, job: get_data, tbl_list: [{table_name: orders}]}
"""
    )
    monkeypatch.setattr(jobs, "jdbc_sources", lambda spark, connections: lambda spec: lake)
    files = str(tmp_path / "tables.yml"), str(tmp_path / "env.yml")
    with pytest.raises(KeyError, match="'not_connected'"):
        jobs.extract_tables(spark, *files, DAY)
    with open(files[1], "a") as env:
        env.write('- {user: not_connected, url: "jdbc:postgresql://h/", fetchsize: 5, options: {ssl: true}}\n')
    result, other = jobs.extract_tables(spark, *files, DAY)
    assert (result.spec.table, result.rows, result.written) == ("customer", 150, True)
    assert (other.spec.table, other.rows) == ("orders", 1500)
    assert result.path == f"{root}/pg/shop/customer/get_data=20240901"
    assert read_snapshots(spark, table_root(str(root), result.spec), "get_data").count() == 150
    latest = jobs.write_latest(spark, *files, str(tmp_path / "now"))
    assert latest == {"pg.shop.customer": 150}
    assert spark.read.parquet(str(tmp_path / "now/pg/shop/customer")).columns == lake.table("customer").columns


def test_quotes_of_the_configured_symbols(spark, tmp_path):
    def fetch(request):
        if request["symbol"] == "GONE":
            raise LookupError("GONE")
        quote = {"price": 1.0, "change": 0.0, "change_percent": 0.0}
        series = {f"2024-01-0{d} 00:00:00": quote for d in (1, 2)}
        return json.dumps({"data": {"symbol": request["symbol"], "type": "stock", "time_series": series}})

    config = {"symbol": ["ASH:LSE", "ELM:LSE", "GONE"], "period": "MAX"}
    written = jobs.fetch_quotes(spark, config, "https://example.invalid/q", fetch, str(tmp_path), DAY)
    quotes = read_snapshots(spark, f"{tmp_path}/quotes", "get_data")
    assert written == quotes.count() == 4
    bodies = spark.read.json(f"{tmp_path}/bodies/get_data=20240901")
    assert bodies.where("error is not null").select("symbol").collect() == [("GONE",)]
    nothing = jobs.fetch_quotes(spark, {"symbol": ["GONE"], "period": "MAX"}, "e", fetch, str(tmp_path / "b"), DAY)
    assert nothing == 0 and not list((tmp_path / "b" / "quotes").iterdir())


def test_users_from_documents_to_keyed_state(spark, tmp_path, rows):
    """Document, record, id, message, topic, stream, state: what went in comes out once."""
    documents = spark.range(20).select(
        F.format_string('{"results":[{"name":{"first":"u%s"},"email":null}]}', "id").alias("body")
    )
    messages = jobs.user_messages(documents, str(tmp_path / "ids"))
    assert messages.columns == ["key", "value"]
    topic = messages.withColumn("partition", F.lit(0)).withColumn("offset", F.monotonically_increasing_id())
    topic = topic.withColumn("timestamp", F.lit(DAY))
    bad = topic.limit(1).select("key", F.lit(b"{bad").alias("value"), "partition", F.lit(10**12).alias("offset"), "timestamp")
    for _ in range(2):
        topic.unionByName(bad).write.mode("append").parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(topic.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "topic"))
    state = str(tmp_path / "state")
    keyed_upsert_stream(
        jobs.decoded_users(stream), state, str(tmp_path / "c"), ["id"], jobs.KAFKA_ORDER, {"availableNow": True}
    ).awaitTermination()
    found = current_state(spark, state, ["id"], jobs.KAFKA_ORDER)
    assert found.columns == [*USER_FIELDS, *jobs.KAFKA_ORDER]
    assert rows(found, "first_name") == rows(user_records(documents), "first_name")
    assert rows(rejected_messages(spark, state), "rejected_text", "offset") == [("{bad", 10**12)] * 2
    before = rows(found)
    assert jobs.compact(spark, state, ["id"], jobs.KAFKA_ORDER, remove=True) == 0
    assert rows(current_state(spark, state, ["id"], jobs.KAFKA_ORDER)) == before


def test_users_are_sent_and_the_landed_ids_removed(spark, tmp_path, monkeypatch):
    sent = {}

    def send(messages, servers, topic):
        sent.update(servers=servers, topic=topic, keys=[bytes(r["key"]) for r in messages.collect()])

    monkeypatch.setattr(jobs, "send_batch", send)
    monkeypatch.setattr(jobs, "new_work_dir", lambda spark, label: str(tmp_path / label))
    documents = spark.createDataFrame([('{"results":[{"gender":"male"}]}',)] * 3, "body string")
    jobs.send_users(documents, "h:9092", "t")
    assert (sent["servers"], sent["topic"], len(set(sent["keys"]))) == ("h:9092", "t", 3)
    assert not (tmp_path / "users").exists()


def test_the_latest_message_is_the_latest_in_time(spark):
    """Across topic partitions the offset says nothing."""
    from sluicegate.operators.latest import latest_state

    rows = [("u", "old", 9, 50, datetime(2024, 1, 1)), ("u", "new", 0, 3, datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "id string, v string, partition int, offset bigint, timestamp timestamp")
    assert latest_state(df, ["id"], jobs.KAFKA_ORDER).first()["v"] == "new"


def test_users_are_taken_until_the_query_stops(spark, tmp_path, monkeypatch, rows):
    one, two = ("0b7e8a52-7c1e-4b55-9d0f-0c6f3a1d2e4%d" % i for i in (1, 2))

    def send(*messages):
        made = [(f'{{"id":"{i}","first_name":"{n}"}}'.encode(), 0, offset, DAY) for i, n, offset in messages]
        made = spark.createDataFrame(made, "value binary, partition int, offset bigint, timestamp timestamp")
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "topic"))

    def read_topic(spark, servers, topic, **settings):
        assert (servers, topic, settings) == ("h:9092", "users", {"fail_on_data_loss": False})
        schema = "value binary, partition int, offset bigint, timestamp timestamp"
        return spark.readStream.schema(schema).parquet(str(tmp_path / "topic"))

    monkeypatch.setattr(jobs, "read_topic", read_topic)
    send((one, "a", 0), (two, "b", 1), ("no uuid", "c", 2))
    state = str(tmp_path / "state")
    query = jobs.take_users(spark, "h:9092", "users", state, str(tmp_path / "c"), fail_on_data_loss=False)
    try:
        query.processAllAvailable()
        send((one, "d", 3))
        query.processAllAvailable()
    finally:
        query.stop()
    found = current_state(spark, state, ["id"], jobs.KAFKA_ORDER)
    assert rows(found, "id", "first_name") == [(one, "d"), (two, "b")]
    assert rows(rejected_messages(spark, state), "offset") == [(2,)]


def test_command_line_wants_its_arguments(capsys):
    with pytest.raises(SystemExit):
        jobs.main(["extract", "--tables", "t.yml"])
    assert "--env" in capsys.readouterr().err


def test_command_line_passes_the_topic_options_on(spark, monkeypatch):
    asked = {}

    class Query:
        def awaitTermination(self):
            asked["waited"] = True

    def take_users(spark, servers, topic, path, checkpoint, trigger, sink, **settings):
        asked.update(settings, topic=topic, trigger=trigger, sink=sink)
        return Query()

    monkeypatch.setattr(jobs, "take_users", take_users)
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    common = ["users", "--servers", "h", "--topic", "t", "--path", "p", "--checkpoint", "c"]
    jobs.main([*common, "--starting-offsets", "latest", "--ignore-data-loss", "--max-offsets", "9", "--available-now"])
    assert asked == {
        "topic": "t", "trigger": {"availableNow": True}, "sink": "keyed", "starting_offsets": "latest",
        "fail_on_data_loss": False, "max_offsets_per_trigger": 9, "min_partitions": None, "waited": True,
    }
    jobs.main([*common, "--every", "10 seconds", "--sink", "json"])
    assert asked["trigger"] == {"processingTime": "10 seconds"} and asked["sink"] == "json"
    jobs.main([*common, "--sink", "db", "--option", "keyspace=users", "--option", "url=a=b", "--columns", "id,email"])
    assert asked["options"] == {"keyspace": "users", "url": "a=b"} and asked["columns"] == ["id", "email"]
    with pytest.raises(SystemExit):
        jobs.main([*common, "--option", "keyspace"])


def test_command_line_compacts_by_any_key(monkeypatch, spark):
    asked = {}

    def compact(spark, path, keys, order, buckets, remove, **levels):
        asked.update(path=path, keys=keys, order=order, buckets=buckets, remove=remove, **levels)

    monkeypatch.setattr(jobs, "compact", compact)
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    jobs.main(["compact", "--path", "p"])
    assert asked == {
        "path": "p", "keys": ["id"], "order": ["timestamp", "partition", "offset"], "buckets": 64, "remove": False, "target_rows": 1_000_000,
    }
    jobs.main(["compact", "--path", "p", "--keys", "a,b", "--order", "t", "--buckets", "3", "--target-rows", "9", "--remove"])
    assert asked == {"path": "p", "keys": ["a", "b"], "order": ["t"], "buckets": 3, "remove": True, "target_rows": 9}


@pytest.fixture
def topic(spark, tmp_path, monkeypatch):
    """Two whole messages and one that breaks off, where the topic would be."""
    one, two = ("0b7e8a52-7c1e-4b55-9d0f-0c6f3a1d2e4%d" % i for i in (1, 2))
    texts = [f'{{"id":"{one}","first_name":"a","dob":"x"}}', f'{{"id":"{two}","first_name":"b"}}', f'{{"id":"{two}"']
    made = [(t.encode(), 0, offset, DAY) for offset, t in enumerate(texts)]
    made = spark.createDataFrame(made, "value binary, partition int, offset bigint, timestamp timestamp")
    made.coalesce(1).write.parquet(str(tmp_path / "topic"))
    monkeypatch.setattr(jobs, "read_topic", lambda *_: spark.readStream.schema(made.schema).parquet(str(tmp_path / "topic")))
    return one, two


@pytest.mark.parametrize("options", [None, {"path": "elsewhere"}])
def test_another_sink_gets_its_columns_and_the_rejected_stay_apart(spark, tmp_path, topic, rows, options):
    options = options and {"path": str(tmp_path / options["path"])}
    path = str(tmp_path / "out")
    columns = [c for c in USER_FIELDS if c != "dob"]
    jobs.take_users(
        spark, "h", "t", path, str(tmp_path / "c"), {"availableNow": True}, "json", options, columns
    ).awaitTermination()
    written = spark.read.json(options["path"] if options else f"{path}/rows")
    assert set(written.columns) <= set(columns) and rows(written, "id", "first_name") == list(zip(topic, "ab"))
    assert rows(rejected_messages(spark, path), "offset") == [(2,)]


def test_a_sink_that_takes_no_path(spark, tmp_path, topic):
    query = jobs.take_users(spark, "h", "t", str(tmp_path / "out"), str(tmp_path / "c"), {"availableNow": True}, "noop", {"table": "t"})
    query.awaitTermination()
    assert query.exception() is None and not (tmp_path / "out" / "rows").exists()


def test_rejected_messages_are_replayed_once(spark, tmp_path, topic, rows, monkeypatch):
    from sluicegate.streaming import stream
    from sluicegate.streaming.messages import USER_MESSAGE
    from sluicegate.streaming.stream import open_rejects, replay_rejects

    one, two = topic
    state = str(tmp_path / "state")
    jobs.take_users(spark, "h", "t", state, str(tmp_path / "c"), {"availableNow": True}).awaitTermination()

    def replay(repair):
        place = ["partition", "offset"]
        return replay_rejects(spark, state, ["id"], jobs.KAFKA_ORDER, USER_MESSAGE, repair, place, ["id"], ["id"])

    def now():
        return rows(current_state(spark, state, ["id"], jobs.KAFKA_ORDER), "id", "first_name", "offset")

    before = now()
    assert replay(lambda text: text) == 0 and now() == before
    assert open_rejects(spark, state, ["partition", "offset"]).count() == 1
    # The driver is lost between the rows and the ledger.
    with monkeypatch.context() as m:
        keep = stream._keep
        m.setattr(stream, "_keep", lambda *a: (keep(*a), (_ for _ in ()).throw(OSError("lost"))))
        with pytest.raises(OSError):
            replay(lambda text: F.concat(text, F.lit("}")))
    after = now()
    assert after == [(one, "a", 0), (two, None, 2)]
    for expected in (1, 0):
        assert replay(lambda text: F.concat(text, F.lit("}"))) == expected and now() == after
        jobs.compact(spark, state, ["id"], jobs.KAFKA_ORDER, remove=True)
        assert now() == after
    assert open_rejects(spark, state, ["partition", "offset"]).isEmpty()
    assert rejected_messages(spark, state).count() == 1
