from datetime import datetime

import pytest

from sluicegate.sources.lake import LakeSource
from sluicegate.streaming.messages import decode_messages, encode_messages, split_messages
from sluicegate.streaming.stream import append_stream, compact, current_state, keyed_upsert_stream

ONCE = {"availableNow": True}
KEYS, ORDER = ["id"], ["partition", "offset"]


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of Parquet files with the columns of a topic; ``send`` adds a file."""
    folder = tmp_path / "in" / "topic.parquet"

    class Topic:
        source = LakeSource(spark, str(tmp_path / "in"))
        schema = spark.createDataFrame([], "id string, v int").schema
        offset = 0

        def send(self, *records, raw=()):
            made = spark.createDataFrame(list(records), "id string, v int")
            messages = [bytes(r["value"]) for r in encode_messages(made).collect()] + list(raw)
            rows = []
            for value in messages:
                rows.append((None, value, "users_created", 0, self.offset, datetime(2024, 1, 1)))
                self.offset += 1
            spark.createDataFrame(
                rows,
                "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
            ).coalesce(1).write.mode("append").parquet(str(folder))

        def stream(self, max_files=1):
            return decode_messages(self.source.stream("topic", max_files), self.schema, carry=ORDER)

    return Topic()


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_append_restart_and_new_data(spark, topic, tmp_path, rows):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        run(append_stream(topic.stream(), out, checkpoint, ONCE))
        return rows(spark.read.parquet(out), "id", "v")

    topic.send(("a", 1), ("b", 2))
    assert go() == [("a", 1), ("b", 2)]
    assert go() == [("a", 1), ("b", 2)]
    topic.send(("a", 3))
    assert go() == [("a", 1), ("a", 3), ("b", 2)]


def test_other_sinks(spark, topic, rows, tmp_path):
    topic.send(("a", 1))
    run(append_stream(topic.stream(), None, str(tmp_path / "c"), ONCE, sink="noop", options={"table": "t"}))


def test_split_stream_is_parted_by_status(spark, topic, tmp_path):
    out = str(tmp_path / "out")
    topic.send(("a", 1), raw=[b"{bad", b'{"v":1}'])
    split = split_messages(topic.source.stream("topic"), topic.schema, required=["id"])
    run(append_stream(split, out, str(tmp_path / "c"), ONCE, partition_by=["status"]))
    found = spark.read.parquet(out)
    assert [r["id"] for r in found.where("status = 'accepted'").collect()] == ["a"]
    assert sorted(r["rejected_text"] for r in found.where("status = 'rejected'").collect()) == ['{"v":1}', "{bad"]


@pytest.fixture
def upsert(spark, topic, tmp_path, rows):
    class Upsert:
        path, checkpoint = str(tmp_path / "state"), str(tmp_path / "state_checkpoint")

        def run(self, checkpoint=None, stream=None):
            source = topic.stream() if stream is None else stream
            run(keyed_upsert_stream(source, self.path, checkpoint or self.checkpoint, KEYS, ORDER, ONCE))
            return self.state()

        def state(self):
            return rows(current_state(spark, self.path, KEYS, ORDER), "id", "v")

        def batches(self):
            return sorted(f"{p.parent.name}/{p.name}" for p in (tmp_path / "state" / "log").glob("query=*/batch_id=*"))

    return Upsert()


def test_last_write_wins_within_and_across_batches(spark, topic, upsert):
    with pytest.raises(FileNotFoundError):
        upsert.state()
    topic.send(("a", 1), ("a", 2), ("b", 1))
    topic.send(("a", 3), ("c", 1))
    assert upsert.run() == [("a", 3), ("b", 1), ("c", 1)]
    assert len(upsert.batches()) == 2
    assert spark.read.parquet(f"{upsert.path}/log").where("id = 'a'").count() == 2
    topic.send(("b", 9))
    assert upsert.run() == [("a", 3), ("b", 9), ("c", 1)]


def test_replayed_batch_replaces_itself(spark, topic, upsert, tmp_path):
    """A batch whose commit was lost is run again under its number."""
    topic.send(("a", 1), ("b", 1))
    topic.send(("a", 2))
    before = upsert.run()
    commits = tmp_path / "state_checkpoint" / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for name in (last.name, f".{last.name}.crc"):
        (commits / name).unlink(missing_ok=True)
    log = tmp_path / "state" / "log"
    stamp = {n: (log / n / "_SUCCESS").stat().st_mtime_ns for n in upsert.batches()}
    assert upsert.run() == before
    again = {n: (log / n / "_SUCCESS").stat().st_mtime_ns for n in upsert.batches()}
    assert again.keys() == stamp.keys()
    assert [n for n in stamp if again[n] != stamp[n]] == [max(stamp)]


def test_unfinished_batch_is_not_read(topic, upsert, tmp_path):
    topic.send(("a", 1))
    topic.send(("a", 2))
    upsert.run()
    (tmp_path / "state" / "log" / upsert.batches()[-1] / "_SUCCESS").unlink()
    assert upsert.state() == [("a", 1)]


def test_compaction(spark, topic, upsert, tmp_path):
    topic.send(("a", 1), ("b", 1))
    topic.send(("a", 2))
    before = upsert.run()
    assert compact(spark, upsert.path, KEYS, ORDER) == 0
    assert upsert.state() == before
    assert compact(spark, upsert.path, KEYS, ORDER) == 0
    # Batches folded in are no longer read.
    for name in upsert.batches():
        (tmp_path / "state" / "log" / name / "_SUCCESS").unlink()
    assert upsert.state() == before
    topic.send(("b", 5), ("d", 1))
    assert upsert.run() == [("a", 2), ("b", 5), ("d", 1)]
    assert compact(spark, upsert.path, KEYS, ORDER) == 1
    assert upsert.state() == [("a", 2), ("b", 5), ("d", 1)]


@pytest.mark.parametrize("remove", [False, True])
def test_compaction_writes_touched_buckets_only(spark, topic, upsert, tmp_path, remove):
    topic.send(*((f"k{i}", i) for i in range(200)))
    upsert.run()
    compact(spark, upsert.path, KEYS, ORDER, buckets=16, remove=remove)
    topic.send(("k7", 1000))
    expected = upsert.run()
    assert compact(spark, upsert.path, KEYS, ORDER, remove=remove) == 1
    base = tmp_path / "state" / "base"
    first, second = (sorted(p.name for p in (base / f"generation={g:012d}").glob("_bucket=*")) for g in (0, 1))
    assert len(second) == 1 and len(first) == (15 if remove else 16)
    assert upsert.state() == expected and ("k7", 1000) in expected
    assert len(upsert.batches()) == (0 if remove else 2)


@pytest.mark.parametrize("fold", [False, True])
def test_a_new_checkpoint_loses_nothing(spark, topic, upsert, tmp_path, fold):
    """As a topic after its retention, the source then holds only what came later."""
    topic.send(("a", 1), ("b", 1))
    upsert.run()
    if fold:
        compact(spark, upsert.path, KEYS, ORDER)
    topic.send(("c", 5), ("b", 2))
    later = topic.stream().where("v <> 1")
    assert upsert.run(str(tmp_path / "second_checkpoint"), later) == [("a", 1), ("b", 2), ("c", 5)]
    assert len({n.split("/")[0] for n in upsert.batches()}) == 2
    if fold:
        compact(spark, upsert.path, KEYS, ORDER)
    topic.send(("a", 9))
    assert upsert.run(str(tmp_path / "second_checkpoint"), topic.stream().where("v <> 1")) == [("a", 9), ("b", 2), ("c", 5)]
    assert upsert.run() == [("a", 9), ("b", 2), ("c", 5)]


def test_out_of_order_versions(spark, topic, upsert, tmp_path):
    """The order columns decide, not the batch a version came in."""
    topic.offset = 100
    topic.send(("a", 100))
    topic.offset = 5
    topic.send(("a", 5))
    assert upsert.run() == [("a", 100)]


@pytest.fixture
def drift(spark, tmp_path):
    """A stream whose every query has a schema of its own, as after a change of its code."""

    class Drift:
        path, sent = str(tmp_path / "drift"), 0

        def send(self, rows, schema):
            folder = str(tmp_path / f"drift_in_{self.sent}")
            df = spark.createDataFrame(rows, schema)
            df.write.parquet(folder)
            stream = spark.readStream.schema(df.schema).parquet(folder)
            run(keyed_upsert_stream(stream, self.path, str(tmp_path / f"drift_c_{self.sent}"), ["id"], ["o"], ONCE))
            self.sent += 1

        def state(self):
            return {r["id"]: r.asDict(recursive=True) for r in current_state(spark, self.path, ["id"], ["o"]).collect()}

        def compact(self):
            return compact(spark, self.path, ["id"], ["o"], remove=True)

    return Drift()


@pytest.mark.parametrize("folds", [(), (0,), (0, 1), (1, 2), (0, 1, 2)])
def test_columns_that_come_go_and_widen(drift, folds):
    """Every value is kept, whichever batches are folded, and their logs removed, when the next ones come."""
    batches = [
        ([("a", 1, 5, "x"), ("b", 1, 6, None)], "id string, o int, v int, w string"),
        ([("b", 2, 2**40, {"p": 1}), ("c", 2, 8, None)], "id string, o int, v bigint, s struct<p:int>"),
        ([("c", 3, {"p": 2**40, "q": "z"}, 1.5)], "id string, o bigint, s struct<p:bigint,q:string>, d double"),
    ]
    for n, (rows, schema) in enumerate(batches):
        drift.send(rows, schema)
        if n in folds:
            drift.compact()
    none = {"v": None, "w": None, "s": None, "d": None}
    assert drift.state() == {
        "a": {"id": "a", "o": 1, **none, "v": 5, "w": "x"},
        "b": {"id": "b", "o": 2, **none, "v": 2**40, "s": {"p": 1, "q": None}},
        "c": {"id": "c", "o": 3, **none, "s": {"p": 2**40, "q": "z"}, "d": 1.5},
    }


def test_a_column_after_the_first_compaction(drift):
    drift.send([("a", 1, "x"), ("b", 1, "x")], "id string, o int, v string")
    drift.compact()
    drift.send([("b", 2, "y", "extra")], "id string, o int, v string, w string")
    expected = {"a": ("x", None), "b": ("y", "extra")}
    assert {i: (r["v"], r["w"]) for i, r in drift.state().items()} == expected
    drift.compact()
    assert {i: (r["v"], r["w"]) for i, r in drift.state().items()} == expected


def test_a_batch_whose_mark_was_lost(drift, tmp_path):
    drift.send([("a", 1, 1)], "id string, o int, v int")
    drift.send([("a", 2, 2**35)], "id string, o int, v bigint")
    marks = list((tmp_path / "drift" / "log").rglob("_schema-*"))
    assert {m.name for m in marks} == {"_schema-000000", "_schema-000001"}
    for mark in marks:
        mark.unlink()
    assert drift.state()["a"]["v"] == 2**35


def test_schemas_are_entered_once(spark, drift):
    from sluicegate.streaming.stream import schema_versions

    for o in range(3):
        drift.send([("a", o, 1)], "id string, o int, v int")
    assert len(schema_versions(spark, drift.path)) == 1
    drift.send([], "id string, o int, other date")
    assert len(schema_versions(spark, drift.path)) == 2 and drift.state()["a"]["other"] is None


def test_compaction_of_empty_batches(spark, drift):
    drift.send([], "id string, o int, v int")
    assert drift.compact() == 0 and drift.state() == {}
    drift.send([("a", 1, 1)], "id string, o int, v int")
    assert drift.compact() == 1 and drift.state()["a"]["v"] == 1
