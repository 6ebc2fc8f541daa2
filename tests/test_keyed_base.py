import random

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import keyed_base
from sluicegate.operators.keyed_base import bucket_of, fold, manifest, merging, parent_of, read_runs, rows_of
from sluicegate.operators.latest import latest_state
from sluicegate.sources.storage import create_text, read_text

KEYS, ORDER = ["id"], ["t"]
SCHEMA = "id bigint, t int, v string"


@pytest.fixture
def table(spark, tmp_path):
    class Table:
        path = str(tmp_path / "table")
        expected = {}

        def fold(self, rows, **options):
            for i, t, v in rows:
                if i not in self.expected or self.expected[i][0] <= t:
                    self.expected[i] = (t, v)
            df = spark.createDataFrame(rows, SCHEMA)
            return fold(spark, self.path, df, KEYS, ORDER, {"n": 1}, **options)

        def check(self):
            found = manifest(spark, self.path)
            state = latest_state(read_runs(spark, self.path, found, KEYS), KEYS, ORDER)
            assert {r["id"]: (r["t"], r["v"]) for r in state.collect()} == self.expected
            return found

    return Table()


def test_one_bucket_more_deals_one_bucket_anew(spark):
    ids = spark.range(2000)
    before = None
    for count in range(3, 20):
        now = {r[0]: r[1] for r in ids.select("id", bucket_of(["id"], 3, count)).collect()}
        assert set(now.values()) == set(range(count))
        if before is not None:
            moved = {(before[i], now[i]) for i in now if now[i] != before[i]}
            assert moved == {(parent_of(count - 1, 3), count - 1)}
        before = now


def test_a_key_that_widens_stays(spark):
    both = spark.range(50).select(bucket_of(["id"], 5, 7).alias("a"), F.col("id").cast("int").alias("id"))
    assert both.where(F.col("a") != bucket_of(["id"], 5, 7)).isEmpty()


def test_which_runs_merge():
    runs = [keyed_base.Run(3, 0, 10), keyed_base.Run(2, 0, 30), keyed_base.Run(1, 0, 1000)]
    assert merging(4, runs, 2, 0) == 0 and merging(5, runs, 2, 0) == 2 and merging(600, runs, 2, 0) == 3
    assert merging(1, runs, 2, 50) == 2


def test_folds_against_a_dictionary(spark, table):
    rng, shared = random.Random(3), 0
    for step in range(12):
        rows = [(rng.randrange(400), rng.randrange(step + 2), f"{step}-{i}") for i in range(60)]
        # Two rows of one key and order would leave it open which one is the newest.
        rows = list({(i, t): (i, t, f"{i}-{t}") for i, t, _ in rows}.values())
        table.fold(rows, buckets=2, target_rows=25, least_rows=0)
        found = table.check()
        shared += sum(r.folder != b for b, runs in found.runs.items() for r in runs)
    assert found.buckets > 10 and found.first_buckets == 2 and shared
    asked = spark.createDataFrame([(i,) for i in (1, 7, 399, 5000)], "id bigint")
    some = rows_of(spark, table.path, asked, KEYS, ORDER)
    assert {r["id"]: (r["t"], r["v"]) for r in some.collect()} == {i: table.expected[i] for i in (1, 7, 399) if i in table.expected}
    assert len(some.inputFiles()) < len(read_runs(spark, table.path, found, KEYS).inputFiles()) / 2


def test_rows_are_rewritten_as_often_as_the_logarithm(spark, table):
    batches, each = 48, 20
    for n in range(batches):
        table.fold([(n * each + i, n, "x") for i in range(each)], buckets=1, target_rows=10**9, least_rows=0, ratio=1)
    found = table.check()
    total = batches * each
    # Each row is written once and again whenever its run doubles; all of them each time would be 24 times the table.
    assert found.written <= total * (1 + total.bit_length() - each.bit_length() + 1)
    assert len(found.runs[0]) <= batches.bit_length()


def test_a_split_writes_nothing(spark, table):
    table.fold([(i, 0, "x") for i in range(300)], buckets=3, target_rows=40)
    found = table.check()
    assert found.written == 300 and found.buckets == 8 and len(found.runs) == 8
    assert len({(r.generation, r.folder) for runs in found.runs.values() for r in runs}) == 3
    # One key touches one bucket; the rows that its folder holds of others are not written.
    table.fold([(5, 1, "y")], target_rows=40)
    after = table.check()
    assert after.written - 300 < 60


def test_rows_that_go_do_not_come_back_through_a_shared_run(spark, table):
    table.fold([(i, i % 7, "old") for i in range(200)], buckets=2, target_rows=30)
    before = table.check()
    gone = [i for i in range(200) if i % 7 == 3]
    keys = spark.createDataFrame([(i,) for i in gone], "id bigint")
    one = keys.where(bucket_of(KEYS, before.first_buckets, before.buckets) == 1)
    some = [r[0] for r in one.collect()]
    none = spark.createDataFrame([], SCHEMA)
    fold(spark, table.path, none, KEYS, ORDER, {}, target_rows=30, gone=F.col("t") == 3, rebuilt=one)
    for i in some:
        del table.expected[i]
    table.check()
    # Its sibling is merged from the folder that both shared.
    other = parent_of(before.buckets - 1, 2)
    sibling = [r[0] for r in spark.range(200).where(bucket_of(KEYS, 2, before.buckets) == other).collect()]
    table.fold([(sibling[0], 9, "new")], target_rows=30)
    table.fold([(i, 9, "new") for i in range(0, 200, 11)], target_rows=30)
    table.check()


def test_an_emptied_bucket(spark, table):
    table.fold([(1, 0, "a"), (2, 1, "b")], buckets=1)
    none = spark.createDataFrame([], SCHEMA)
    keys = spark.createDataFrame([(1,), (2,)], "id bigint")
    after, free = fold(spark, table.path, none, KEYS, ORDER, {}, gone=F.lit(True), rebuilt=keys)
    table.expected.clear()
    assert after.runs == {} and len(free) == 1
    table.check()
    table.fold([(3, 0, "c")])
    table.check()


def test_no_changes_and_null_keys(spark, table):
    table.fold([])
    assert table.check().generation == 0
    table.fold([(None, 1, "a"), (None, 2, "b"), (1, 1, "c")], buckets=4)
    assert table.check().rows == 2


def test_of_two_folds_at_once_one_fails(spark, table):
    table.fold([(1, 0, "a")], buckets=1)
    taken = f"{table.path}/manifest/{1:012d}.json"
    assert create_text(spark, taken, read_text(spark, f"{table.path}/manifest/{0:012d}.json"))
    assert not create_text(spark, taken, "other")
    with pytest.raises(RuntimeError, match="faster"):
        df = spark.createDataFrame([(1, 5, "late")], SCHEMA)
        original = keyed_base.manifest
        keyed_base.manifest = lambda s, p: keyed_base.Manifest(
            **{**original(s, p).__dict__, "generation": 0}
        )
        try:
            fold(spark, table.path, df, KEYS, ORDER, {})
        finally:
            keyed_base.manifest = original
    table.check()


def test_a_key_of_another_kind_is_refused(spark, table):
    table.fold([(1, 0, "a")])
    with pytest.raises(ValueError, match="changed"):
        fold(spark, table.path, spark.createDataFrame([("1", 1, "b")], "id string, t int, v string"), KEYS, ORDER, {})


def test_many_split_buckets_are_joined(spark, table, monkeypatch):
    monkeypatch.setattr(keyed_base, "LISTED", 1)
    table.fold([(i, 0, "x") for i in range(200)], buckets=2, target_rows=20)
    table.fold([(i, 1, "y") for i in range(0, 200, 9)], target_rows=20, least_rows=0)
    table.fold([(i, 2, "z") for i in range(0, 200, 3)], target_rows=20)
    table.check()


def test_many_small_buckets_share_few_folders(spark, table, monkeypatch):
    monkeypatch.setattr(keyed_base, "FOLDERS", 4)
    rng = random.Random(5)
    for step in range(6):
        rows = {(rng.randrange(300), step): f"{step}" for _ in range(90)}
        table.fold([(i, t, v) for (i, t), v in rows.items()], buckets=2, target_rows=5, least_rows=step % 3 * 5, ratio=0.5)
        found = table.check()
    assert found.buckets > 40 and max(len(runs) for runs in found.runs.values()) > 1
    folders = {(r.generation, r.folder) for runs in found.runs.values() for r in runs}
    assert all(sum(g == generation for g, _ in folders) <= 4 for generation in range(6))
    asked = spark.createDataFrame([(i,) for i in range(0, 300, 40)], "id bigint")
    some = {r["id"]: (r["t"], r["v"]) for r in rows_of(spark, table.path, asked, KEYS, ORDER).collect()}
    assert some == {i: table.expected[i] for i in range(0, 300, 40) if i in table.expected}


def test_folders_grow_with_rows_and_not_with_buckets():
    assert [keyed_base.folders_for(n, 2, 27_000) for n in (0, 2_700_000, 10**8)] == [256, 256, 1000]
    assert keyed_base.folders_for(10, 2, 200) == 200 and keyed_base.folders_for(10, 500, 900) == 500


@pytest.mark.parametrize("listed", [0, 1000])
def test_a_folder_of_one_generation_gives_no_rows_of_a_bucket_wanted_of_another(spark, table, monkeypatch, listed):
    """Rows that are gone from a bucket still lie in the folder it shared, where only its neighbour is read."""
    monkeypatch.setattr(keyed_base, "LISTED", listed)
    monkeypatch.setattr(keyed_base, "FOLDERS", 1)
    table.fold([(i, 0, "old") for i in range(200)], buckets=1, target_rows=25, least_rows=0)
    count = table.check().buckets
    at = {r[0]: r[1] for r in spark.range(200).select("id", bucket_of(KEYS, 1, count)).collect()}
    one, other, third = (sorted(i for i, b in at.items() if b == bucket) for bucket in (0, 1, 2))
    keys = spark.createDataFrame([(i,) for i in one + third], "id bigint")
    extra = spark.createDataFrame([(one[0], 1, "new")], SCHEMA)
    fold(spark, table.path, extra, KEYS, ORDER, {}, target_rows=25, gone=F.col("t") == 0, rebuilt=keys)
    for i in one + third:
        del table.expected[i]
    table.expected[one[0]] = (1, "new")
    table.check()
    # One bucket is wanted of the second generation's folder, its neighbour of the first one's.
    table.fold([(one[0], 2, "newer"), *((i, 2, "other") for i in other)], target_rows=25, least_rows=0)
    table.check()
