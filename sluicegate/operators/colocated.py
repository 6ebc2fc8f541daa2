"""Snapshots whose buckets meet without a shuffle: files by hash of a key, as Spark's bucketed tables have them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import suppress
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import named
from sluicegate.operators.latest import latest_state
from sluicegate.sources.storage import create_text, exists, read_text, remove_folder

# What a reader has to know of the files beside them.
LAYOUT = "_layout.json"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _table(path: str) -> str:
    """A name for the folder in this session's catalog; the files say all there is to know of it."""
    return f"sluicegate_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"


def write_colocated(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a folder of ``buckets`` files, each sorted by key: one for each hash bucket of the keys.

    It is one shuffle, by the keys, at the time of writing; whatever joins, groups or ranks by them later on (``read_colocated``) needs none, as
    long as the other side has as many buckets of keys of the same types. The folder must not be there yet. A
    reader finds the layout beside the files, which is written last.
    """
    spark = df.sparkSession
    if exists(spark, path):
        raise FileExistsError(path)
    name = f"sluicegate_{uuid.uuid4().hex}"
    try:
        dealt = df.repartition(buckets, *named(*keys))
        dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    except BaseException:
        remove_folder(spark, path)
        raise
    finally:
        # The table is not the session's to keep: dropping it leaves the files.
        spark.sql(f"drop table if exists {name}")
    layout = {"keys": list(keys), "buckets": buckets, "schema": json.loads(df.schema.json())}
    create_text(spark, f"{path}/{LAYOUT}", json.dumps(layout))


def read_colocated(spark: SparkSession, path: str) -> DataFrame:
    """The folder as a bucketed table of this session."""
    if not exists(spark, f"{path}/{LAYOUT}"):
        raise FileNotFoundError(f"no bucketed snapshot at {path}")
    layout = json.loads(read_text(spark, f"{path}/{LAYOUT}"))
    schema = T.StructType.fromJson(layout["schema"])
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(map(_quoted, layout["keys"]))
    where = path.replace("'", "\\'")
    made = (
        f"create table {_table(path)} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
        f"into {layout['buckets']} buckets location '{where}'"
    )
    # Two threads may read it at once: the second finds it made.
    with suppress(AnalysisException):
        spark.sql(made)
    return spark.table(_table(path))


def join_colocated(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join by the keys of two bucketed snapshots: bucket meets bucket, sorted as they lie."""
    return left.hint("merge").join(right, list(keys), how)


def latest_colocated(dates: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key over bucketed snapshots, in the order of their dates: by the ``order`` columns, and of equal ones that of
    the later date. Each date is reduced within its buckets, and two dates are joined bucket by bucket, without a shuffle; with
    each further date what the ones before it have left is shuffled once, the date itself is not.

    A row that lacks a part of its key equals no other date's: of such rows the newest of each date comes out.
    """

    def newer(old: DataFrame, new: DataFrame) -> DataFrame:
        sides = []
        for df, name in ((old, "_old"), (new, "_new")):
            row = F.struct(*named(*(c for c in df.columns if c not in keys)))
            sides.append(df.select(*named(*keys), row.alias(name), F.struct(*named(*order)).alias(f"{name}_at")))
        met = join_colocated(*sides, keys, "full")
        # A struct of NULLs lies below any other, so that a NULL counts as oldest.
        take = F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.col("_new_at") >= F.col("_old_at")))
        return met.select(*named(*keys), F.when(take, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select(*named(*keys), "_row.*")

    columns = dates[0].columns
    return reduce(newer, (latest_state(d.select(*named(*columns)), keys, order) for d in dates)).select(*named(*columns))
