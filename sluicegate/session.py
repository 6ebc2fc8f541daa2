"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def jar_settings(jars: Sequence[str], packages: Sequence[str]) -> dict[str, str]:
    """JDBC drivers and connectors as the lists Spark takes."""
    settings = {}
    if jars:
        settings["spark.jars"] = ",".join(j.strip() for j in jars)
    if packages:
        settings["spark.jars.packages"] = ",".join(p.strip() for p in packages)
    return settings


def build_session(
    app: str = "sluicegate",
    *,
    master: str | None = None,
    jars: Sequence[str] = (),
    packages: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with UTC timestamps and AQE; JDBC drivers go in as a list of jars.

    Executor counts and memory belong to the deployment and are not set here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        **jar_settings(jars, packages),
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary folder only for a local master."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="sluicegate-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A path of its own for one run, below the shared folder; nothing is created yet."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, path: str, large_rows: bool = False) -> DataFrame:
    """Write once and read back.

    For values that a recomputed task would make anew (random ids, fetched bodies): whatever reads
    the result sees one state, even when executors are lost later. Parquet is read some thousand rows
    at a time; ``large_rows``, such as bodies of megabytes, go to JSON lines, which are read one by one.
    """
    if large_rows:
        df.write.mode("overwrite").json(path)
        return df.sparkSession.read.schema(df.schema).option("maxStringLen", 2**31 - 1).json(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
