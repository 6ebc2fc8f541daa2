"""Set algebra on half-open intervals: what they cover together, where they leave gaps, where they overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.functions.columns import named

#: Intervals that begin within so many seconds of one another are joined first.
CHUNK = 86_400


def _joined(df: DataFrame, by: list[Column], counted: Column) -> DataFrame:
    """Islands of each group in one sorted pass: an interval that begins after all before it have ended begins a new one."""
    before = W.partitionBy(*by).orderBy("since", "until").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*by).orderBy("since", "until").rowsBetween(W.unboundedPreceding, W.currentRow)
    apart = F.coalesce(F.col("since") > F.max("until").over(before), F.lit(True))
    numbered = df.withColumn("_apart", apart.cast("int")).withColumn("_island", F.sum("_apart").over(upto))
    return numbered.groupBy(*by, "_island").agg(
        F.min("since").alias("since"), F.max("until").alias("until"), F.sum(counted).alias("intervals")
    )


def islands(df: DataFrame, by: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """What intervals ``since, until`` cover together, per group: disjoint ones that do not touch, with the number of ``intervals`` in each.

    Empty intervals and ones without an end are left out. Joining may be done in any order, so it is done first within
    stretches of ``chunk`` seconds: of a group that holds most of the rows, only what remains of each stretch meets in one task.
    """
    keys = named(*by)
    rows = df.where("since < until").select(*keys, "since", "until")
    place = F.floor(F.unix_seconds(F.col("since").cast("timestamp")) / chunk).alias("_chunk")
    near = _joined(rows.select(*keys, "since", "until", place), [*keys, F.col("_chunk")], F.lit(1))
    return _joined(near, keys, F.col("intervals")).select(*keys, "since", "until", "intervals")


def gaps(df: DataFrame, low: Column, high: Column, by: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """What of ``low`` to ``high`` no interval covers, per group that has any."""
    keys = named(*by)
    order = W.partitionBy(*keys).orderBy("since")
    covered = islands(df, by, chunk).where((F.col("since") < high) & (F.col("until") > low))
    inner = covered.select(
        *keys,
        F.greatest(F.coalesce(F.lag("until").over(order), low), low).alias("_a"),
        F.col("since").alias("_b"),
        F.when(F.lead("since").over(order).isNull(), F.col("until")).alias("_last"),
    )
    ends = F.array(F.struct(F.col("_a").alias("since"), F.col("_b").alias("until")), F.struct(F.col("_last").alias("since"), high.alias("until")))
    found = inner.select(*keys, F.inline(ends)).where("since < until")
    # A group whose intervals all lie outside has the whole of it open.
    rest = df.select(*keys, "since", "until").where("since < until")
    inside = F.max(((F.col("since") < high) & (F.col("until") > low)).cast("int"))
    outside = rest.groupBy(*keys).agg(inside.alias("_inside")).where("_inside = 0").select(*keys, low.alias("since"), high.alias("until"))
    return found.unionByName(outside.where("since < until"))


def overlaps(df: DataFrame, by: Sequence[str] = (), least: int = 2) -> DataFrame:
    """Where at least ``least`` intervals of a group lie over one another: ``since, until`` and how many (``depth``), cut wherever
    that number changes."""
    keys = named(*by)
    rows = df.where("since < until")
    steps = rows.select(*keys, F.explode(F.array(F.struct(F.col("since").alias("at"), F.lit(1).alias("step")), F.struct(F.col("until").alias("at"), F.lit(-1).alias("step")))).alias("e"))
    # Steps at one moment are added up before they meet in a group's task.
    steps = steps.groupBy(*keys, F.col("e.at").alias("since")).agg(F.sum("e.step").alias("step")).where("step <> 0")
    order = W.partitionBy(*keys).orderBy("since")
    depth = F.sum("step").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    swept = steps.select(*keys, "since", F.lead("since").over(order).alias("until"), depth.alias("depth"))
    return swept.where(F.col("depth") >= least)
