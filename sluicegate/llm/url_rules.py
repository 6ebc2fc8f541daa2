"""URL allow and block rules by a sort-merge range join on reversed-host keys; DataFrame functions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.llm.common import column


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    and what follows up to ``?``, ``#`` or the end. Both empty without ``://`` and for NULL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return _lower(F.regexp_extract(rest, "^([^/?#]*+)", 1)), F.regexp_extract(rest, "^[^/?#]*+([^?#]*+)", 1)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _with_chain(rules: DataFrame) -> DataFrame:
    """Each rule with the rules of its key that its path begins with, itself first: the stack of rules
    that are active where it begins."""
    begins = F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n)))
    below = rules.select("key", "path", begins.alias("outer_path"))
    outer = rules.select(F.col("key").alias("k"), F.col("path").alias("p"), "verdict", "rule", "weight")
    met = below.join(outer, (F.col("key") == F.col("k")) & (F.col("outer_path") == F.col("p")))
    active = F.struct(F.length("p").alias("n"), F.col("p").alias("path"), "rule", "verdict", "weight")
    return met.groupBy("key", "path").agg(F.sort_array(F.collect_list(active), asc=False).alias("stack"))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    keep: tuple[str, ...] = (),
    default: str = "allow",
    salts: int | None = None,
) -> DataFrame:
    """The columns of ``keep``, then ``host``, ``path``, ``rule`` and ``verdict`` of every row's URL.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains where the URL's path
    begins with the rule's; of those that fit the longest (host and path together, then the host) decides. Without one ``rule``
    is NULL and ``verdict`` is ``default``. An empty host fits all. Rules without host or verdict are left out, a NULL
    path is empty; of two for one place the verdict that sorts last holds (block over allow).

    With its labels reversed a host turns each rule into an interval of keys: all that begin with the
    rule's host and path. A URL has a key for each suffix of its host that some rule names. Rules and
    URLs are sorted together by key; going through them, the last rule begun brings the stack of the
    nested rules active there, and the URL takes the first on it that it still lies within. Rules below one host nest,
    so whatever covers a URL is on that stack.

    URLs below one host may be most of the table: they are dealt over ``salts`` sorted runs (default: the
    number of shuffle partitions), and its rules go to those runs that have URLs. Equal URLs are judged once.
    Repeated rows come out as often as they came; NULL, empty and very long URLs are judged like any other.
    """
    salts = salts or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(column(url))
    kept = [f"keep_{i}" for i in range(len(keep))]
    pages = pages.select(*(column(c).alias(k) for c, k in zip(keep, kept)), host.alias("host"), path.alias("path"))

    rules = rules.where("host is not null and verdict is not null").select(
        _lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.select(
        F.array_join(_labels(F.col("host")), ".").alias("key"),
        "path",
        "verdict",
        F.concat("host", "path").alias("rule"),
        F.struct((F.length("host") + F.length("path")).alias("n"), F.length("host").alias("h")).alias("weight"),
    )
    deepest = rules.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 0

    labels = _labels(F.col("host"))
    suffixes = F.sequence(F.lit(0), F.least(F.size(labels), F.lit(deepest)))
    keys = F.explode(F.array_distinct(F.transform(suffixes, lambda n: F.array_join(F.slice(labels, 1, n), "."))))
    named = rules.select("key").distinct()

    def keyed(urls: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64("host", "path"), F.lit(salts))
        return urls.select("host", "path", keys.alias("key"), salt.alias("salt")).join(named, "key", "left_semi")

    urls = keyed(pages.select("host", "path").distinct())
    runs = keyed(pages).select("key", "salt").distinct()
    begun = runs.join(_with_chain(rules), "key").select("key", "salt", "path", "stack", F.lit(0).alias("kind"))
    events = begun.unionByName(urls.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    sweep = W.partitionBy("key", "salt").orderBy("path", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = events.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    covering = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    found = swept.select("host", "path", F.get(covering, F.lit(0)).alias("best")).where("best is not null")
    found = found.groupBy("host", "path").agg(F.max_by("best", "best.weight").alias("best"))
    judged = pages.join(found, ["host", "path"], "left")
    return judged.select(
        *(F.col(k).alias(c) for k, c in zip(kept, keep)),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
