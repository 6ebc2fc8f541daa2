"""Documents to packed training sequences: one operator per stage, each on what the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import language, line_dedup, packing, prob_minhash, quality
from sluicegate.llm.common import column, landed
from sluicegate.llm.queries import CAPACITY, table, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The stages learn, hash and tokenize; SQL cannot express them. The tests hold them against plain versions.
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    """Only the columns of documents, so that no other one can clash."""
    return df.select(*(column(c) for c in COLUMNS))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, NULL ones among them: no language can be read in them.

    The prediction rejects nothing; it fills ``lang`` where that is NULL, if a language was learned.
    """
    docs = _documents(docs)
    found = language.identify(docs, language.learn(docs), keep=COLUMNS, letters=True)
    given = F.coalesce("lang", F.nullif("lang_pred", F.lit(language.UNKNOWN)))
    return _documents(found.where("has_letter").withColumn("lang", given))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below the threshold, by a model of the labelled ones among those that came."""
    docs = _documents(docs)
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    found = quality.score(docs, model, keep=COLUMNS)
    return _documents(found.where(F.col("quality_score") >= model.at))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that match an earlier one, and rejects documents that lose their last word by it: there is nothing of
    their own in them. Every other document stays, with the lines that are left."""
    kept = tuple(c for c in COLUMNS if c != "text")
    found = line_dedup.remove_later_lines(_documents(docs), keep=kept)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _documents(found.withColumn("n_chars", changed).where(~F.coalesce(emptied, F.lit(False))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group. Equal rows are one document; of those without a key, so are equal texts,
    which are in no group otherwise.
    """
    docs = _documents(docs).withColumn("text_hash", F.xxhash64("text"))
    found = prob_minhash.near_duplicates(docs)
    dropped = found.where(~F.col("kept")).select("doc_id", "text_hash").distinct()
    keyed = docs.where("doc_id is not null").join(dropped, ["doc_id", "text_hash"], "left_anti")
    keyed = keyed.dropDuplicates(["doc_id", "text_hash"])
    return _documents(keyed.unionByName(docs.where("doc_id is null").dropDuplicates(["text"])))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("line_dedup", remove_lines),
    ("minhash", drop_near_duplicates),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
