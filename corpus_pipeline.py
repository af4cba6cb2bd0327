"""A training corpus from ``documents`` in five stages; each works on all rows that the stage before kept.

language ID (rows it can't name a language for go) - near duplicates (one document of each group stays) - benchmark
decontamination (documents that hold a benchmark window go) - mixing (a prefix of each domain-language-source leaf) -
sharding (shards of equal row counts; the columns ``shard`` and ``slot`` are added).

ORACLE_SQL is None: the predictions of the first stage have no SQL form; the tests hold the stages against brute force.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import contamination, language, mixing, neardup, sharding
from tableferry.llm.textkit import read_table, with_rows
from tableferry.session import new_run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of the tokens that reach the mix, at most one epoch of any document.
MIX_SHARE = 0.9


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc``, a struct of every column as it is, beside the columns that a stage works on: other names can't clash with its own."""
    return docs.select(F.struct("*").alias("doc"), *columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted language; learned from the labelled documents that are not held out."""
    model = language.learn(docs.select("doc_id", "text", "lang"))
    found = language.predict(_packed(docs, "text"), model, keep=["doc"])
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that shares 0.8 of its five-word shingles."""
    return neardup.keep_one(docs, shingle=5, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any run of ten words of a benchmark item."""
    return contamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the leaves' budgets take, each once."""
    named = mixing.with_domain(_packed(docs, "doc_id", "text", "lang", "source"))
    _, leaves = mixing.mix(named, mixing.LEVELS, mixing.WEIGHTS, MIX_SHARE, max_epochs=1)
    leaves = leaves.select(*(F.col(x).alias(f"leaf_{x}") for x in mixing.LEVELS), "epochs", "cutoff")
    rows = named.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    same = [F.coalesce(rows[x].cast("string"), F.lit("(none)")) == leaves[f"leaf_{x}"] for x in mixing.LEVELS]
    return rows.join(leaves, same).where((mixing.tokens(F.col("text")) > 0) & (mixing.epochs() > 0)).select("doc.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``shard`` and ``slot`` (columns of these names are replaced)."""
    docs = _packed(with_rows(docs.drop("shard", "slot"), "__row"), "doc_id", "text", "__row")
    rows, links = sharding.document_rows(docs, row=F.col("__row"))
    found = sharding.shard(rows, links).select(F.col("row").alias("__row"), "shard", "slot")
    return docs.select("__row", "doc").join(found, "__row").select("doc.*", "shard", "slot").drop("__row")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", sharded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again by the next stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{new_run_dir(spark, name)}/{uuid.uuid4().hex[:8]}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
