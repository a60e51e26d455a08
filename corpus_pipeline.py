"""Five operators one after the other over ``documents``.

Each stage takes what the one before has kept, is written as Parquet and read
again. All but the last return the columns of ``documents``. A stage may only be
called when the rows of those before it are written, since it deletes the tables
that they have stored for themselves in the same session; other sessions and
threads keep theirs.
"""

from __future__ import annotations

import threading
from functools import wraps
from weakref import WeakKeyDictionary

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm import bpe, decontaminate, jaccard, lines, quality
from shopgauge.llm.common import WORD, Stored, owned, shipped, table
from shopgauge.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    field = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, field, docs.columns).where("kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the stretches of lines that occur before; ``n_chars`` follows the text.

    One of which no word is left was a copy through and through, and goes.
    """
    found = lines.dedup(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(WORD)).select(docs.columns)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id. Rows without an id stay."""
    found = jaccard.near_duplicates(docs)
    copies = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


#: What the stages called so far have stored for themselves, by session and thread.
STORED: WeakKeyDictionary[SparkSession, dict[int, Stored]] = WeakKeyDictionary()


def stage(work):
    """``work`` as a stage: what the stages before have stored for themselves goes, since their rows are written."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        mine = STORED.setdefault(spark, {}).setdefault(threading.get_ident(), Stored())
        mine.release(spark)
        with owned(mine):
            return shipped(work)(spark, docs, sf_dir)

    return run_stage


STAGES = [(work.__name__, stage(work)) for work in (quality_rules, line_dedup, near_duplicates, decontamination, encode_and_decode)]

#: A trained sequence model, content-defined chunks, components and byte-pair encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
