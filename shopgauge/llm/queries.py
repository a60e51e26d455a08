"""One query for each operator, over its whole table and with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm import bpe, chosen_path, decontaminate, jaccard, langid, lines, pii, quality, search, shards, toxicity, warc, whitening
from shopgauge.llm.common import remainder, shipped, table
from shopgauge.session import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the lexicon is learned from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    lexicon = toxicity.fit(docs, labels)
    return toxicity.score(docs, lexicon, ["doc_id", "held_out"])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold, one row for each pair."""
    found = decontaminate.flag(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the stretches of lines that occur before it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])),
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, linked from a similarity of 0.8."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; the field is trained on the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, field, ["doc_id"])


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = shards.shard_table(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page into archives in the shared folder and read them back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (remainder("doc_id", 4) == 2).alias("held_out"))
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 16)


def op13_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of every document, linked from a similarity of 0.8 of two-word shingles."""
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_toxicity": op1_toxicity,
        "op2_decontamination": op2_decontamination,
        "op3_line_dedup": op3_line_dedup,
        "op4_pii": op4_pii,
        "op5_jaccard": op5_jaccard,
        "op6_quality": op6_quality,
        "op7_sharding": op7_sharding,
        "op8_bpe": op8_bpe,
        "op9_warc": op9_warc,
        "op10_language": op10_language,
        "op11_search": op11_search,
        "op12_whitening": op12_whitening,
        "op13_near_duplicates": op13_near_duplicates,
    }
    return {name: shipped(query) for name, query in found.items()}


#: What ``op11_search`` computes, said as one statement.
SEARCH_SQL = r"""
WITH doc_terms AS (
    SELECT doc_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents)
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL
), lengths AS (
    SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY ALL
), sizes AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
), factors AS (
    SELECT doc_id, 25 + (75 * n * docs) // total AS m FROM lengths, sizes
), weights AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sizes GROUP BY term
), item_terms AS (
    SELECT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM item_terms JOIN weights USING (term) JOIN tf USING (term) JOIN factors USING (doc_id) GROUP BY ALL
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_search": SEARCH_SQL}
