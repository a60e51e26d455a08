"""Removal of stretches of lines that occur again anywhere in the corpus.

A stretch of two lines with words and more is repeated where each pair of
neighbouring lines with words in it is, with the blank lines between them. So
every pair is counted over the whole corpus, by its hash, and lines go with each
pair that has occurred before. So the same stretch is found wherever it stands,
from its first line to its last, whatever is around it; a single line never goes
because of the blank lines beside it. A line as long as a passage counts alone as
well. What has one hash is compared byte by byte; the first occurrence stays and
the others go.

Where blank lines stand together, whole chunks count besides, cut at places that
the lines themselves choose: a rolling hash over the hashes of two neighbouring
lines, and a cut behind every line where it is smaller than before and behind.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import Stored, owned, shuffles_freed, store

#: A line of so many words is a passage, and counts by itself.
PASSAGE = 50


def chunks_of(lines: Column, hashes: Column, passage: Column) -> Column:
    """Chunks of a text's lines: ``first`` and ``last`` line, from 0. All three are columns of arrays by line."""
    n = F.size(lines)
    rolling = lambda i: F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i))
    lowest = lambda i: (i > 0) & (rolling(i) < rolling(i - 1)) & (rolling(i) <= rolling(i + 1))
    cut = lambda i: (i == n - 1) | F.get(passage, i) | F.get(passage, i + 1) | lowest(i)
    ends = F.filter(F.sequence(F.lit(0), n - 1), cut)
    return F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda e: e + 1)),
        ends,
        lambda a, b: F.struct(a.alias("first"), b.alias("last")),
    )


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["first"] + 1, chunk["last"] - chunk["first"] + 1), "\n")


def span_texts(joined: DataFrame) -> DataFrame:
    """``doc_id, _own, span, bytes``: each of ``_spans`` with its text.

    A document's spans get their texts before they become rows. Done in each row,
    the whole text would go into it and be split again, as often as there are spans.
    """
    lines = joined.where("_spans is not null").select("doc_id", "_own", "_spans", F.split("text", "\n").alias("lines"))
    with_bytes = F.transform("_spans", lambda s: F.struct(s.alias("span"), chunk_text(F.col("lines"), s).alias("bytes")))
    return lines.select("doc_id", "_own", F.inline(with_bytes))


def cut(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """``_id, _row, first, last, hash`` of all that may go: pairs of neighbouring lines with words, passages, and chunks with blank lines together.

    ``_row`` is the hash of the text. What has less than two lines with words is left out, but for passages.
    """
    blank = r"^[\x20\x09-\x0D]*$"
    lines = docs.where("text is not null").select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_row"), F.split("text", "\n").alias("lines")
    )
    # as many words and more, without a list of them
    many = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{passage - 1}}}[^\x20\x09-\x0D]" if passage > 0 else ""
    long = lambda x: F.when(F.length(x) >= 2 * passage - 1, x.rlike(many)).otherwise(F.lit(False))
    marked = lines.select(
        "_id",
        "_row",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("lines", long).alias("passage"),
        F.transform("lines", lambda x: x.rlike(blank)).alias("blank"),
    )
    none = F.array().cast("array<struct<first:int,last:int,hash:bigint>>")
    unit = lambda first, last, hash_: F.struct(first.alias("first"), last.alias("last"), hash_.alias("hash"))
    at = lambda name, i: F.get(F.col(name), i)
    n = F.size("hashes")
    starts = F.sequence(F.lit(0), n - 2)
    together = lambda i: at("blank", i) & at("blank", i + 1)
    # a column of its own, since it stands in several places below
    marked = marked.withColumn("spoken", F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~at("blank", i)))
    spoken = F.col("spoken")
    between = lambda i, j: F.when(j == i + 1, F.xxhash64(at("hashes", i), at("hashes", j))).otherwise(F.xxhash64(F.slice("hashes", i + 1, j - i + 1)))
    but_one = F.greatest(F.size(spoken) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(spoken, 1, but_one), F.slice(spoken, 2, but_one), lambda i, j: unit(i, j, between(i, j)))
    singles = F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda i: at("passage", i)), lambda i: unit(i, i, at("hashes", i)))
    part = lambda name, c: F.slice(name, c["first"] + 1, c["last"] - c["first"] + 1)
    # of chunks without blank lines together, the pairs say as much
    gaps = F.filter(
        chunks_of(F.col("hashes"), F.col("hashes"), F.col("passage")),
        lambda c: F.exists(F.sequence(c["first"], c["last"]), lambda i: (i < c["last"]) & together(i)) & (F.size(F.filter(part("blank", c), lambda x: ~x)) >= 2),
    )
    chunks = F.transform(gaps, lambda c: unit(c["first"], c["last"], F.xxhash64(part("hashes", c))))
    some = F.when(n > 1, F.exists(starts, together)).otherwise(F.lit(False))
    found = F.concat(F.when(F.size(spoken) > 1, pairs).otherwise(none), singles, F.when(some, chunks).otherwise(none))
    return marked.select("_id", "_row", F.explode(found).alias("unit")).select("_id", "_row", "unit.first", "unit.last", "unit.hash")


def repeated(chunks: DataFrame) -> DataFrame:
    """The chunks whose hash occurs more than once, and whether each is the first of them.

    First is the smallest id, then the smallest text hash, then the earliest
    line; null ids come first.
    """
    place = F.struct("_id", "_row", "first")
    often = chunks.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("kept")).where("n > 1")
    return chunks.join(often, "hash").select("_id", "_row", "first", "last", "hash", place.eqNullSafe(F.col("kept")).alias("stays"))


def dedup(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines`` and ``n_removed`` (lines) besides.

    A line goes if a pair, passage or chunk that it is in has occurred before.
    Of each line that goes an equal one stays at an earlier place, since the
    earliest never goes. Every row stays, also where nothing is left of its text. Null texts stay null and have no lines. Rows that repeat
    both id and text count as one document: they aren't copies of each other,
    and come out alike. Chunks of different bytes under one hash are compared
    by their texts instead, so only equal bytes are ever removed. Other columns
    stay as they are; columns named ``n_lines`` or ``n_removed`` are replaced.

    The texts are shuffled once, to their spans, and stored. What other steps shuffle
    goes when they are done, and so do the chunks, so they don't lie on the disk together.
    """
    docs = docs.drop("n_lines", "n_removed")
    spark = docs.sparkSession
    with shuffles_freed(spark), owned(Stored()) as passing:
        found = repeated(store(cut(docs, passage), "line-chunks"))
    spans = found.groupBy("_id", "_row").agg(F.collect_set(F.struct("first", "last", "hash", "stays")).alias("_spans"))
    with shuffles_freed(spark):
        spans = store(spans, "line-places")
    passing.release(spark)
    keyed = docs.withColumn("_own", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_row"))
    # the spans grow with the corpus: as a small file they are no reason to broadcast them
    joined = keyed.join(spans.hint("merge"), same, "left").select(*docs.columns, "_own", "_spans")
    with shuffles_freed(spark):
        joined = store(joined, "line-spans")

    texts = span_texts(joined)
    mixed = texts.groupBy("span.hash").agg((F.min("bytes") != F.max("bytes")).alias("mixed")).where("mixed").select("hash")
    with shuffles_freed(spark):
        mixed = store(mixed, "line-mixed")
    ready = joined.withColumn("_go", F.filter("_spans", lambda s: ~s["stays"]))
    if not mixed.isEmpty():
        # the hash alone doesn't tell these apart: decide again by hash and bytes
        unsure = texts.join(mixed, texts["span.hash"] == mixed["hash"], "left_semi")
        place = F.struct("doc_id", "_own", F.col("span.first").alias("first"))
        often = unsure.groupBy(F.col("span.hash").alias("h"), F.col("bytes").alias("b")).agg(F.min(place).alias("kept"))
        again = unsure.join(often, (F.col("span.hash") == F.col("h")) & (F.col("bytes") == F.col("b")))
        stays = again.groupBy(F.col("doc_id").alias("_id"), F.col("_own").alias("_row")).agg(
            F.collect_set("span.hash").alias("_unsure"),
            F.collect_set(F.when(~place.eqNullSafe(F.col("kept")), F.col("span"))).alias("_gone"),
        )
        ready = ready.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_row")), "left").withColumn(
            "_go",
            F.when(F.col("_unsure").isNull(), F.col("_go")).otherwise(
                F.concat(F.filter("_go", lambda s: ~F.array_contains("_unsure", s["hash"])), F.col("_gone"))
            ),
        )
    gone = F.array_distinct(F.flatten(F.transform("_go", lambda s: F.sequence(s["first"], s["last"]))))
    split = ready.withColumn("_lines", F.split("text", "\n")).withColumn("_gone_at", F.coalesce(gone, F.array().cast("array<int>")))
    at = split.withColumn("_at", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone_at")))
    text = F.when(F.size("_gone_at") == 0, F.col("text")).otherwise(F.array_join(F.transform("_at", lambda i: F.get("_lines", i)), "\n"))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines"))
    return at.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns),
        n.alias("n_lines"),
        F.size("_gone_at").alias("n_removed"),
    )
