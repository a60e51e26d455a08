"""Ranked lexical search: dense tiles of item weights times dense tiles of document impacts.

Items are the queries, documents are ranked for each of them. Everything is a whole
number, and the products are taken in float64: vocabulary tiles are cut so that no
sum inside a tile can reach 2^53, so each product is exact, and tiles are added up
as 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgauge.llm.common import slices, store

#: Fixed values of the score: scale of weights and impacts, length normalisation in hundredths.
SCALE, LENGTH, FLAT = 1000, 75, 25
#: Pairs of item and term in a block of items; a block is what is broadcast at once.
ENTRIES = 200_000
#: Terms in a vocabulary tile, documents in a document tile.
TERMS, DOCS = 1024, 1024
#: Whole numbers below this are exact in float64.
EXACT = 1 << 53
#: Parts in which the best of an item are gathered first.
PARTS = 64

#: What each byte of UTF-8 becomes: A-Z as a-z, digits, letters and all beyond ASCII as they are, the rest a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def item_entries(items: DataFrame) -> DataFrame:
    """``item, item_id, term, times``: the distinct terms of each row of ``items``, a number for the row, and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024, 4_000_000):
            rows = []
            for item, item_id, text in zip(*(part.column(c).to_pylist() for c in ("item", "item_id", "text")), strict=True):
                words = {}
                for term in terms_of(text):
                    words[term] = words.get(term, 0) + 1
                rows.extend((item, item_id, term, times) for term, times in words.items())
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), part.schema.field("item_id").type, pa.binary(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "term", "times"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return rows.mapInArrow(run, f"item long, item_id {kind}, term binary, times long")


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, times`` of each document with a term: its length, and which of the vocabulary it holds how often."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: k for k, term in enumerate(shared.value)}
        ints = pa.list_(pa.int32())
        for part in slices(batches, 1024, 8_000_000):
            ids, n, found, times = [], [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = terms_of(text)
                if words:
                    known = np.array([k for k in map(place.get, words) if k is not None], np.int32)
                    own, count = np.unique(known, return_counts=True)
                    ids.append(doc_id)
                    n.append(len(words))
                    found.append(own)
                    times.append(count.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(found, ints), pa.array(times, ints)],
                ["doc_id", "n", "terms", "times"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def tiles(weights: list[tuple[int, int, int]], largest: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Vocabulary tiles ``terms, items, place of the term in the tile, weight`` of entries (item, term, weight).

    A tile has at most ``TERMS`` terms, and for no item do its weights, times the
    largest impact, add up to 2^53. An entry that alone is too heavy is dealt
    over several tiles.
    """
    most = (EXACT - 1) // largest
    entries = sorted((term, item, weight) for item, term, weight in weights if weight)
    out, open_ = [], []
    load: dict[int, int] = {}
    inside: dict[int, int] = {}

    def close() -> None:
        if open_:
            item, at, weight = (np.array(c, np.int64) for c in zip(*open_, strict=True))
            out.append((np.array(list(inside), np.int64), item, at, weight.astype(np.float64)))
        open_.clear(), load.clear(), inside.clear()

    for term, item, weight in entries:
        while weight:
            piece = min(weight, most)
            if load.get(item, 0) + piece > most or (term not in inside and len(inside) == TERMS):
                close()
            load[item] = load.get(item, 0) + piece
            open_.append((item, inside.setdefault(term, len(inside)), piece))
            weight -= piece
    close()
    return out


class Best:
    """The best documents of each item so far; ties go to the smaller id, null ids come last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = np.zeros((items, k), np.int64)
        self.ids = np.full((items, k), np.iinfo(np.int64).max)
        self.nulls = np.ones((items, k), bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """Scores of all items (rows) for some documents (columns). What can't beat or tie with an item's last place is passed over."""
        item, doc = np.nonzero((scores > 0) & (scores >= self.scores[:, -1:]))
        if not len(item):
            return
        touched, row = np.unique(item, return_inverse=True)
        old = np.repeat(np.arange(len(touched)), self.k)
        every = np.concatenate([row, old])
        score = np.concatenate([scores[item, doc], self.scores[touched].ravel()])
        id_ = np.concatenate([ids[doc], self.ids[touched].ravel()])
        null = np.concatenate([nulls[doc], self.nulls[touched].ravel()])
        order = np.lexsort((id_, null, -score, every))
        every = every[order]
        begins = np.searchsorted(every, np.arange(len(touched)))
        first = order[(begins[:, None] + np.arange(self.k)[None, :]).ravel()]
        self.scores[touched] = score[first].reshape(-1, self.k)
        self.ids[touched] = id_[first].reshape(-1, self.k)
        self.nulls[touched] = null[first].reshape(-1, self.k)


def best_of_block(counts: DataFrame, entries: list[tuple[int, int, int]], items: int, docs: int, total: int, k: int) -> DataFrame:
    """``item, doc_id, score``: from each task the ``k`` best documents of each item of a block, by products of tiles.

    ``entries``: item, term and weight. ``docs`` and ``total``: how many
    documents have a term, and how many terms they have.
    """
    # an impact falls with the length factor, whose least is FLAT, and grows with the occurrences
    largest = 1_000_000_000 // SCALE
    shared = counts.sparkSession.sparkContext.broadcast(tiles(entries, largest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(items, k)
        for part in slices(batches, DOCS, 64_000_000):
            n = part.column("n").to_numpy()
            ids = part.column("doc_id")
            nulls = np.array(ids.is_null())
            ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            lists = part.column("terms")
            size = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(len(n)), size)
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = part.column("times").flatten().to_numpy().astype(np.int64)
            length = FLAT + (LENGTH * n * docs) // total
            impact = ((1_000_000_000 * tf) // (SCALE * tf + 8 * length[doc])).astype(np.float64)
            order = np.argsort(term, kind="stable")
            term, doc, impact = term[order], doc[order], impact[order]
            scores = np.zeros((items, len(n)), np.int64)
            for own, item, at, weight in shared.value:
                low, high = np.searchsorted(term, own[0]), np.searchsorted(term, own[-1], "right")
                where = np.searchsorted(own, term[low:high])
                where = np.where(own[np.minimum(where, len(own) - 1)] == term[low:high], where, -1)
                right = np.zeros((len(own), len(n)))
                right[where[where >= 0], doc[low:high][where >= 0]] = impact[low:high][where >= 0]
                rows, left_at = np.unique(item, return_inverse=True)
                left = np.zeros((len(rows), len(own)))
                left[left_at, at] = weight
                scores[rows] += (left @ right).astype(np.int64)
            best.add(scores, ids, nulls)
        item, place = np.nonzero(best.scores > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(best.ids[item, place], mask=best.nulls[item, place]), pa.array(best.scores[item, place])],
            ["item", "doc_id", "score"],
        )

    return counts.mapInArrow(run, "item long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest score above 0 for each row of ``items``.

    Items are taken in blocks of about ``ENTRIES`` pairs of item and term, one
    after the other, each against all documents; a block's vocabulary and
    weights are what is broadcast. Frequencies and lengths come from all
    documents and don't depend on the blocks. Each task holds a tile of
    documents and the best of each item, and gives ``k`` rows an item, which
    are ranked in two steps.

    Null and empty texts have no terms: such documents aren't counted and such
    items have no rows. Rows that repeat a document are documents of their own,
    rows that repeat an item id have a list each. Of equal scores the smaller
    id comes first, a null id last. Empty tables give an empty one; columns
    other than ``doc_id``, ``item_id`` and ``text`` aren't read.
    """
    spark = docs.sparkSession
    entries = store(item_entries(items), "search-items")
    size = entries.count()
    blocks = ceil(size / ENTRIES)
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1))))
    found = None
    docs_n = total = None
    for block in range(blocks):
        own = [(r["item"], bytes(r["term"]), r["times"]) for r in dealt.where(F.col("block") == block).select("item", "term", "times").collect()]
        if not own:
            continue
        vocabulary = sorted({term for _, term, _ in own})
        numbers = {item: n for n, item in enumerate(sorted({item for item, _, _ in own}))}
        counts = store(counted(docs, vocabulary), "search-counts")
        if docs_n is None:
            docs_n, total = counts.agg(F.count("*"), F.sum("n")).first()
            if not docs_n:
                break
        holding = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
        weight = F.floor(SCALE * F.log((F.lit(2.0) * docs_n + 2) / (2 * F.col("count") + 1))).cast("long")
        weights = {vocabulary[r["term"]]: (r["term"], r["weight"]) for r in holding.select("term", weight.alias("weight")).collect()}
        held = [(numbers[item], weights[term][0], weights[term][1] * times) for item, term, times in own if term in weights]
        best = best_of_block(counts, held, len(numbers), docs_n, total, k)
        rows = spark.createDataFrame([(n, item) for item, n in numbers.items()], "number long, item long")
        best = best.join(F.broadcast(rows), best["item"] == rows["number"]).select(rows["item"], "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    kind = items.schema["item_id"].dataType.simpleString()
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", "part").orderBy(*order)
    best = found.withColumn("part", F.spark_partition_id() % PARTS).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    named = entries.select("item", "item_id").distinct()
    return best.join(named, "item").select("item_id", "rank", "doc_id", "score")
