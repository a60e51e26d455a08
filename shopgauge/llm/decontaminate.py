"""Benchmark decontamination: which documents hold items of a test set.

The items make an inverted index with BM25 weights, each divided by its item's
sum, so that a passage with all words of an item scores 1. Every stretch of
every document is a query. Block-max WAND retrieves all items above the
threshold: bounds by term, then by block of items, pass over what can't reach
it, and only the rest is scored. What is retrieved counts if question and
answer both overlap with the stretch.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import schema_with, slices, store

TOKEN = re.compile(r"[^\W_]+")
MARK = re.compile(r"(?i)\b(?:answer|a)\s*:")
K1, B = 1.2, 0.75
#: Share of an item's weight that a stretch must have, and shares of three-word runs of question and answer.
THRESHOLD, QUESTION, ANSWER = 0.6, 0.6, 0.5
#: Words in a run that is compared, items in a block, and words in half a stretch (more if an item is longer).
RUN, BLOCK, HALF = 3, 4, 64
#: Bytes of items in one index, which a worker holds; more items make more indexes, searched one after the other.
INDEX_BYTES = 16_000_000


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def runs(words: list[str], n: int = RUN) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def parts(text: str) -> tuple[list[str], list[str]]:
    """Words of question and answer: cut at a mark such as "Answer:", else the last quarter is the answer."""
    if (m := None if text is None else [*MARK.finditer(text)]) and tokens(text[m[-1].end() :]) and tokens(text[: m[-1].start()]):
        return tokens(text[: m[-1].start()]), tokens(text[m[-1].end() :])
    words = tokens(text or "")
    at = len(words) - max(min(RUN, len(words) // 2), len(words) // 4)
    return words[:at], words[at:]


@dataclass
class Item:
    item_id: int | None
    question: list[str]
    answer: list[str]

    def overlap(self, words: list[str]) -> tuple[float, float]:
        """Shares of the runs of question and answer that are in a stretch of words."""
        found = {len(words[0:0]): set()}
        out = []
        for side in (self.question, self.answer):
            own = runs(side)
            n = min(RUN, len(side))
            if n not in found:
                found[n] = runs(words, n) if len(words) >= n else set()
            out.append(len(own & found[n]) / len(own) if own else 1.0)
        return out[0], out[1]


class Index:
    """Postings by term, with the largest weight of each term in all items and in each block.

    ``often``, ``count`` and ``mean``: in how many items of the whole test set each
    term is, how many items there are, and their mean length. If not given,
    they are those of ``items``.
    """

    def __init__(self, items: list[tuple[int | None, str]], often: dict[str, int] | None = None, count: int = 0, mean: float = 0.0):
        self.items = [Item(i, *parts(text)) for i, text in items]
        words = [x.question + x.answer for x in self.items]
        self.items = [x for x, w in zip(self.items, words, strict=True) if w]
        words = [w for w in words if w]
        self.longest = max(map(len, words), default=0)
        if often is None:
            count, mean = len(words), sum(map(len, words)) / max(1, len(words))
            often = Counter(t for w in words for t in set(w))
        self.term = {t: k for k, t in enumerate(sorted({t for w in words for t in w}))}
        self.postings: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for d, w in enumerate(words):
            own = {}
            for t, n in Counter(w).items():
                idf = log(1 + (count - often[t] + 0.5) / (often[t] + 0.5))
                own[t] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / mean))
            whole = sum(own.values())
            for t, x in own.items():
                self.postings[self.term[t]].append((d, x / whole))
        # largest weights by block, as pairs of arrays for each term
        self.block_max: list[dict[int, float]] = [{} for _ in self.term]
        for k, own in enumerate(self.postings):
            for d, x in own:
                self.block_max[k][d // BLOCK] = max(self.block_max[k].get(d // BLOCK, 0.0), x)
        self.blocks = [np.fromiter(x, np.int64, len(x)) for x in self.block_max]
        self.tops = [np.fromiter(x.values(), np.float64, len(x)) for x in self.block_max]
        self.most = np.array([x.max() for x in self.tops])
        self.half = max(HALF, self.longest)

    def search(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose score by the query's terms reaches the threshold, by item.

        Bounds by block tell which blocks can hold one. Within these, lists are
        read document at a time: the pivot is the first item that the terms up to
        it could lift over the threshold, and lists before it skip there.
        """
        if not query:
            return []
        limit = threshold - 1e-9
        bounds = np.bincount(np.concatenate([self.blocks[k] for k in query]), weights=np.concatenate([self.tops[k] for k in query]))
        found = []
        for block in np.flatnonzero(bounds >= limit).tolist():
            end = (block + 1) * BLOCK
            lists = [[k, bisect_left(self.postings[k], (block * BLOCK, -1.0))] for k in query if block in self.block_max[k]]
            while True:
                here = sorted((self.postings[k][at][0], k, x) for x in lists for k, at in [x] if at < len(self.postings[k]) and self.postings[k][at][0] < end)
                bound, pivot = 0.0, None
                for d, k, _ in here:
                    bound += self.block_max[k][block]
                    if bound >= limit:
                        pivot = d
                        break
                if pivot is None:
                    break
                if here[0][0] == pivot:
                    score = sum(self.postings[k][x[1]][1] for d, k, x in here if d == pivot)
                    if score >= limit:
                        found.append((pivot, score))
                    self._skip(lists, pivot + 1)
                else:
                    self._skip(lists, pivot)
        return found

    def _skip(self, lists: list[list[int]], to: int) -> None:
        for x in lists:
            if x[1] < len(self.postings[x[0]]) and self.postings[x[0]][x[1]][0] < to:
                x[1] = bisect_left(self.postings[x[0]], (to, -1.0), lo=x[1])

    def leaks(self, texts: list[str], threshold: float = THRESHOLD) -> list[list[tuple[int, float, float, float, int]]]:
        """For each text: item, score, overlap of question and answer, and first word of the best stretch that holds it."""
        words = [tokens(t) for t in texts]
        out: list[list[tuple[int, float, float, float, int]]] = [[] for _ in texts]
        get = self.term.get
        ids = [np.fromiter((get(w, -1) for w in ws), np.int64, len(ws)) for ws in words]
        # halves of stretches, numbered through all texts; a text's last half has no successor
        sizes = [ceil(len(x) / self.half) + 1 if len(x) else 0 for x in ids]
        begin = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        if not begin[-1] or not self.term:
            return out
        half = np.concatenate([begin[k] + np.arange(len(x)) // self.half for k, x in enumerate(ids)])
        flat = np.concatenate(ids)
        pair = np.unique(half[flat >= 0] * len(self.term) + flat[flat >= 0])
        cell, term = pair // len(self.term), pair % len(self.term)
        bound = np.bincount(cell, weights=self.most[term], minlength=begin[-1] + 1)
        open_ = np.flatnonzero(bound[:-1] + bound[1:] >= threshold - 1e-9)
        first = np.searchsorted(cell, np.arange(begin[-1] + 2))
        text_of = np.searchsorted(begin, open_, side="right") - 1
        for h, k in zip(open_.tolist(), text_of.tolist(), strict=True):
            if h + 1 >= begin[k + 1]:
                continue  # the next half belongs to another text
            query = np.union1d(term[first[h] : first[h + 1]], term[first[h + 1] : first[h + 2]])
            found = self.search(query.tolist(), threshold)
            if found:
                at = (h - int(begin[k])) * self.half
                stretch = words[k][at : at + 2 * self.half]
                for d, score in found:
                    q, a = self.items[d].overlap(stretch)
                    if q >= QUESTION and a >= ANSWER:
                        out[k].append((d, score, q, a, at))
        for k, own in enumerate(out):
            best: dict[int, tuple] = {}
            for x in own:
                if x[0] not in best or x[1:4] > best[x[0]][1:4]:
                    best[x[0]] = x
            out[k] = sorted(best.values())
        return out


def words_of_items(items: DataFrame) -> DataFrame:
    """``item_id, text, n, terms`` of the items with a word: how many words they have, and which."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024, 8_000_000):
            words = [q + a for q, a in map(parts, part.column("text").to_pylist())]
            held = [k for k, w in enumerate(words) if w]
            rows = part.take(pa.array(held, pa.int64()))
            more = [pa.array([len(words[k]) for k in held], pa.int64()), pa.array([sorted(set(words[k])) for k in held], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([rows.column("item_id"), rows.column("text"), *more], ["item_id", "text", "n", "terms"])

    own = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    return own.mapInArrow(run, "item_id long, text string, n long, terms array<string>")


def indexes(items: DataFrame, size: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes over all items (``item_id``, ``text``), each of about ``size`` bytes of text, one after the other.

    Null texts and texts without a word can't be found and are left out. Items
    are dealt out by hash; frequencies and the mean length are those of all
    items, so scores don't depend on the dealing.
    """
    own = store(words_of_items(items), "benchmark-items")
    whole, number, words = own.agg(F.sum(F.octet_length("text")), F.count("*"), F.sum("n")).first()
    if not number:
        return
    terms = F.explode("terms").alias("term")
    often = store(own.select(terms).groupBy("term").count(), "benchmark-terms")
    count = max(1, ceil(whole / size))
    dealt = own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for k in range(count):
        block = dealt.where(F.col("block") == k)
        rows = block.select("item_id", "text").collect()
        if rows:
            held = often if count == 1 else often.join(block.select(terms).distinct(), "term", "left_semi")
            ordered = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            yield Index(ordered, {r["term"]: r["count"] for r in held.collect()}, number, words / number)


LEAK = "array<struct<item_id:bigint,score:double,question:double,answer:double,word:bigint>>"


def flag(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with ``leaks``: the items that each text holds, with score, overlaps and first word of the stretch.

    Stretches overlap by half and are twice as long as the longest item, so
    every item lies whole in one. Null and empty texts hold none. Every row
    stands alone; equal texts get equal answers. Items with equal texts are all
    reported. Other columns stay; one named ``leaks`` is replaced. Without items
    every list is empty.
    """
    docs = docs.drop("leaks")
    out = docs
    names = docs.columns
    for k, index in enumerate(indexes(items)):
        if k:  # one index at a time in a worker
            out = store(out, "benchmark-leaks")
        shared = docs.sparkSession.sparkContext.broadcast(index)
        schema = schema_with(docs, f"leaks {LEAK}")

        def run(batches: Iterator[pa.RecordBatch], shared=shared, kind=schema) -> Iterator[pa.RecordBatch]:
            known: Index = shared.value
            for part in slices(batches, 512, 8_000_000):
                found = known.leaks([t or "" for t in part.column("text").to_pylist()])
                old = part.column("leaks").to_pylist() if "leaks" in part.schema.names else [[] for _ in found]
                more = [
                    o + [{"item_id": known.items[d].item_id, "score": s, "question": q, "answer": a, "word": at} for d, s, q, a, at in x]
                    for o, x in zip(old, found, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(more, LEAKS)], [*names, "leaks"])

        out = out.mapInArrow(run, schema)
    return out if "leaks" in out.columns else out.withColumn("leaks", F.array().cast(LEAK))


LEAKS = pa.list_(
    pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()), ("word", pa.int64())])
)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    return flag(docs, items).where(F.size("leaks") == 0).drop("leaks")
