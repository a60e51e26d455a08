"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters and digits that stand
for letters. The lexicon is learned from labelled documents: whole words and
beginnings of words that stand out in toxic ones, weighted by their log odds.
Phrases around an entry that occur in clean documents only are exceptions and
take the entry's weight away. The weight found is normalised by the length of
the text and turned into a probability.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import chosen, labelled_sample, schema_with, slices

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOK_ALIKE = dict(zip("авсԁеһіјкӏмпорԛѕтиѵѡхузαβεηικνορτυχωϲıɑɡʟո", "abcdehijklmnopqstuvwxy3abenikvoptuxwciagln", strict=True))
DIGITS = dict(zip("0134578@$!", "oieastbasi", strict=True))
#: Signs count as letters only in front of a letter, so that "word$$$" keeps its end. Whole runs
#: are taken, from their beginning, as if each one were folded as soon as its neighbour is a letter.
SPELLED = re.compile(r"(?<![0134578@$!])[0134578@$!]++(?=[^\W\d_])|(?<=[^\W\d_])[0134578]++")
SPELT = str.maketrans(DIGITS)
RARE = str.maketrans(LOOK_ALIKE)
ODD = frozenset(LOOK_ALIKE)
INVISIBLE = re.compile("[­​-‏⁠-⁤﻿]")
TOKEN = re.compile(r"[^\W\d_]+")

#: Labelled texts of each kind that the lexicon is learned from, chosen by the hash of their id.
TEXTS = 20_000
#: Lengths of beginnings of words.
STEMS = range(4, 9)


def fold(text: str) -> str:
    """Lower case, with look-alikes and digits inside words made letters. Accents stay."""
    text = text.lower()
    if not text.isascii():
        # before and after, since the normal form of some look-alikes is none, and that of other signs is one
        if not ODD.isdisjoint(text):
            text = text.translate(RARE)
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower()
        if not ODD.isdisjoint(text):
            text = text.translate(RARE)
    if any(c in text for c in DIGITS):
        text = SPELLED.sub(lambda m: m[0].translate(SPELT), text)
    return text


@dataclass
class Lexicon:
    """``entries``: weight of each word ("word ") or beginning of words ("word"). ``slope``: of the two features, and the constant."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: tuple[float, float, float] = (0.0, 0.0, -2.0)


class Matcher:
    """Finds the entries of a lexicon in folded texts."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.entries.items():
            word = entry.rstrip(" ")
            old = self.automaton.get(word, (0, 0.0, 0.0, False))
            begin, whole = (old[1], weight) if entry.endswith(" ") else (weight, old[2])
            self.automaton.add_word(word, (len(word), begin, whole, old[3]))
        for phrase in lexicon.exceptions:
            old = self.automaton.get(phrase, (0, 0.0, 0.0, False))
            self.automaton.add_word(phrase, (len(phrase), old[1], old[2], True))
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def spans(self, text: str) -> dict[int, float]:
        """Weight by the place where a matching word begins: the heaviest entry, unless an exception covers it."""
        if not self.any:
            return {}
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (size, begin, whole, exception) in self.automaton.iter(text):
            at = end - size + 1
            if at and text[at - 1].isalpha():
                continue
            ends = end + 1 == len(text) or not text[end + 1].isalpha()
            if exception and ends:
                excepted.append((at, end))
            weight = max(begin, whole) if ends else begin
            if weight > found.get(at, 0.0):
                found[at] = weight
        return uncovered(found, excepted)

    def measure(self, text: str) -> tuple[float, float, int]:
        """The weight found, by the square root of the number of words, and in all; and the number of matches."""
        folded = fold(text)
        found = self.spans(folded)
        weight = sum(found.values())
        return (np.log1p(weight / np.sqrt(1 + folded.count(" "))), np.log1p(weight), len(found)) if weight else (0.0, 0.0, len(found))

    def features(self, text: str) -> tuple[float, float]:
        return self.measure(text)[:2]

    def score(self, text: str) -> float:
        return self.judge(text)[0]

    def judge(self, text: str) -> tuple[float, int]:
        """The score, and the number of matches."""
        a, b, c = self.lexicon.slope
        x, y, hits = self.measure(text)
        return float(1 / (1 + np.exp(-(a * x + b * y + c)))), hits


def uncovered(found: dict[int, float], excepted: list[tuple[int, int]]) -> dict[int, float]:
    """The matches that begin in no exception. Both are gone through once, in their order."""
    if not excepted:
        return found
    out: dict[int, float] = {}
    spans = iter(sorted(excepted))
    span, reach = next(spans, None), -1
    for at in sorted(found):
        while span is not None and span[0] <= at:
            reach = max(reach, span[1])
            span = next(spans, None)
        if at > reach:
            out[at] = found[at]
    return out


def terms(text: str) -> set[str]:
    """Words, with a blank behind, and beginnings of words."""
    words = set(TOKEN.findall(fold(text)))
    return {w + " " for w in words if len(w) > 2} | {w[:n] for w in words for n in STEMS if len(w) > n}


def phrases(text: str, matcher: Matcher) -> set[str]:
    """The two words that an entry makes with the word before and with the one behind, as they stand."""
    folded = fold(text)
    found = matcher.spans(folded)
    if not found:
        return set()
    words = [m.span() for m in TOKEN.finditer(folded)]
    out = set()
    for k, (at, _) in enumerate(words):
        if at in found:
            for j in (k - 1, k):
                if 0 <= j < len(words) - 1:
                    out.add(folded[words[j][0] : words[j + 1][1]])
    return out


def tally(rows: DataFrame, of) -> DataFrame:
    """``term, toxic, clean``: documents of either kind that have each term; ``of`` makes the function from text to terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = of()
        for part in slices(batches, 256, 2_000_000):
            seen = (Counter(), Counter())
            for toxic, text in zip(part.column("toxic").to_pylist(), part.column("text").to_pylist(), strict=True):
                seen[toxic].update(find(text))
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][x] for x in names], pa.int64()), pa.array([seen[0][x] for x in names], pa.int64())],
                ["term", "toxic", "clean"],
            )

    found = rows.select("toxic", "text").mapInArrow(run, "term string, toxic long, clean long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights and constant of a logistic regression by Newton's method, held back a little."""
    data = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(data.shape[1])
    keep = np.diag([0.05] * x.shape[1] + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(data @ w, -30, 30)))
        step = np.linalg.solve((data * (p * (1 - p))[:, None]).T @ data + keep, data.T @ (p - y) + keep @ w)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def fit(docs: DataFrame, labels: DataFrame, texts: int = TEXTS, least: int = 5, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Learn from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``, 0 or 1; others teach nothing).

    About ``texts`` documents of each kind are read. An entry must be in ``least``
    toxic texts, and its log odds must be four of their standard errors above
    nought. With ``exceptions`` come phrases that are always excepted. Without
    labels of both kinds the lexicon is empty and every text scores alike.
    """
    rows, sizes, share = labelled_sample(docs, labels, "toxic", texts)
    rows = rows.withColumnRenamed("label", "toxic")
    if not sizes.get(1) or not sizes.get(0):
        return Lexicon(exceptions=list(exceptions))
    toxic, clean = sizes[1] * share[1], sizes[0] * share[0]
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (toxic - F.col("toxic") + 1)) - F.log(b / (clean - F.col("clean") + 1))
    error = F.sqrt(1 / a + 1 / b)
    top = (
        tally(rows, lambda: terms)
        .where(F.col("toxic") >= least)
        .select("term", odds.alias("odds"), (odds / error).alias("z"))
        .where("z >= 4 and odds >= 3")
        .orderBy("term")
        .collect()
    )
    lexicon = Lexicon({r["term"]: r["odds"] for r in top}, list(exceptions))
    if not lexicon.entries:
        return lexicon
    spark = docs.sparkSession

    def finder():
        matcher = Matcher(shared.value)
        return lambda text: phrases(text, matcher)

    shared = spark.sparkContext.broadcast(lexicon)
    excepted = tally(rows, finder).where("clean >= 5 and toxic = 0").orderBy("term").collect()
    lexicon = Lexicon(lexicon.entries, [*exceptions, *(r["term"] for r in excepted)])
    seen = spark.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(seen.value)
        for part in slices(batches, 1024, 8_000_000):
            x = [matcher.features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()), part.column("toxic")], ["x", "y", "toxic"]
            )

    points = rows.mapInArrow(run, "x double, y double, toxic int").groupBy("x", "y", "toxic").count().toPandas()
    every = points.loc[points.index.repeat(points["count"])]
    return Lexicon(lexicon.entries, lexicon.exceptions, logistic(every[["x", "y"]].to_numpy(), every["toxic"].to_numpy()))


def score(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """The columns named in ``keep``, ``score``, ``predicted`` and ``n_matches`` for each row.

    Whole texts are read. Null and empty texts have no match and get the score
    of a text without matches. Rows stand alone; ties at 0.5 count as toxic.
    """
    rows, keep = chosen(docs, keep, ("score", "predicted", "n_matches"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = schema_with(docs.select(*keep), "score double, predicted int, n_matches long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for part in slices(batches, 1024, 8_000_000):
            texts = [t or "" for t in part.column("text").to_pylist()]
            judged = [matcher.judge(t) for t in texts]
            scores = [s for s, _ in judged]
            more = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([n for _, n in judged], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *more], [*keep, "score", "predicted", "n_matches"])

    return rows.mapInArrow(run, schema)
