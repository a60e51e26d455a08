"""Language identification: known words first, then ever shorter character n-grams.

The model holds, per language, log relative frequencies of words and of
character n-grams of words with their ends marked. A text's score is the sum
over its words: a known word counts with its own frequencies, an unknown one
with the mean of its longest known n-grams, less a fixed cost for each length
passed over (the same for all languages, so it only lowers the certainty).
Long runs of letters, as in scripts without blanks, are read whole, in
consecutive pieces that count like unknown words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgauge.llm.common import chosen, fraction_for, hashed_below, schema_with, slices, store

LETTERS = re.compile(r"[^\W\d_]+")
#: Training texts per language, chosen by the hash of their id.
TEXTS = 5_000
#: Words, and n-grams of each length, that the model keeps per language, the most frequent ones.
WORDS, GRAMS = 20_000, 5_000
#: Parts in which the n-grams of a language are ranked first.
PARTS = 64
LONGEST = 5
#: Places in a word, with its ends marked, at which the n-grams of one piece begin.
PIECE = 42
#: Rows of scores that a worker keeps between batches.
CACHE = 400_000


@dataclass
class Model:
    """Scores: one column per language. Word keys come before n-gram keys of length 1 to LONGEST."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]


def words_in(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def pieces(word: str) -> list[str]:
    """The word with its ends marked, cut where it is long; a piece reaches into the next one, so that no n-gram is lost."""
    marked = f"<{word}>"
    return [marked[i : i + PIECE + LONGEST - 1] for i in range(0, len(marked), PIECE)]


def grams_in(piece: str, n: int) -> list[str]:
    """The n-grams that begin in the piece itself."""
    return [piece[i : i + n] for i in range(min(PIECE, len(piece) - n + 1))]


def counts(rows: DataFrame) -> DataFrame:
    """``lang, n, gram, count`` over all rows given: n is 0 for words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 512, 4_000_000):
            seen: dict[str, Counter] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(words_in(text))
            for lang, words in seen.items():
                grams: Counter = Counter()
                for word, many in words.items():
                    for piece in pieces(word):
                        for n in range(1, LONGEST + 1):
                            for g in grams_in(piece, n):
                                grams[n, g] += many
                keys = [(0, w) for w in words] + list(grams)
                many = list(words.values()) + list(grams.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys]), pa.array(many, pa.int64())],
                    ["lang", "n", "gram", "count"],
                )

    parts = rows.select("lang", "text").mapInArrow(run, "lang string, n int, gram string, count long")
    return parts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


def fit(docs: DataFrame, texts: int = TEXTS) -> Model:
    """Learn from ``lang`` and ``text``; rows where either is null teach nothing.

    About ``texts`` documents per language are read, chosen by the hash of
    their id; the tables that reach the driver have at most ``WORDS`` words and
    ``LONGEST * GRAMS`` n-grams per language, with their counts in all
    languages. Without rows the model knows no
    language and every prediction is ``und``.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {}, [{} for _ in range(LONGEST)])
    wanted = F.lit(False)
    for lang, size in sizes.items():
        wanted = wanted | ((F.col("lang") == lang) & hashed_below("doc_id", fraction_for(texts, size)))
    found = store(counts(usable.where(wanted)), "language-counts")
    best = [F.desc("count"), "gram"]
    most = F.when(F.col("n") == 0, WORDS).otherwise(GRAMS)
    # the most frequent of each part first, so that no task ranks all n-grams of a language
    parted = found.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS)))
    some = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "n", "part").orderBy(*best))).where(F.col("rank") <= most)
    kept = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "n").orderBy(*best))).where(F.col("rank") <= most)
    # what is kept for one language is counted in all
    total = found.groupBy("lang", "n").agg(F.sum("count").alias("total"))
    counted = found.join(kept.select("n", "gram").distinct(), ["n", "gram"]).join(F.broadcast(total), ["lang", "n"])
    rows = counted.select("lang", "n", "gram", "count", "total").toPandas()
    languages = sorted(sizes)
    column = {lang: i for i, lang in enumerate(languages)}
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]
    for n, own in rows.groupby("n"):
        many = np.zeros((own["gram"].nunique(), len(languages)))
        at, names = own["gram"].factorize(sort=True)
        many[at, own["lang"].map(column).to_numpy()] = own["count"]
        whole = np.ones(len(languages))
        for lang, value in own.groupby("lang")["total"].first().items():
            whole[column[lang]] = value
        logs = np.log((many + 0.5) / (whole + 0.5 * len(names))).astype(np.float32)
        tables[int(n)] = dict(zip(names.tolist(), logs, strict=True))
    return Model(languages, tables[0], tables[1:])


def score_word(model: Model, word: str) -> np.ndarray:
    """Scores of a word by language, from the word itself or its longest known n-grams."""
    if (known := model.words.get(word)) is not None:
        return known
    return np.sum([score_piece(model, piece) for piece in pieces(word)], axis=0)


def score_piece(model: Model, piece: str) -> np.ndarray:
    for n in range(LONGEST, 0, -1):
        found = [x for g in grams_in(piece, n) if (x := model.grams[n - 1].get(g)) is not None]
        if found:
            return np.mean(found, axis=0) - (LONGEST - n)
    return np.zeros(len(model.languages), np.float32)


def units(model: Model, word: str) -> list[str | tuple[str]]:
    """The word, or its pieces (each in a tuple) if it is unknown and long, so that what is kept of it is short."""
    return [word] if len(word) + 2 <= PIECE or word in model.words else [(piece,) for piece in pieces(word)]


class Scorer:
    """Adds up the words of many texts; scores of words are worked out once and kept."""

    def __init__(self, model: Model):
        self.model = model
        self.row: dict[str | tuple[str], int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.row) > CACHE:
            self.row, self.scores = {}, self.scores[:0]
        words = [words_in(t) if t else [] for t in texts]
        new = {w for ws in words for w in ws if w not in self.row}
        cut = {w: own for w in new if len(w) + 2 > PIECE and (own := units(self.model, w)) != [w]}
        if cut:
            words = [[u for w in ws for u in cut.get(w, (w,))] for ws in words]
            new = {w for ws in words for w in ws if w not in self.row}
        new = list(new)
        if new and self.model.languages:
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
            made = [score_piece(self.model, *w) if isinstance(w, tuple) else score_word(self.model, w) for w in new]
            self.scores = np.concatenate([self.scores, np.stack(made)])
        out = []
        for ws in words:
            if not self.model.languages or not any(c.isalpha() for w in ws for x in w for c in x):
                out.append(("und", 0.0))
                continue
            total = self.scores[list(map(self.row.__getitem__, ws))].sum(axis=0, dtype=np.float64) / np.sqrt(len(ws))
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns named in ``keep``, ``lang_pred`` and ``score`` for each row.

    Null texts and texts without a letter get ``und`` and 0. Ties go to the
    language that sorts first. Texts are read whole; each row stands alone, so
    repeated rows get the same answer.
    """
    rows, keep = chosen(docs, keep, ("lang_pred", "score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = schema_with(docs.select(*keep), "lang_pred string, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(shared.value)
        for part in slices(batches, 1024, 8_000_000):
            said = score(part.column("text").to_pylist())
            more = [pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *more], [*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
