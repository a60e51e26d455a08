"""Document quality by labelling lines: a linear-chain conditional random field.

Every line with a word is content or boilerplate. The field scores each line by
its features and each step from line to line, and Viterbi decoding picks the
best sequence for a document; the share of words in content lines decides
whether it stays. It is trained here on labelled documents, whose label counts
for all their lines.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopgauge.llm.common import chosen, labelled_sample, schema_with, slices

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
LEAST_WORDS = 50
#: Content share from which a document stays.
SHARE = 0.5
#: Labelled documents of each kind for training, chosen by the hash of their id,
#: and lines in a stretch. Each text is cut into stretches from its beginning to its end.
TEXTS, LINES = 3_000, 64
#: Stretches that are worked on at once in training.
TOGETHER = 8_192

FEATURES = [
    *(f"words {x}" for x in ("1-3", "4-9", "10-29", "30-")),
    *(f"symbols {x}" for x in ("0", "-0.2", "-1", "more")),
    *(f"shouts {x}" for x in ("0", "-0.2", "-0.5", "more")),
    *(f"capitals {x}" for x in ("0", "-0.3", "-0.7", "more")),
    *(f"digits {x}" for x in ("0", "-0.3", "more")),
    *(f"length {x}" for x in ("-3", "-8", "more")),
    "ends a sentence",
    "no sentence end",
    "seen before",
    "repeats words",
]


def bin_of(x: float, bounds: tuple[float, ...]) -> int:
    for k, b in enumerate(bounds):
        if x <= b:
            return k
    return len(bounds)


def line_features(line: str, words: list[bytes], seen: bool) -> tuple[int, ...]:
    """Places in FEATURES that hold for a line."""
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS)) / n
    shouts = line.count("!") / n
    capitals = sum(map(bytes.isupper, words)) / n
    digits = sum(w[:1].isdigit() for w in words) / n
    size = (len(line) - n + 1) / n
    return (
        bin_of(n, (3, 9, 29)),
        4 + bin_of(symbols, (0, 0.2, 1)),
        8 + bin_of(shouts, (0, 0.2, 0.5)),
        12 + bin_of(capitals, (0, 0.3, 0.7)),
        16 + bin_of(digits, (0, 0.3)),
        19 + bin_of(size, (3, 8)),
        22 if line.rstrip()[-1:] in ".!?:;\"'" else 23,
        *((24,) if seen else ()),
        *((25,) if n >= 6 and len(set(words)) < 0.5 * n else ()),
    )


@dataclass
class Measured:
    """What one pass over a text finds."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: list[tuple[int, tuple[int, ...]]]

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    many = Counter(windows)
    n, covered = 0, 0
    for k, w in enumerate(windows):
        if many[w] > 1:
            n += k + 3 - max(k, covered)
            covered = k + 3
    return n


def measure(text: str) -> Measured:
    """Base counts of a whole text and the features of its lines, with the words in each."""
    words: list[bytes] = []
    seen: set[str] = set()
    repeats = 0
    lines = []
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if not own:
            continue
        again = line in seen
        repeats += again
        seen.add(line)
        words += own
        lines.append((len(own), line_features(line, own, again)))
    chars = len(text) - sum(map(text.count, BLANKS))
    return Measured(len(words), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words), lines)


@dataclass
class Field:
    """Score of content against boilerplate for each feature, and scores of steps [from][to], 0 boilerplate and 1 content."""

    weights: list[float]
    steps: list[list[float]]

    def decode(self, lines: list[tuple[int, tuple[int, ...]]]) -> list[int]:
        """The best labels of a document's lines (Viterbi). Ties go to content."""
        if not lines:
            return []
        w, ((bb, bc), (cb, cc)) = self.weights, self.steps
        back: list[tuple[int, int]] = []
        low, high = 0.0, sum([w[k] for k in lines[0][1]])
        for _, features in lines[1:]:
            to_low = (0, low + bb) if low + bb > high + cb else (1, high + cb)
            to_high = (0, low + bc) if low + bc > high + cc else (1, high + cc)
            back.append((to_low[0], to_high[0]))
            low, high = to_low[1], to_high[1] + sum([w[k] for k in features])
            # only the difference matters; without this the sums of long texts would lose digits
            low, high = low - high, 0.0
        labels = [int(high >= low)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def share(self, lines: list[tuple[int, tuple[int, ...]]]) -> float:
        """Share of words in content lines; nought without words."""
        whole = sum(n for n, _ in lines)
        return sum(n for (n, _), y in zip(lines, self.decode(lines), strict=True) if y) / whole if whole else 0.0


def train(stretches: list[list[int]], labels: list[int], rounds: int = 300, rate: float = 0.1) -> Field:
    """Maximum likelihood by gradient steps (Adam), over all stretches, forward and backward in log space.

    A line is given by its features as bits. Lines with the same features have
    the same score, so scores are worked out once for each set of features.
    """
    order = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
    kinds, place = np.unique(np.concatenate([np.asarray(stretches[i], np.int32) for i in order]), return_inverse=True)
    has = ((kinds[:, None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)
    blocks, at = [], 0
    for k in range(0, len(order), TOGETHER):
        own = order[k : k + TOGETHER]
        sizes = np.array([len(stretches[i]) for i in own])
        there = np.arange(sizes.max()) < sizes[:, None]
        lines = np.zeros(there.shape, np.int32)
        lines[there] = place[at : at + sizes.sum()]
        at += sizes.sum()
        blocks.append((lines, there, np.array([labels[i] for i in own])[:, None]))
    # what the labels hold doesn't change from round to round
    held, both = np.zeros(len(kinds)), np.zeros((2, 2))
    for lines, there, y in blocks:
        held += np.bincount(lines[there], weights=np.broadcast_to(y, there.shape)[there], minlength=len(kinds))
        both[0, 0] += (there[:, 1:] & (y == 0)).sum()
        both[1, 1] += (there[:, 1:] & (y == 1)).sum()
    weights, steps = np.zeros(len(FEATURES)), np.zeros((2, 2))
    first, second = np.zeros(len(FEATURES) + 4), np.zeros(len(FEATURES) + 4)
    for k in range(1, rounds + 1):
        score = has @ weights
        content, edges = np.zeros(len(kinds)), np.zeros((2, 2))
        for lines, there, _ in blocks:
            n, longest = there.shape
            emit = np.zeros((longest, n, 2))
            emit[:, :, 1] = score[lines.T]
            fore, aft = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
            fore[0] = emit[0]
            for t in range(1, longest):
                a, b = fore[t - 1, :, 0], fore[t - 1, :, 1]
                step = np.stack([np.logaddexp(a + steps[0, j], b + steps[1, j]) for j in (0, 1)], axis=1) + emit[t]
                fore[t] = np.where(there[:, t, None], step, fore[t - 1])
            for t in range(longest - 2, -1, -1):
                a, b = (emit[t + 1] + aft[t + 1]).T
                step = np.stack([np.logaddexp(a + steps[i, 0], b + steps[i, 1]) for i in (0, 1)], axis=1)
                aft[t] = np.where(there[:, t + 1, None], step, 0)
            norm = np.logaddexp(fore[-1, :, 0], fore[-1, :, 1])
            node = np.exp(fore[:, :, 1] + aft[:, :, 1] - norm).T
            content += np.bincount(lines[there], weights=node[there], minlength=len(kinds))
            pairs = there.T[1:]
            for i in (0, 1):
                for j in (0, 1):
                    edge = fore[:-1, :, i] + steps[i, j] + emit[1:, :, j] + aft[1:, :, j] - norm
                    edges[i, j] += np.exp(edge[pairs]).sum()
        slope = np.concatenate([(held - content) @ has, (both - edges).ravel()]) / len(place)
        slope -= 1e-4 * np.concatenate([weights, steps.ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        weights += move[:-4]
        steps += move[-4:].reshape(2, 2)
    return Field(weights.tolist(), steps.tolist())


def fit(docs: DataFrame, labels: DataFrame, texts: int = TEXTS) -> Field:
    """Train on ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, quality``, 0 or 1; others teach nothing).

    About ``texts`` documents of each kind are read, whole, in stretches of
    ``LINES`` lines. Without labels of both kinds the field calls everything
    content.
    """
    usable, sizes, _ = labelled_sample(docs, labels, "quality", texts)
    if len(sizes) < 2:
        return Field([0.0] * len(FEATURES), [[0.0, 0.0], [0.0, 0.0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256, 4_000_000):
            out, kinds = [], []
            for text, kind in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                lines = [sum(1 << k for k in f) for _, f in measure(text).lines]
                for at in range(0, len(lines), LINES):
                    out.append(lines[at : at + LINES])
                    kinds.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32())), pa.array(kinds, pa.int32())], ["lines", "quality"])

    rows = usable.mapInArrow(run, "lines array<int>, quality int").toArrow()
    # a fixed order, so that sums of floats come out alike on every run
    if not rows.num_rows:
        return Field([0.0] * len(FEATURES), [[0.0, 0.0], [0.0, 0.0]])
    made = sorted(zip(rows.column("lines").to_pylist(), rows.column("quality").to_pylist(), strict=True))
    return train([x for x, _ in made], [q for _, q in made])


def judge(docs: DataFrame, field: Field, keep: list[str], share: float = SHARE) -> DataFrame:
    """The columns in ``keep``, the base counts, ``content_share``, ``base_failed`` and ``kept`` of every row.

    Null and empty texts have no words, fail the base rules and aren't kept.
    Every row stands alone, so repeated rows are judged alike.
    """
    rows, keep = chosen(docs, keep, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    fields = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"
    schema = schema_with(docs.select(*keep), fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, 512, 8_000_000):
            rows = []
            for text in part.column("text").to_pylist():
                m = measure(text or "")
                content = model.share(m.lines)
                rows.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed, content, not m.base_failed and content >= share))
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()], strict=True)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], schema.names)

    return rows.mapInArrow(run, schema)
