"""Byte-pair encoding and decoding in batched numpy merge rounds.

The words of many documents lie in one flat array of symbols. A round looks up
every neighbouring pair by binary search over the sorted pair keys, finds the
lowest rank of each word, and joins that pair wherever it stands in the word.
Words without a known pair leave the array, so later rounds touch only what is
still open.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from shopgauge.llm.common import schema_with, slices

#: Entries that a worker keeps between batches; it starts anew beyond them.
CACHE = 600_000
#: Letters below this have had the same case and class in every version of Unicode; NFC leaves texts of them alone.
LATIN = "\u0250"
NONE = np.int64(1) << 60


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(other)) for b in range(256)]


class Codec:
    """A vocabulary file of the kind "BPE with word ends, lower case".

    Reads the pattern, the added tokens, the merges and the word-end mark from
    the file. Truncation, padding and post-processing are not used.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.tokens = [""] * self.size
        for token, i in vocab.items():
            self.tokens[i] = token
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            self.tokens[i] = token
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        # beyond the Latin letters, case and classes follow the library's Unicode tables, not Python's
        rules = Tokenizer.from_file(path)
        self.normalise = rules.normalizer.normalize_str
        self.cut = rules.pre_tokenizer.pre_tokenize_str
        self.byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + self.end] for c in alphabet], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        ranks = np.arange(len(merges), dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.made, self.ranks = keys[order], made[order], ranks[order]
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.cache or len(self.cache) > CACHE:
            # a key with a blank can't be a chunk of ordinary text
            self.cache = {" " + token: np.uint32(i).tobytes() for token, i in self.added.items()}
        cache = self.cache
        cut = [self._chunks(text) for text in texts]
        self._learn({c for chunks in cut for c in chunks if c not in cache})
        return [b"".join(map(cache.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids: list[bytes]) -> list[str]:
        """The tokens of each list of ids with a blank between; the vocabulary names no other decoder."""
        token = self.tokens.__getitem__
        return [" ".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]

    def _chunks(self, text: str) -> list[str]:
        """Pieces without blanks. Added tokens are cut out of the text as it came, before normalising."""
        if "<|" not in text:
            return self._plain(text)
        found: list[str] = []
        for i, part in enumerate(self.cut_added.split(text)):
            found += [" " + part] if i % 2 else self._plain(part)
        return found

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
                return text.lower().split()
        elif max(text) < LATIN and not any(c in text for c in "\x1c\x1d\x1e\x1fİ"):
            return text.lower().split()
        return [c for c in self.normalise(text).split(" ") if c]

    def _learn(self, chunks: set[str]) -> None:
        """Put the ids of new chunks, and of the pieces they consist of, into the cache."""
        cache, parts, whole = self.cache, {}, set()
        for c in chunks:
            if c.isascii() and c.isalpha():
                whole.add(c)
                continue
            if max(c) < LATIN:
                found = self.pieces.findall(c)
            else:
                found = [bytes(map(self.byte_of.__getitem__, x)).decode() for x, _ in self.cut(c)]
            if len(found) == 1:
                whole.add(c)
            else:
                parts[c] = found
                whole.update(x for x in found if x not in cache)
        order = list(whole)
        ids, length = self.merge([x.encode() for x in order])
        flat, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(length)).tolist()
        at = 0
        for x, end in zip(order, ends, strict=True):
            cache[x] = flat[at:end]
            at = end
        for c, found in parts.items():
            cache[c] = b"".join(map(cache.__getitem__, found))

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each piece has."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        length = np.array([len(p) for p in pieces], np.int64)
        final = np.zeros(len(raw), bool)
        final[np.cumsum(length) - 1] = True
        symbols = np.where(final, self.last[raw], self.inner[raw])
        word = np.repeat(np.arange(len(pieces)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            same = word[:-1] == word[1:]
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(symbols), NONE)
            rank[:-1] = np.where(same & (self.keys[at] == key), self.ranks[at], NONE)
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.concatenate((starts, [len(symbols)])))
            mine = np.repeat(lowest, sizes)
            if not (lowest < NONE).all():
                closed = mine == NONE
                done.append((symbols[closed], word[closed]))
            joins = (rank == mine) & (mine < NONE)
            # of pairs that overlap, as in "aaa", every second one counts from the left
            where = np.flatnonzero(joins)
            if len(where) > 1:
                fresh = np.concatenate(([True], np.diff(where) > 1))
                first = np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
                joins[where[(np.arange(len(where)) - first) % 2 == 1]] = False
            where = np.flatnonzero(joins)
            kept = mine < NONE
            symbols = symbols.copy()
            if len(where):
                symbols[where] = self.made[at[where]]
                kept[where + 1] = False
            symbols, word = symbols[kept], word[kept]
        ids, of = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(of, kind="stable")
        return ids[order], np.bincount(of, minlength=len(pieces))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The rows with a column ``ids``: the tokens as little-endian unsigned 32-bit integers.

    Null texts count as empty and have no ids. Other columns stay; a column
    named ``ids`` in the input is replaced.
    """
    rest = docs.drop("ids") if "ids" in docs.columns else docs
    schema = schema_with(rest, "ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for part in slices(batches, 1024, 8_000_000):
            ids = codec.encode([x or "" for x in part.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], [*part.schema.names, "ids"])

    return rest.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with a column ``decoded``: the text that the ids stand for."""
    rest = encoded.drop("decoded") if "decoded" in encoded.columns else encoded
    schema = schema_with(rest, "decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for part in slices(batches, 1024, 8_000_000):
            back = codec.decode([x or b"" for x in part.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], [*part.schema.names, "decoded"])

    return rest.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text, decode the ids, and keep a digest of both.

    One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.
    Both directions run in one pass over a batch, so neither the ids nor the
    decoded texts leave the worker. Empty and null texts have no tokens and
    the digests of nothing. Repeated rows give repeated rows; other columns
    are not read. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for part in slices(batches, 1024, 8_000_000):
            ids = codec.encode([x or "" for x in part.column("text").to_pylist()])
            back = [hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for one in ids for x in codec.decode([one])]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array(back, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
