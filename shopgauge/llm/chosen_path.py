"""Near-duplicate documents by a chosen-path set similarity join on minwise tokens.

A tree begins with all documents. A node chooses ``BRANCHES`` of the tree's minwise
hash functions, by a hash of its own name, and sends each document on under its
token of each. Similar documents agree on a token as often as they are similar, so
whatever the depth, the chance that a linked pair stays together in some child is
at least ``p = 1 - (1 - 0.8 p)^2``, which is 0.9375. Small nodes are compared
exhaustively. Independent trees find what others have missed: with ``TREES`` of
them a pair just similar enough is missed with a chance of 0.0625^4, below 2 in
100,000. What is found is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import slices, store
from shopgauge.llm.components import components
from shopgauge.llm.jaccard import across, mix, sketch, unlike, word_hashes

#: Words in a shingle, and the similarity from which documents are linked, in hundredths.
WORDS, SIMILAR = 2, 80
#: Independent trees, hash functions of a tree, and how many of them a node chooses.
TREES, FUNCTIONS, BRANCHES = 4, 16, 2
#: Documents up to which a node is compared exhaustively, and in one piece of a larger one.
SMALL = 200
#: A large node that keeps this share of its parent is dense: more branching would not take it apart.
DENSE = 0.6
#: Depth at which large nodes are treated as dense ones.
DEEPEST = 24
#: Tokens of a tree on which a pair must agree to be confirmed. A linked pair has fewer with a chance of 0.007.
AGREED = 9

U = np.uint64


def shingles(text: str | None) -> np.ndarray:
    """The set of hashes of two words in a row, sorted; of the single word if it is alone."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(words):
        return words
    n = min(WORDS, len(words))
    count = len(words) - n + 1
    total = np.full(count, U(n))
    for k in range(n):
        total = mix(total + words[k : k + count] * U(2 * k + 1))
    return np.unique(total)


def tokens(sets: list[np.ndarray]) -> np.ndarray:
    """For each set (none empty), 16 bits of its least hash under every function."""
    count = TREES * FUNCTIONS
    out = np.zeros((len(sets), count), np.int16)
    if not sets:
        return out
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    salts = mix(np.arange(1, 2 * count + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    for k in range(count):
        least = np.minimum.reduceat((flat ^ salts[2 * k]) * (salts[2 * k + 1] | U(1)), starts)
        out[:, k] = (mix(least) >> U(48)).astype(np.uint16).view(np.int16)
    return out


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def survey(docs: DataFrame) -> DataFrame:
    """``doc_id, n, k1, k2, tokens, bits`` of every row: set size, digest of the set, minwise tokens (null if the set is empty), parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048, 8_000_000):
            made: dict[str | None, int] = {}
            at = [made.setdefault(t, len(made)) for t in part.column("text").to_pylist()]
            sets = [shingles(t) for t in made]
            keys = np.frombuffer(b"".join(map(digest, sets)), np.int64).reshape(-1, 2)
            filled = [k for k, s in enumerate(sets) if len(s)]
            bits = [sketch(x) for x in sets]
            own: list = [None] * len(sets)
            for k, row in zip(filled, tokens([sets[k] for k in filled]), strict=True):
                own[k] = row
            columns = [
                part.column("doc_id"),
                pa.array([len(sets[k]) for k in at], pa.int64()),
                pa.array(keys[at, 0]),
                pa.array(keys[at, 1]),
                pa.array([own[k] for k in at], pa.list_(pa.int16())),
                pa.array([bits[k] for k in at], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "k1", "k2", "tokens", "bits"])

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, tokens array<short>, bits array<long>")


def children(path: Column, tokens_: Column) -> Column:
    """The paths on which a document goes on from a node: two different functions, chosen by the node's name."""
    first = F.pmod(F.xxhash64(path, F.lit(1)), F.lit(FUNCTIONS)).cast("int")
    other = (first + 1 + F.pmod(F.xxhash64(path, F.lit(2)), F.lit(FUNCTIONS - 1)).cast("int")) % FUNCTIONS
    return F.array(*(F.xxhash64(path, i, F.get(tokens_, i)) for i in (first, other)))


def grow(members: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """The small nodes and the dense nodes of some trees, as ``path, node, n, tokens, component, size``; None if there are none.

    ``members``: ``tree, node, n, tokens, component``. Nodes of a single component
    have nothing to find and end. Sizes come from a count of their own, so a
    large node is never gathered in a task.
    """
    roots = members.withColumn("path", F.explode(children(F.col("tree"), F.col("tokens")))).drop("tree")
    rows = roots.withColumn("parent", F.lit(1 << 62))
    small, dense = [], []
    for depth in range(DEEPEST):
        mixed = rows.groupBy("path").agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
        level = store(rows.join(mixed.where("low <> high").select("path", "size"), "path"), "paths-level")
        settled = (F.col("size") >= DENSE * F.col("parent")) if depth < DEEPEST - 1 else F.lit(True)
        large = F.col("size") > SMALL
        count = level.agg(F.count(F.when(~large, 1)).alias("small"), F.count(F.when(large & settled, 1)).alias("dense"), F.count(F.when(large & ~settled, 1)).alias("open")).first()
        if count["small"]:
            small.append(level.where(~large).drop("parent"))
        if count["dense"]:
            dense.append(level.where(large & settled).drop("parent"))
        if not count["open"]:
            break
        rows = level.where(large & ~settled).withColumn("parent", F.col("size")).drop("size")
        rows = rows.withColumn("path", F.explode(children(F.col("path"), F.col("tokens"))))
    return joined(small), joined(dense)


def joined(frames: list[DataFrame]) -> DataFrame | None:
    total = None
    for df in frames:
        total = df if total is None else total.unionByName(df)
    return total


def passing(n: np.ndarray, own: np.ndarray, component: np.ndarray) -> np.ndarray:
    """Which pairs of a group may be linked: of different components, near in size, and agreeing on enough tokens."""
    near = (100 * np.minimum.outer(n, n) >= SIMILAR * np.maximum.outer(n, n)) & (component[:, None] != component[None, :])
    if near.any():
        agreed = np.zeros(near.shape, np.int8)
        for k in range(own.shape[1]):
            agreed += own[:, k][:, None] == own[:, k][None, :]
        near &= agreed >= AGREED
    return near


def spanning(may: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """Pairs that join all that passing pairs join, spread from members with most partners, and the first of those."""
    degree = may.sum(axis=1)
    seen = degree == 0
    pairs = []
    for start in np.argsort(-degree, kind="stable").tolist():
        if seen[start]:
            continue
        seen[start] = True
        queue = [start]
        while queue:
            v = queue.pop()
            for w in np.flatnonzero(may[v] & ~seen).tolist():
                seen[w] = True
                pairs.append((v, w))
                queue.append(w)
    return pairs, int(degree.argmax())


PAIR, LIVE, HUB = 0, 1, 2
#: The piece of nodes that are compared whole.
WHOLE = -1
FOUND = "kind int, path long, piece int, a long, b long, n long, tokens array<short>"


def compare(groups: DataFrame, every: bool) -> DataFrame:
    """All pairs of each group (``path``, ``piece``) compared by their tokens; see ``FOUND``.

    With ``every``, all pairs of different components are given that pass and whose
    parities (``bits``) don't rule them out. Else
    only as many as join the same members (``PAIR``, ``a`` and ``b``), the members of ``WHOLE`` nodes
    in which more pairs pass (``LIVE``), and of each piece the member with
    most partners (``HUB``, ``b`` their share in millionths), so what is given grows with the members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = held.column("path").to_numpy(), held.column("piece").to_numpy()
            last = len(held) - 1
            complete = np.searchsorted(((key[0] != key[0][last]) | (key[1] != key[1][last]))[::-1], True)
            cut = len(held) - int(complete) if complete < len(held) else 0
            if cut:
                yield from settle(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and len(held):
            yield from settle(held)

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        path, piece, node, n, component = (rows.column(c).to_numpy() for c in ("path", "piece", "node", "n", "component"))
        own = rows.column("tokens").combine_chunks().flatten().to_numpy().reshape(-1, FUNCTIONS)
        starts = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (piece[1:] != piece[:-1]))))
        if every:
            bits = rows.column("bits").combine_chunks()
            width = pc.list_value_length(bits).to_numpy().astype(np.int64)
            begin, flat = np.cumsum(width) - width, bits.flatten().to_numpy().view(U)
        out: list[tuple] = []
        for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(path)], strict=True):
            if high - low < 2:
                continue
            part = slice(low, high)
            may = passing(n[part], own[part], component[part])
            total = int(may.sum()) // 2
            if not total:
                continue
            here = (int(path[low]), int(piece[low]))
            if every:
                both = np.argwhere(np.triu(may)) + low
                both = both[~unlike(both, n, begin, width, flat)]
                out.extend((PAIR, *here, int(node[v]), int(node[w]), None, None) for v, w in both.tolist())
                continue
            pairs, hub = spanning(may)
            out.extend((PAIR, *here, int(node[low + v]), int(node[low + w]), None, None) for v, w in pairs)
            out.append((HUB, *here, int(node[low + hub]), int(may[hub].sum()) * 1_000_000 // (high - low), None, None))
            if here[1] == WHOLE and total > len(pairs):
                live = np.flatnonzero(may.any(axis=1)).tolist()
                out.extend((LIVE, *here, int(node[low + v]), None, int(n[low + v]), own[low + v]) for v in live)
        if out:
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int16()))
            names = ["kind", "path", "piece", "a", "b", "n", "tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    keyed = groups.select("path", "piece", "node", "n", "tokens", "component", *(["bits"] if every else []))
    return keyed.repartition("path", "piece").sortWithinPartitions("path", "piece").mapInArrow(run, FOUND)


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


class Confirmed:
    """Confirms pairs on the full sets, which it makes once for each class of equal sets that is asked for."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes.select("node", "rep", "k1", "k2")
        self.sets: DataFrame | None = None

    def _make(self, wanted: DataFrame) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, 1024, 4_000_000):
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                keys = list(zip(*(part.column(c).to_pylist() for c in ("k1", "k2")), strict=True))
                # an id may have several texts; the one whose set this class has counts
                same = [k for k, s in enumerate(sets) if tuple(np.frombuffer(digest(s), np.int64).tolist()) == keys[k]]
                shown = pa.array([sets[k].view(np.int64) for k in same], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(same, pa.int64())), shown], ["node", "shingles"])

        named = self.classes.join(wanted, "node", "left_semi").select("node", F.col("rep").alias("doc_id"), "k1", "k2")
        texts = self.docs.join(named, "doc_id").select("node", "k1", "k2", "text")
        made = store(texts.mapInArrow(run, "node long, shingles array<long>"), "paths-sets")
        self.sets = made if self.sets is None else self.sets.unionByName(made)

    def __call__(self, pairs: DataFrame) -> DataFrame | None:
        """Those of ``pairs`` (``a``, ``b``) that are linked, or None if none are."""
        pairs = store(ordered(pairs), "paths-pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node"), "node", "left_anti")
        wanted = store(wanted, "paths-wanted")
        if not wanted.isEmpty():
            self._make(wanted)
        if self.sets is None:
            return None
        x = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        y = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        alike = 100 * both >= SIMILAR * (F.size("x") + F.size("y") - both)
        links = store(pairs.join(x, "a").join(y, "b").where(alike).select("a", "b"), "paths-links")
        return None if links.isEmpty() else links


def links_of(classes: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Enough links between classes (``a``, ``b``, by ``node``) to join all that are linked, or None."""
    confirm = Confirmed(docs, classes)
    links: list[DataFrame] = []

    def known() -> DataFrame | None:
        return store(components(joined(links)), "paths-components") if links else None

    def labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
        if found is None:
            return rows.withColumn("component", F.col("node"))
        return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def add(pairs: DataFrame) -> bool:
        more = confirm(pairs)
        if more is not None:
            links.append(more)
        return more is not None

    def members(trees: list[int]) -> DataFrame:
        own = [F.struct(F.lit(t).cast("long").alias("tree"), F.slice("tokens", t * FUNCTIONS + 1, FUNCTIONS).alias("tokens")) for t in trees]
        return classes.select("node", "n", F.explode(F.array(*own)).alias("own")).select("own.tree", "node", "n", "own.tokens")

    found = None
    lives, denses = [], []
    # the first tree joins most of what is alike, so that the others end early
    for trees in ([0], list(range(1, TREES))):
        small, dense = grow(labelled(members(trees), found))
        groups = []
        if small is not None:
            groups.append(small.withColumn("piece", F.lit(WHOLE)))
        if dense is not None:
            pieces = F.ceil(F.col("size") / SMALL)
            groups.append(dense.withColumn("piece", F.pmod(F.xxhash64("node", "path"), pieces).cast("int")))
        if not groups:
            continue
        seen = store(compare(joined(groups), every=False), "paths-compared")
        pairs = seen.where(F.col("kind") == PAIR).select("a", "b")
        lives.append(seen.where(F.col("kind") == LIVE).select("path", "piece", F.col("a").alias("node"), "n", "tokens"))
        if dense is not None:  # all of a dense node against the one that had most partners in its piece
            hubs = seen.where(F.col("kind") == HUB).groupBy("path").agg(F.max_by("a", F.struct("b", "a")).alias("hub"))
            star = dense.join(hubs, "path").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
            pairs = pairs.unionByName(star)
            denses.append(dense.drop("component"))
        if add(pairs):
            found = known()
    # what is left: pairs that pass, of members whom the links so far haven't joined; those of dense nodes are compared once, with all of the node
    left = []
    bits = classes.select("node", "bits")
    if lives:
        open_ = several(labelled(joined(lives), found), ["path", "piece"])
        left.append(compare(open_.join(bits, "node"), every=True).select("a", "b"))
    if denses:
        # each pair once, though near copies share most of their nodes
        open_ = several(labelled(joined(denses), found), ["path"]).select(F.col("path").alias("bucket"), "node", "component")
        left.append(across(open_, classes.select("node", "n", "bits")))
    if left:
        add(joined(left))
    return joined(links)


def several(rows: DataFrame, group: list[str]) -> DataFrame:
    """The rows of groups with more than one component."""
    open_ = rows.groupBy(*group).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return rows.join(open_.select(*group), group, "left_semi")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Documents are linked when their sets of two-word shingles are at least
    ``SIMILAR`` hundredths alike. Equal sets stand for one class; the class with
    its smallest id takes part in the trees. The component is named by the
    smallest id that links lead to, and that document is kept.

    Null, empty and blank texts have an empty set, are linked with nothing and
    kept. Rows that repeat an id are linked with all that any of them is linked
    with, and each row keeps its own set size. Rows without an id are linked
    with nothing, have no component and are kept. An empty table gives an empty
    one; other columns aren't read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = own.where("doc_id is not null")
    info = store(survey(own), "paths-survey")
    filled = info.where("n > 0 and doc_id is not null")
    classes = filled.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "paths-classes")
    links = links_of(classes, named)
    reps = classes.select("node", "rep")
    rows = filled.select("doc_id", "n", "k1", "k2").join(classes.select("n", "k1", "k2", "rep"), ["n", "k1", "k2"])
    rows = store(rows.select("doc_id", "n", "rep"), "paths-rows")
    # the classes of one id are linked through it
    ids = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    edges = rows.join(ids, "doc_id").select("a", F.col("rep").alias("b"))
    if links is not None:
        a, b = reps.select(F.col("node").alias("a"), F.col("rep").alias("x")), reps.select(F.col("node").alias("b"), F.col("rep").alias("y"))
        edges = edges.unionByName(links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = components(edges).withColumnRenamed("node", "rep")
    linked = rows.join(found, "rep", "left").select("doc_id", "n", F.coalesce("component", "rep").alias("component_id"))
    rest = info.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = linked.unionByName(rest)
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
