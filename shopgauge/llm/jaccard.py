"""Near-duplicate documents: an exact Jaccard join on five-word shingles by PartEnum.

Sets of like size form a band, within which linked sets differ in few shingles.
The shingle domain is cut into partitions, each into parts, more partitions
than the differences can spoil: one at least differs in a single shingle at
most, so that all its parts but one are equal. A set's signatures are the
contents of every choice of parts that leaves one out, so linked sets share a
signature. Sets that share one are candidates, and are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import Stored, collect_garbage, owned, slices, store
from shopgauge.llm.components import components

#: Words in a shingle, and the similarity from which documents are linked, in hundredths.
WORDS, SIMILAR = 5, 80
#: Growth of sizes from band to band.
GROWTH = 1.35
#: Parts of a partition; a signature leaves one out.
PARTS = 3
#: Times the number of shuffle partitions into which signatures are dealt.
DEALT = 2
#: Sets up to which what is left is compared in one piece; pieces of larger groups grow with the root of their size.
TILE = 1024
#: Buckets of a member that are known where it is compared, so that a pair isn't given in each.
FIRST = 32
#: Entries of one signature in a batch from which they skip the shuffle.
HOT = 16

U = np.uint64
MASK48 = U((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-known finalizer of 64-bit hashes (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15 | 1, U))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text, A-Z as a-z. Words end at ASCII blanks."""
    raw = np.frombuffer(data.lower(), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    inside = np.flatnonzero(~blank)
    if not len(inside):
        return np.zeros(0, U)
    begins = np.flatnonzero(np.concatenate(([True], np.diff(inside) > 1)))
    length = np.diff(np.concatenate((begins, [len(inside)])))
    at = np.arange(len(inside)) - np.repeat(begins, length)
    if length.max() > len(POWERS):  # a word longer than the table of powers
        ends = np.cumsum(length)
        text = raw[inside].tobytes()
        digest = lambda x: int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little")
        own = np.array([digest(text[e - n : e]) for e, n in zip(ends.tolist(), length.tolist(), strict=True)], U)
        if length.max() == length.min():
            return own
        short = length <= len(POWERS)
        part = np.add.reduceat((raw[inside].astype(U) + U(1)) * POWERS[np.minimum(at, len(POWERS) - 1)], begins)
        return np.where(short, mix(part + length.astype(U)), own)
    return mix(np.add.reduceat((raw[inside].astype(U) + U(1)) * POWERS[at], begins) + length.astype(U))


def shingles(text: str | None) -> np.ndarray:
    """The set of hashes of five words in a row, sorted; of the whole text if it has fewer words."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(words):
        return words
    n = min(WORDS, len(words))
    count = len(words) - n + 1
    total = np.full(count, U(n))
    for k in range(n):
        total = mix(total + words[k : k + count] * U(2 * k + 1))
    return np.unique(total)


def bands(longest: int) -> list[tuple[int, int, int, int]]:
    """``least, most, partitions, spare`` of each band, up to sets of the given size.

    A band holds the pairs whose smaller set has from ``least`` up to the next
    band's ``least`` shingles; ``most`` is the larger set's size at most. The
    sets of a pair with x shingles in the smaller one differ in x / 4 at most.
    ``spare`` partitions are there besides what those differences can spoil.
    """
    out = []
    least = 1
    while least <= longest:
        after = max(least + 1, int(least * GROWTH))
        most = (after - 1) * 100 // SIMILAR
        differ = (after - 1) * (100 - SIMILAR) // SIMILAR
        spare = differ // 12 + (2 if differ > 3 else 0)
        out.append((least, most, differ // 2 + 1 + spare, spare))
        least = after
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets and the place of the set that each belongs to.

    A choice of parts without a shingle says nothing and is left out, as long as
    it concerns ``spare`` partitions of a set at most: then linked sets still
    share another signature, since what they share is empty for both or neither.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    found, owner = [], []
    for number, (least, most, partitions, spare) in enumerate(bands(int(sizes.max(initial=0)))):
        chosen = np.flatnonzero((sizes >= least) & (sizes <= most))
        if not len(chosen):
            continue
        flat = np.concatenate([sets[k] for k in chosen])
        cells = partitions * PARTS
        of = np.repeat(np.arange(len(chosen)), sizes[chosen])
        # sets are sorted, and a cell is a range of hashes, so cells are runs
        cell = of * cells + ((flat >> U(32)) * U(cells) >> U(32)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        content = np.zeros(len(chosen) * cells, U)
        content[cell[starts]] = np.add.reduceat(mix(flat ^ U(0x5851F42D4C957F2D)), starts)
        filled = np.zeros(len(chosen) * cells, bool)
        filled[cell[starts]] = True
        content, filled = content.reshape(-1, partitions, PARTS), filled.reshape(-1, partitions, PARTS)
        place = (np.arange(partitions, dtype=U) * U(PARTS))[None, :] + U(number << 40)
        own, any_ = [], []
        for left_out in range(PARTS):
            total = place + U(left_out + 1)
            for part in range(PARTS):
                if part != left_out:
                    total = mix(total + content[:, :, part] * U(2 * part + 3))
            own.append(np.broadcast_to(total, content.shape[:2]))
            any_.append(np.delete(filled, left_out, axis=2).any(axis=2))
        own, any_ = np.stack(own, axis=2), np.stack(any_, axis=2)
        keep = any_ | ((~any_).any(axis=2).sum(axis=1) > spare)[:, None, None]
        who, *_ = np.nonzero(keep)
        found.append(own[keep])
        owner.append(chosen[who])
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


MADE = "bucket long, row long, doc_id long, n long, k1 long, k2 long"


def bucket_of(sign: np.ndarray, group: np.ndarray | int) -> np.ndarray:
    """One number for a signature, from the 48 bits that travel and the group that it was dealt to."""
    return mix(sign ^ mix(np.atleast_1d(np.asarray(group, np.int64)).astype(U) + U(0x9E3779B97F4A7C15)))


def survey(docs: DataFrame, groups: int) -> DataFrame:
    """Rows of two kinds: each row's number, id, set size and digest (bucket null), and each member of a shared signature, by row.

    ``docs``: ``row, doc_id, text``, where ``row`` tells rows of one id apart.

    Signatures of a batch travel packed, eight bytes each: 48 bits of the
    signature and the document's place in the batch. Where one signature is
    shared within a batch by many, its members go on as they are and only one
    takes part in the search for further ones, so what meets in a task is
    bounded by the number of batches, not by the size of a group of copies.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096, 16_000_000):
            ids = np.array(part.column("row").to_pylist(), np.int64)
            docs_ = np.array(part.column("doc_id").to_pylist(), np.int64)
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            info = np.column_stack([ids, docs_, [len(x) for x in sets], np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)])
            rows: list[tuple[int, bytes, bytes]] = [(int(ids[0]) % groups, info.astype(np.int64).tobytes(), b"")]
            # copies within a batch have the same signatures; one speaks for them
            first = dict(zip(reversed(digests), reversed(range(len(sets))), strict=True))
            alone = sorted(k for k in first.values() if len(sets[k]))
            found, owner = signatures([sets[k] for k in alone])
            owner = np.array(alone, np.int64)[owner] if len(owner) else owner
            group = (found % U(groups)).astype(np.int64)
            entry = (found >> U(16) << U(16)) | owner.astype(U)
            order = np.lexsort((entry, group))
            group, entry = group[order], entry[order]
            sign = entry >> U(16)
            begins = np.flatnonzero(np.concatenate(([True], (sign[1:] != sign[:-1]) | (group[1:] != group[:-1])))) if len(sign) else np.zeros(0, np.int64)
            many = np.diff(np.concatenate((begins, [len(sign)])))
            hot = np.repeat(many >= HOT, many)
            if hot.any():
                members = np.column_stack([bucket_of(sign[hot], group[hot]).astype(np.int64), ids[(entry[hot] & U(0xFFFF)).astype(np.int64)]])
                rows.append((int(ids[-1]) % groups, b"", members.tobytes()))
            stays = ~hot
            stays[begins] = True
            group, entry = group[stays], entry[stays]
            cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(group)], strict=True):
                # the ids of the batch are shortened to those that occur
                used, at = np.unique((entry[a:b] & U(0xFFFF)).astype(np.int64), return_inverse=True)
                short = (entry[a:b] >> U(16) << U(16)) | at.astype(U)
                rows.append((int(group[a]), ids[used].tobytes() + b"", short.tobytes() + b"\x01"))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["part", "ids", "signs"])

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        info, members, signs, docs_ = [], [], [], []
        for ids, packed in zip(rows.column("ids").to_pylist(), rows.column("signs").to_pylist(), strict=True):
            if not packed:
                info.append(np.frombuffer(ids, np.int64).reshape(-1, 5))
            elif not ids:
                members.append(np.frombuffer(packed, np.int64).reshape(-1, 2))
            else:
                entry = np.frombuffer(packed[:-1], U)
                signs.append(entry >> U(16))
                docs_.append(np.frombuffer(ids, np.int64)[(entry & U(0xFFFF)).astype(np.int64)])
        if signs:
            sign, doc = np.concatenate(signs), np.concatenate(docs_)
            order = np.argsort(sign, kind="stable")
            sign, doc = sign[order], doc[order]
            same = sign[1:] == sign[:-1]
            shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
            members.append(np.column_stack([bucket_of(sign[shared], part).astype(np.int64), doc[shared]]))
        i = np.concatenate(info) if info else np.zeros((0, 5), np.int64)
        m = np.concatenate(members) if members else np.zeros((0, 2), np.int64)
        no = pa.nulls(len(m), pa.int64())
        columns = [pa.nulls(len(i), pa.int64()), *(pa.array(i[:, k]) for k in range(5))]
        more = [pa.array(m[:, 0]), pa.array(m[:, 1]), no, no, no, no]
        names = ["bucket", "row", "doc_id", "n", "k1", "k2"]
        return pa.concat_tables([pa.Table.from_arrays(columns, names), pa.Table.from_arrays(more, names)])

    packed = docs.mapInArrow(pack, "part long, ids binary, signs binary")
    return packed.groupBy("part").applyInArrow(meet, MADE)


def sketch(found: np.ndarray) -> np.ndarray:
    """Parities of a set: whether an even or odd number of shingles falls on each of 2 to 4 times as many bits.

    A shingle that only one of two sets has flips one bit, so the bits that
    differ are never more than the shingles that differ.
    """
    bits = max(64, 1 << (2 * len(found) - 1).bit_length())
    odd = np.bincount((found & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


SET = "node long, shingles array<long>, bits array<long>"


def sets_of(texts: DataFrame) -> DataFrame:
    """``node, shingles`` (sorted hashes), ``bits`` (parities) of ``node, k1, k2, text``.

    An id may have several texts: only that with the digest ``k1, k2`` counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for part in slices(batches, 1024, 4_000_000):
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            wanted = zip(*(part.column(c).to_pylist() for c in ("k1", "k2")), strict=True)
            own = [tuple(np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64).tolist()) for x in sets]
            same = [k for k, (x, y) in enumerate(zip(own, wanted, strict=True)) if x == y]
            sets = [sets[k] for k in same]
            columns = [part.column("node").take(pa.array(same, pa.int64())), pa.array([x.view(np.int64) for x in sets], longs), pa.array([sketch(x) for x in sets], longs)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "bits"])

    return texts.mapInArrow(run, SET)


def may_link(x: str, y: str) -> Column:
    """False for pairs whose sizes or parities show that too many shingles differ; never for linked ones."""
    differ = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, n: t + n)
    col = lambda of, name: F.col(f"{of}.{name}")
    a, b = col(x, "bits"), col(y, "bits")

    def folded(c: Column) -> Column:
        """Half as many bits, for comparison with a set half as wide."""
        half = F.size(c) / 2
        return F.zip_with(F.slice(c, 1, half.cast("int")), F.slice(c, half.cast("int") + 1, half.cast("int")), lambda u, v: u.bitwiseXOR(v))

    wider = F.size(a) - F.size(b)
    apart = F.when(wider == 0, differ(a, b)).when(wider > 0, differ(folded(a), b)).otherwise(differ(a, folded(b)))
    n, m = col(x, "n"), col(y, "n")
    return (F.greatest(n, m) * SIMILAR <= F.least(n, m) * 100) & ((100 + SIMILAR) * apart <= (100 - SIMILAR) * (n + m))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) that are similar enough, by exact counts."""
    each = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")).join(sets.select("node", "shingles"), "node")
    two = each.groupBy("a", "b").agg(F.collect_list("shingles").alias("s"))
    x, y = F.col("s")[0], F.col("s")[1]
    both = F.size(F.array_intersect(x, y))
    return two.where(100 * both >= SIMILAR * (F.size(x) + F.size(y) - both)).select("a", "b")


def near_duplicates(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Documents are linked when their sets are at least ``SIMILAR`` hundredths
    alike; the component is named by the smallest id that links lead to.
    Equal sets are linked and stand for one class from then on. Null, empty and
    blank texts have an empty set and no links. A document is its id: rows that
    repeat an id are linked with all that any of them is linked with, and each
    row keeps its own set size. Rows without an id are linked with nothing and
    have no component. An empty table gives an empty one; other columns aren't
    read.

    Only enough links are sought to join all that are linked, see ``candidates``.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = own.where("doc_id is not null")
    groups = DEALT * int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = store(survey(named.withColumn("row", F.monotonically_increasing_id()), groups), "jaccard-survey")
    info = made.where("bucket is null").select("row", "doc_id", "n", "k1", "k2")
    filled = info.where("n > 0")
    classes = filled.groupBy("n", "k1", "k2").agg(F.min("row").alias("node"), F.min("doc_id").alias("rep"))
    classes = store(classes, "jaccard-classes")
    rows = store(filled.join(classes, ["n", "k1", "k2"]).select("row", "doc_id", "n", "node", "rep"), "jaccard-rows")
    members = made.where("bucket is not null").select("bucket", "row").join(rows.select("row", "node", "n"), "row").select("bucket", "node", "n")
    links = candidates(named, classes, store(members.distinct(), "jaccard-members"), rounds)
    a, b = classes.select(F.col("node").alias("a"), F.col("rep").alias("x")), classes.select(F.col("node").alias("b"), F.col("rep").alias("y"))
    edges = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    # the classes of one id are linked through it
    ids = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    found = components(edges.unionByName(rows.join(ids, "doc_id").select("a", F.col("rep").alias("b"))))
    linked_rows = rows.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )
    empty = info.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    rest = own.where("doc_id is null").select("doc_id", "text")
    return linked_rows.unionByName(empty).unionByName(without_id(rest))


def without_id(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(shingles(t)) for t in batch.column("text").to_pylist()]
            no = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([no, pa.array(n, pa.int64()), no], ["doc_id", "n_shingles", "component_id"])

    return rows.mapInArrow(run, "doc_id long, n_shingles long, component_id long")


def candidates(docs: DataFrame, classes: DataFrame, members: DataFrame, rounds: int) -> DataFrame:
    """Links ``a, b`` between classes (by ``node``), enough of them to join all that are linked.

    ``members``: ``bucket, node, n``. In the first rounds each bucket's members
    are compared with one of them, another one each time, so a large group of
    copies costs one comparison for each member. Links join components, and
    buckets of one component are done. What is left is compared by ``across``.
    Of buckets with the same members one is kept. Parities rule out most pairs inside the join, and what passes is counted
    exactly.
    """
    open_ = store(members.join(unlike_buckets(members), "bucket", "left_semi"), "jaccard-open")
    wanted = classes.join(open_.select("node").distinct(), "node", "left_semi")
    texts = docs.join(wanted.select("node", "k1", "k2", F.col("rep").alias("doc_id")), "doc_id")
    # rows that repeat an id and a text count once; the join has brought them together already
    texts = texts.withColumn("digest", F.xxhash64("text")).dropDuplicates(["doc_id", "node", "digest"]).select("node", "k1", "k2", "text")
    sets = store(sets_of(texts), "jaccard-sets")
    narrow = sets.select("node", F.size("shingles").alias("n"), "bits")
    open_ = open_.withColumn("component", F.col("node"))
    links = None
    for turn in range(rounds + 1):
        if turn < rounds:
            center = F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"), F.col("component"))
            centers = open_.groupBy("bucket").agg(F.min(center).alias("c"))
            star = open_.join(centers, "bucket").where(F.col("component") != F.col("c.component"))
            pairs = star.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
            x, y = narrow.withColumnRenamed("node", "a").alias("x"), narrow.withColumnRenamed("node", "b").alias("y")
            pairs = pairs.join(x, "a").join(y, "b").where(may_link("x", "y")).select("a", "b")
        else:
            pairs = across(open_, narrow)
        found = store(linked(store(pairs, "jaccard-pairs"), sets), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        if turn < rounds:
            # the components aren't read again
            with owned(Stored()) as passing:
                joined = components(links)
            open_ = open_.drop("component").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
            several = open_.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
            open_ = store(open_.join(several, "bucket", "left_semi").select("bucket", "node", "component"), "jaccard-open")
            # with the plans go their shuffle files
            del joined, several
            passing.release(docs.sparkSession)
            collect_garbage(docs.sparkSession)
    return links


def unlike_buckets(members: DataFrame) -> DataFrame:
    """``bucket``: those with several members, and of those with the same members one, since near copies share most of theirs.

    ``members`` are distinct. Two hashes of 64 bits, a count and both ends tell sets of them apart.
    """
    mixed = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "node")).alias(f"h{salt}")
    ends = [F.min("node").alias("low"), F.max("node").alias("high"), F.count("node").alias("size")]
    sets = members.groupBy("bucket").agg(*ends, mixed(1), mixed(2)).where("low <> high")
    return sets.groupBy("low", "high", "size", "h1", "h2").agg(F.min("bucket").alias("bucket")).select("bucket")


def across(open_: DataFrame, narrow: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that may be linked, of different components in one of the open buckets.

    ``open_``: ``bucket, node, component``. The members outside a bucket's
    largest component are compared with all of it, piece by piece where it is
    large, see ``dealt``. Members that meet in several buckets are compared in each, but given
    in the first: rows carry the ``FIRST`` least of their member's buckets.
    """
    firsts = open_.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("bucket")), 1, FIRST).alias("firsts"))
    keys = ["bucket", "i", "j"]
    rows = dealt(open_).join(narrow.join(firsts, "node"), "node").select(*keys, "left", "right", "node", "component", "outside", "n", "bits", "firsts")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tiles_met, "a long, b long").distinct()


def dealt(open_: DataFrame) -> DataFrame:
    """``bucket, node, component, outside, i, j, left, right``: each member of the open buckets once for every tile ``i, j`` that it goes to.

    A bucket has as many pieces as the root of its size in ``TILE``, so a member
    goes to fewer tiles than that twice over, and a tile holds some ``TILE`` times that root.
    """
    sizes = open_.groupBy("bucket", "component").count().groupBy("bucket").agg(
        F.max_by("component", F.struct("count", "component")).alias("largest"), F.sum("count").alias("size"), (F.sum("count") - F.max("count")).alias("rest")
    )
    rows = open_.join(sizes.where("rest > 0"), "bucket").withColumn("outside", F.col("component") != F.col("largest"))
    # pieces of those outside meet pieces of all
    last = lambda column: (F.ceil(F.sqrt(F.col(column) / TILE)) - 1).cast("int")
    place = lambda column: F.pmod(F.xxhash64("node"), last(column) + 1).cast("int")
    tile = lambda i, j, left, right: F.struct(i.alias("i"), j.alias("j"), left.alias("left"), right.alias("right"))
    outside = F.col("outside")
    lefts = F.transform(F.sequence(F.lit(0), last("size")), lambda j: tile(place("rest"), j, F.lit(True), j == place("size")))
    rights = F.transform(F.sequence(F.lit(0), last("rest")), lambda i: tile(i, place("size"), F.lit(False), F.lit(True)))
    tiles = F.concat(F.filter(lefts, lambda t: outside), F.filter(rights, lambda t: ~outside | (t["i"] != place("rest"))))
    return rows.select("bucket", "node", "component", "outside", F.explode(tiles).alias("t")).select("bucket", "node", "component", "outside", "t.*")


def tiles_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that may be linked of each tile: rows of ``left`` against those of ``right``. Tiles come one after the other."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        starts = tile_starts(held)
        if len(starts) > 1:
            yield from met(held.slice(0, int(starts[-1])), starts[:-1])
            held = held.slice(int(starts[-1]))
    if held is not None and len(held):
        yield from met(held, tile_starts(held))


def tile_starts(rows: pa.Table) -> np.ndarray:
    keys = [rows.column(c).to_numpy() for c in ("bucket", "i", "j")]
    return np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))) if len(rows) else np.zeros(0, np.int64)


def met(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    node, n, component = (rows.column(c).to_numpy() for c in ("node", "n", "component"))
    left, right, outside = (rows.column(c).to_numpy().astype(bool) for c in ("left", "right", "outside"))
    bits = rows.column("bits").combine_chunks()
    size = pc.list_value_length(bits).to_numpy().astype(np.int64)
    begin, flat = np.cumsum(size) - size, bits.flatten().to_numpy().view(U)
    bucket, firsts = rows.column("bucket").to_numpy(), rows.column("firsts").combine_chunks()
    ends = np.concatenate((starts[1:], [len(node)]))
    x, y = np.flatnonzero(left), np.flatnonzero(right)
    tile = np.searchsorted(starts, x, side="right") - 1
    # each row of x meets the rows y[first : first + many] of its tile
    first = np.searchsorted(y, starts)[tile]
    many = np.searchsorted(y, ends)[tile] - first
    upto = np.cumsum(many)
    cuts = np.searchsorted(upto, np.arange(250_000, int(upto[-1]) if len(upto) else 0, 250_000))
    for some in np.split(np.arange(len(x)), np.unique(cuts)):
        if not len(some):
            continue
        met_ = many[some]
        at = np.repeat(x[some], met_)
        to = y[np.arange(len(at)) + np.repeat(first[some] - (np.cumsum(met_) - met_), met_)]
        near = 100 * np.minimum(n[at], n[to]) >= SIMILAR * np.maximum(n[at], n[to])
        # two members that are both outside meet twice; the second time doesn't count
        near &= (component[at] != component[to]) & (~outside[to] | (node[at] < node[to]))
        pairs = np.column_stack([at[near], to[near]])
        pairs = pairs[~unlike(pairs, n, begin, size, flat)]
        pairs = pairs[~met_before(pairs, bucket, firsts)]
        if len(pairs):
            both = np.unique(np.sort(node[pairs], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def met_before(pairs: np.ndarray, bucket: np.ndarray, firsts: pa.ListArray) -> np.ndarray:
    """Which pairs of rows share a bucket before this one, as far as ``firsts`` tell; they are given there."""
    out = np.zeros(len(pairs), bool)
    for k in range(0, len(pairs), 4096):
        some = pairs[k : k + 4096]
        x, y = (padded(firsts.take(pa.array(some[:, side]))) for side in (0, 1))
        earlier = x < bucket[some[:, 0]][:, None]
        out[k : k + 4096] = (earlier[:, :, None] & (x[:, :, None] == y[:, None, :])).any(axis=(1, 2))
    return out


def padded(lists: pa.ListArray) -> np.ndarray:
    """Sorted lists, none empty, as rows of one length; the last value fills up."""
    size = pc.list_value_length(lists).to_numpy().astype(np.int64)
    begin = np.cumsum(size) - size
    return lists.flatten().to_numpy()[begin[:, None] + np.minimum(np.arange(size.max(initial=1))[None, :], size[:, None] - 1)]


def unlike(pairs: np.ndarray, n: np.ndarray, begin: np.ndarray, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Which pairs can't be linked, since more parities differ than shingles of a linked pair may; never a linked one.

    Parities of row ``i`` are ``flat[begin[i]:][:size[i]]``; sizes are powers of two, and the wider are folded.
    """
    apart = np.zeros(len(pairs), np.int64)
    widths = size[pairs]
    for a, b in np.unique(widths, axis=0):
        chosen = np.flatnonzero((widths == (a, b)).all(axis=1))
        for some in np.array_split(chosen, len(chosen) * int(max(a, b)) // 1_000_000 + 1):
            x, y = (flat[begin[pairs[some, side]][:, None] + np.arange(width)[None, :]] for side, width in ((0, a), (1, b)))
            while x.shape[1] != y.shape[1]:
                if x.shape[1] < y.shape[1]:
                    x, y = y, x
                half = x.shape[1] // 2
                x = x[:, :half] ^ x[:, half:]
            apart[some] = np.bitwise_count(x ^ y).sum(axis=1)
    return (100 + SIMILAR) * apart > (100 - SIMILAR) * n[pairs].sum(axis=1)
