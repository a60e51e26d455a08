"""Ranked search, whitening and the chosen-path join."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from shopgauge.llm import chosen_path, jaccard, queries, search, whitening

SF = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"

# ranked search


def brute_rank(docs, items, k):
    """The ranking by the definition, in whole numbers."""

    def terms(text):
        found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]

    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 25 + (75 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


ODD_DOCS = [
    (1, "Red fox, red FOX and blue\x00hen"), (2, "red fox"), (3, "red fox"), (4, None), (5, ""), (6, "..."),
    (7, "éclair Éclair ÉCLAIR 12e5"), (8, "hen " * 5000), (8, "hen " * 5000), (None, "red fox"), (9, "x" * 100_000 + " fox"),
]
ODD_ITEMS = [(1, "RED fox fox"), (2, None), (3, ""), (4, "unknown words"), (5, "Éclair hen"), (5, "blue"), (None, "hen"), (6, "red " * 3000)]


@pytest.mark.parametrize("entries, terms, docs", [(200_000, 1024, 1024), (2, 1, 2)])
def test_search_equals_brute_force(spark, monkeypatch, entries, terms, docs):
    monkeypatch.setattr(search, "ENTRIES", entries)
    monkeypatch.setattr(search, "TERMS", terms)
    monkeypatch.setattr(search, "DOCS", docs)
    d = spark.createDataFrame(ODD_DOCS, DOCS).withColumn("item_id", F.lit(0)).withColumn("n", F.lit("clash"))
    i = spark.createDataFrame(ODD_ITEMS, ITEMS).withColumn("doc_id", F.lit(7)).withColumn("score", F.lit(1))
    for k in (1, 3, 10):
        got = sorted((tuple(r) for r in search.rank(d, i, k).collect()), key=repr)
        assert got == brute_rank(ODD_DOCS, ODD_ITEMS, k)


def test_search_of_empty_tables(spark):
    d, i = spark.createDataFrame(ODD_DOCS, DOCS), spark.createDataFrame(ODD_ITEMS, ITEMS)
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.where("text = '...'"), i)):
        empty = search.rank(a, b)
        assert empty.isEmpty() and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_tiles_stay_exact():
    """No item's weights in a tile may reach 2^53 times the largest impact, and none gets lost."""
    rng = random.Random(1)
    heavy = [(item, term, rng.choice([1, 10**6, 10**10, 10**12])) for item in range(5) for term in range(40)]
    made = search.tiles(heavy, 10**6)
    total = Counter()
    for terms, item, at, weight in made:
        assert len(terms) <= search.TERMS and list(terms) == sorted(set(terms))
        for k in set(item.tolist()):
            assert int(weight[item == k].sum()) * 10**6 < 1 << 53
        for i, a, w in zip(item.tolist(), at.tolist(), weight.tolist(), strict=True):
            total[i, int(terms[a])] += int(w)
    assert total == Counter({(i, t): w for i, t, w in heavy})


def test_search_matches_sql(spark):
    assert difference(queries.queries()["op11_search"](spark, SF), connect(SF), queries.oracle_sql()["op11_search"]) is None


# whitening


def brute_whiten(rows, k):
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    c = fit - total / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1][:, :k]
    return n, ((n * x - total) ** 2).sum(axis=1), (x - total / n) @ axes / np.sqrt(values[:k]), values[:k] / values.sum()


def compare_whitened(got, rows, k):
    n, deviation, whitened, explained = brute_whiten(rows, k)
    made = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-9
        made.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    assert {i for i, _ in made} == {i for i, _ in rows}
    for c in range(k):
        ours = np.array([made[i, int(d)][c + 1] for (i, _), d in zip(rows, deviation, strict=True)])
        assert min(np.abs(ours - whitened[:, c]).max(), np.abs(ours + whitened[:, c]).max()) < 1e-6


@pytest.mark.parametrize("rows_, columns, blocks", [(1024, 1024, 8), (7, 3, 2)])
def test_whitening_equals_numpy(spark, monkeypatch, rows_, columns, blocks):
    monkeypatch.setattr(whitening, "ROWS", rows_)
    monkeypatch.setattr(whitening, "COLUMNS", columns)
    monkeypatch.setattr(whitening, "BLOCKS", blocks)
    rng = np.random.default_rng(3)
    rows = [(k, [float(v) for v in rng.normal(size=8) * np.arange(1, 9)]) for k in range(60)]
    rows += [(100 + k, rows[0][1]) for k in range(40)]  # copies count once in the fit
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'clash' AS x", "0 AS component", "1 AS index")
    compare_whitened(whitening.whiten(df, 5).collect(), rows, 5)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, -inf]), (7, [1e30, 1.0]), (8, [1.0, 2.0, 3.0])]
    good = [(None, [1.0, 2.0]), (9, [0.5, -1.0]), (9, [0.5, -1.0]), (10, [3.0, 0.0]), (11, [2.5, 7.25])]
    schema = "vec_id long, embedding array<float>"
    got = whitening.whiten(spark.createDataFrame(odd + good, schema), 16).collect()
    assert len(got) == 2 * len(good) and {r.component for r in got} == {1, 2}
    assert Counter(r.vec_id for r in got) == Counter({None: 2, 9: 4, 10: 2, 11: 2})
    compare_whitened(got, good, 2)
    flat = [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])]  # the second entry doesn't vary
    assert {r.component for r in whitening.whiten(spark.createDataFrame(flat, schema), 16).collect()} == {1}
    for few in (good[:1], [good[0]] * 3, odd, []):
        assert whitening.whiten(spark.createDataFrame(few, schema)).isEmpty()


def test_whitening_query(spark):
    df = queries.queries()["op12_whitening"](spark, SF)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare_whitened(df.collect(), rows, 16)


# the chosen-path join


def brute_links(docs):
    """Set sizes and components by comparing all with all."""
    low = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    sets = []
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append((i, {tuple(words[k : k + 2]) for k in range(max(1, len(words) - 1))} if words else set()))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if None not in (i, j) and s and t and 100 * len(s & t) >= 80 * len(s | t):
                u, v = sorted((find(i), find(j)))
                root[v] = u
    return sorted((str(i), len(s), i if i is None else find(i)) for i, s in sets)


def rows_of(df):
    out = df.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out)
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in out)


def variants(rng, n, edits, base=None):
    """Texts that differ from one text in up to ``edits`` words."""
    base = base or [f"w{rng.randint(0, 9999)}" for _ in range(120)]
    out = [" ".join(base)]
    for _ in range(n):
        own = list(base)
        for k in rng.sample(range(len(own)), rng.randint(1, edits)):
            own[k] = f"v{rng.randint(0, 9999)}"
        out.append(" ".join(own))
    return out


def test_chosen_path_equals_brute_force(spark):
    rng = random.Random(5)
    texts = [t for _ in range(12) for t in variants(rng, 6, 12)] + variants(rng, 60, 14)
    rng.shuffle(texts)
    odd = ["A b", "a B", "a", "A", "", None, " \t\n", "a b a b a b", "word " * 20_000, "WORD " * 300]
    docs = list(enumerate(texts + odd))
    docs += [(None, texts[0]), (None, None), (5, texts[5]), (5, texts[40]), (900, texts[40]), (901, "a b a b")]
    df = spark.createDataFrame(docs, DOCS).withColumn("node", F.lit("clash")).withColumn("n", F.lit(0))
    assert rows_of(chosen_path.near_duplicates(df)) == brute_links(docs)


def test_chosen_path_of_large_nodes(spark, monkeypatch):
    """Nodes that branching doesn't take apart, among documents that share a passage, compared in pieces."""
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(60)]
    texts = variants(rng, 70, 13)
    texts += [" ".join([*passage, *(f"q{rng.randint(0, 99999)}" for _ in range(60))]) for _ in range(60)]
    docs = list(enumerate(texts))
    assert rows_of(chosen_path.near_duplicates(spark.createDataFrame(docs, DOCS))) == brute_links(docs)


def test_spanning_pairs_join_what_passing_pairs_join():
    rng = np.random.default_rng(1)
    for n in (2, 5, 40):
        may = np.triu(rng.random((n, n)) < 1.5 / n, 1)
        may = may | may.T
        pairs, hub = chosen_path.spanning(may)
        assert all(may[v, w] for v, w in pairs) and may[hub].sum() == may.sum(axis=1).max()
        near = np.eye(n, dtype=int)
        for v, w in pairs:
            near[v, w] = near[w, v] = 1
        a, b = (may | np.eye(n, dtype=bool)).astype(float), near.astype(float)
        for _ in range(8):
            a, b = (a @ a > 0).astype(float), (b @ b > 0).astype(float)
        assert (a == b).all()


def test_parities_never_rule_out_a_linked_pair():
    rng = np.random.default_rng(9)
    sets = []
    for n in (3, 30, 60, 64, 66, 130, 250, 270):
        base = rng.integers(0, 1 << 62, n).astype(np.uint64)
        sets += [np.unique(np.concatenate([base[: n - k], rng.integers(0, 1 << 62, k).astype(np.uint64)])) for k in range(0, n // 3, 1 + n // 40)]
    bits = [chosen_path.sketch(s) for s in sets]
    size = np.array([len(b) for b in bits])
    begin, flat, n = np.cumsum(size) - size, np.concatenate(bits).view(np.uint64), np.array([len(s) for s in sets])
    pairs = np.array([(a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b])
    ruled = chosen_path.unlike(pairs, n, begin, size, flat)
    for (a, b), out in zip(pairs.tolist(), ruled.tolist(), strict=True):
        both = len(np.intersect1d(sets[a], sets[b]))
        assert not (out and 100 * both >= 80 * (n[a] + n[b] - both))
    assert ruled.mean() > 0.7


def test_chosen_path_of_an_empty_table(spark):
    empty = chosen_path.near_duplicates(spark.createDataFrame([], DOCS))
    assert empty.isEmpty() and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


# what is left of a similarity join


def open_buckets(spark, sets, component=None):
    rows = [(b, v, (component or {}).get(v, v)) for b, s in sets.items() for v in s]
    nodes = sorted({v for s in sets.values() for v in s})
    narrow = spark.createDataFrame([(v, 10, [0]) for v in nodes], "node long, n long, bits array<long>")
    return spark.createDataFrame(rows, "bucket long, node long, component long"), narrow


def test_only_members_of_one_bucket_are_compared(spark):
    """Buckets that make a chain don't make all of it meet."""
    chain = {k: {k, k + 1} for k in range(40)}
    open_, narrow = open_buckets(spark, chain)
    found = sorted((r["a"], r["b"]) for r in jaccard.across(open_, narrow).collect())
    assert found == [(k, k + 1) for k in range(40)]


@pytest.mark.parametrize("tile", [4, 1024])
def test_large_buckets_are_compared_whole_in_pieces(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    sets = {1: set(range(30)), 2: set(range(20, 33)), 3: {1, 2}, 4: {1, 2}}
    component = {v: 100 for v in range(9)} | {v: 200 for v in range(25, 31)}
    open_, narrow = open_buckets(spark, sets, component)
    label = lambda v: component.get(v, v)
    wanted = sorted({(v, w) for s in sets.values() for v in s for w in s if v < w and label(v) != label(w)})
    assert sorted((r["a"], r["b"]) for r in jaccard.across(open_, narrow).collect()) == wanted


def test_of_buckets_with_the_same_members_one_is_kept(spark):
    sets = {1: {5, 6, 7}, 2: {5, 6, 7}, 3: {5, 7}, 4: {5, 8, 7}, 5: {9}, 6: {5, 7}}
    open_, _ = open_buckets(spark, sets)
    assert sorted(r["bucket"] for r in jaccard.unlike_buckets(open_).collect()) == [1, 3, 4]


def test_a_pair_is_given_in_the_first_bucket_it_shares():
    firsts = pa.array([[3, 5, 9], [5, 9], [9], [1, 9]], pa.list_(pa.int64()))
    pairs = np.array([[0, 1], [1, 2], [0, 3], [1, 0]])
    at = lambda b: jaccard.met_before(pairs, np.full(4, b), firsts).tolist()
    assert at(9) == [True, False, False, True] and at(5) == [False] * 4
    assert not len(jaccard.met_before(np.zeros((0, 2), np.int64), np.zeros(4, np.int64), firsts))


def test_rows_dealt_of_a_bucket_grow_slower_than_its_square(spark, monkeypatch):
    """Every pair that counts meets in one tile, though a bucket four times as large has eight to nine times the rows."""
    monkeypatch.setattr(jaccard, "TILE", 4)
    rows = {}
    for size in (64, 256):
        component = {v: 1000 for v in range(size // 2, size)} if size == 64 else {}
        open_, _ = open_buckets(spark, {1: set(range(size))}, component)
        tiles = {}
        dealt = jaccard.dealt(open_).collect()
        for r in dealt:
            tiles.setdefault((r.i, r.j), []).append(r)
        met = Counter(frozenset((x.node, y.node)) for t in tiles.values() for x in t if x.left for y in t if y.right and x.component != y.component)
        label = lambda v: component.get(v, v)  # noqa: B023, E731
        assert set(met) == {frozenset((v, w)) for v in range(size) for w in range(v) if label(v) != label(w)}
        assert len(dealt) == len({(r.i, r.j, r.node) for r in dealt})
        rows[size] = len(dealt)
    open_, _ = open_buckets(spark, {1: set(range(64))})
    assert rows[256] < 9 * jaccard.dealt(open_).count()


def test_members_of_dense_nodes_are_compared_in_one_place(spark, monkeypatch):
    """Those that are left go to the comparison of whole dense nodes, not also to that of pieces."""
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    seen = {"pieces": 0, "dense": 0}
    compare, across = chosen_path.compare, chosen_path.across

    def compare_(groups, every):
        if every:
            seen["pieces"] += groups.where("piece >= 0").count()
        return compare(groups, every)

    def across_(open_, narrow):
        seen["dense"] += open_.count()
        return across(open_, narrow)

    monkeypatch.setattr(chosen_path, "compare", compare_)
    monkeypatch.setattr(chosen_path, "across", across_)
    rng = random.Random(11)
    docs = list(enumerate(variants(rng, 60, 16)))
    assert rows_of(chosen_path.near_duplicates(spark.createDataFrame(docs, DOCS))) == brute_links(docs)
    assert seen["dense"] and not seen["pieces"]
