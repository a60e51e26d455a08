"""Operators that judge each text by itself: toxicity, quality, codec, language, benchmark items."""

from __future__ import annotations

import hashlib
import random
import struct
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopgauge.llm import bpe, decontaminate, langid, quality, queries, toxicity
from shopgauge.llm.common import hashed_below, remainder

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " \n\t ",
    "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>",
    "ΑΣ Σ ς İstanbul éa ́x ﬁ Å",
    "aaaaaaa aaaaaa don't it's WE'LL 'd",
    "１２３ ½ ٣ 日本語 😀😀 👍🏽",
    "\x00\x01 a\x00b \x1ca\x1db \x85x\xa0y q​",
    "x" * 30_000,
    "the cat. " * 3_000,
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(k, x) for k, x in enumerate([*ODD, ODD[5], ODD[5]])] + [(None, "no id"), (3, ODD[5])], "doc_id long, text string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def digest(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def test_codec_equals_library(docs, odd):
    library = Tokenizer.from_file(BPE)
    rows = docs.select("doc_id", "text").unionByName(odd)
    expected = Counter()
    for r in rows.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[(r.doc_id, len(ids), digest(struct.pack(f"<{len(ids)}I", *ids)), digest(decoded.encode()))] += 1
    assert Counter(map(tuple, bpe.digests(rows, BPE).collect())) == expected


def test_codec_equals_library_on_all_characters():
    library, codec = Tokenizer.from_file(BPE), bpe.Codec(BPE)
    every = [chr(i) for i in range(0x30000) if not 0xD800 <= i <= 0xDFFF]
    texts = [f"a{x}b{x}{x} {x}" for x in every]
    for at in range(0, len(texts), 8192):
        part = texts[at : at + 8192]
        for got, want in zip(codec.encode(part), library.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == want.ids


def test_codec_columns(spark, odd):
    own = odd.where("doc_id < 6").withColumn("ids", F.lit("taken")).withColumn("decoded", F.lit(1))
    back = bpe.decode(bpe.encode(own, BPE), BPE)
    assert set(back.columns) == {"doc_id", "text", "ids", "decoded"}
    rows = {(r.doc_id, r.text): r for r in back.collect()}
    assert bytes(rows[0, None].ids) == b"" and rows[0, None].decoded == ""
    assert bpe.digests(odd.limit(0), BPE).collect() == []


def brute_repeats(words: list[bytes]) -> int:
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = Counter(windows)
    return len({k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(3)})


def test_quality_base_counts(docs, odd):
    rows = docs.select("doc_id", "text").unionByName(odd)
    field = quality.Field([0.0] * len(quality.FEATURES), [[0.0, 0.0], [0.0, 0.0]])
    expected = Counter()
    for r in rows.collect():
        text = r.text or ""
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        n, again = len(words), brute_repeats(words)
        failed = n < 50 or 100 * again > 50 * n
        counts = (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again)
        expected[(r.doc_id, *counts, failed, not failed)] += 1
    judged = quality.judge(rows, field, ["doc_id"]).drop("content_share")
    assert Counter(map(tuple, judged.collect())) == expected


def test_viterbi_is_the_best_path():
    rng = random.Random(5)
    for _ in range(200):
        weights = [rng.uniform(-2, 2) for _ in quality.FEATURES]
        steps = [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)]
        lines = [(1, tuple(rng.sample(range(len(weights)), 3))) for _ in range(rng.randint(1, 8))]

        def score(labels, lines=lines, weights=weights, steps=steps):
            return sum(weights[k] for y, (_, f) in zip(labels, lines, strict=True) if y for k in f) + sum(steps[a][b] for a, b in zip(labels, labels[1:], strict=False))

        every = [[(n >> k) & 1 for k in range(len(lines))] for n in range(1 << len(lines))]
        assert score(quality.Field(weights, steps).decode(lines)) == pytest.approx(max(map(score, every)))


def test_quality_follows_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = queries.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    right = counts.get((0, False), 0) + counts.get((1, True), 0)
    assert right / sum(counts.values()) > 0.97


def test_quality_learns_from_whole_texts(spark):
    # the kinds differ behind line 300 only, for 5 to 7 stretches of 64 lines and for 11 of 32
    same = [f"Line {k} of the text that all have in common." for k in range(300)]
    tails = {0: [f"BUY {k} !!!! $$$$" for k in range(30)], 1: [f"The end has more to say about {k} than that." for k in range(30)]}
    rows = [(k, "\n".join([*same, *tails[k % 2]])) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    field = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    weight = dict(zip(quality.FEATURES, field.weights, strict=True))
    assert weight["shouts more"] < -0.1 and weight["symbols -1"] < -0.1


def test_quality_gradient_leads_to_the_maximum():
    # by enumeration: at the weights found, no feature or step is expected more or less often than the labels have it
    rng = random.Random(5)
    stretches = [[1 << rng.randrange(3) | 1 << 3 + rng.randrange(2) for _ in range(rng.randint(1, 4))] for _ in range(40)]
    labels = [rng.randint(0, 1) for _ in stretches]
    field = quality.train(stretches, labels, rounds=1500)
    n, gap = sum(map(len, stretches)), Counter()
    for lines, label in zip(stretches, labels, strict=True):
        every = [tuple((m >> k) & 1 for k in range(len(lines))) for m in range(1 << len(lines))]
        held = lambda ys: Counter([f for y, x in zip(ys, lines, strict=True) if y for f in range(5) if x >> f & 1] + [*zip(ys, ys[1:], strict=False)])  # noqa: B023, E731
        score = lambda ys: sum((field.weights[f] if isinstance(f, int) else field.steps[f[0]][f[1]]) * m for f, m in held(ys).items())  # noqa: B023, E731
        p = np.exp([score(ys) for ys in every])
        for ys, share in zip(every, p / p.sum(), strict=True):
            for f, m in held(ys).items():
                gap[f] += m * ((ys == (label,) * len(lines)) - share) / n
    for f, x in gap.items():
        assert x == pytest.approx(1e-4 * (field.weights[f] if isinstance(f, int) else field.steps[f[0]][f[1]]), abs=1e-3)


def test_quality_without_labels_keeps_all(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    own = docs.withColumn("kept", F.lit("clash"))
    judged = quality.judge(own, quality.fit(docs, none), own.columns)
    assert judged.where("not kept and not base_failed").isEmpty() and "lang" in judged.columns
    assert quality.judge(own.limit(0), quality.fit(docs.limit(0), none), own.columns).isEmpty()


def test_fold():
    assert toxicity.fold("1d10T idі​ot w0rthle55$$$ 2024 ＩＤＩＯＴ é") == "idiot idiot worthless$$$ 2024 idiot é"


def test_fold_each_sign_alone():
    for sign, letter in toxicity.LOOK_ALIKE.items():
        assert toxicity.fold(f"x{sign}y é") == f"x{toxicity.DIGITS.get(letter, letter)}y é"
    for sign in map(chr, range(0x80, 0x10000)):
        if toxicity.INVISIBLE.fullmatch(sign):
            assert toxicity.fold(f"id{sign}iot") == "idiot"
    assert toxicity.fold("\u0131d\u0131ot id\u00adiot a\u017f\u017f \U0001d408DIOT") == "idiot idiot ass idiot"


def test_fold_long_runs_of_digits():
    step = toxicity.re.compile(r"[0134578](?=[^\W\d_])|(?<=[^\W\d_])[0134578]|[@$!](?=[^\W\d_])")
    rng = random.Random(6)
    for text in ["sh00000t", "$$$$$hit", *("".join(rng.choices("ab 0135@$!2", k=12)) for _ in range(3000))]:
        slow, last = text, None
        while slow != last:
            slow, last = step.sub(lambda m: toxicity.DIGITS[m[0]], slow), slow
        assert toxicity.fold(text) == slow
    assert toxicity.fold("1" * 300_000 + " x" + "0" * 300_000) == "1" * 300_000 + " x" + "o" * 300_000


def test_matches_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot ": 3.0, "mor": 2.0}, ["not idiot"], (1.0, 0.0, 0.0))
    matcher = toxicity.Matcher(lexicon)
    assert matcher.spans("idiot idiots anidiot moron amor not idiot") == {0: 3.0, 21: 2.0}
    assert toxicity.Matcher(toxicity.Lexicon()).score("idiot") == pytest.approx(1 / (1 + np.exp(2)))


def test_scores_do_not_depend_on_the_dealing(spark, monkeypatch):
    """One index or many: the same items, scores and overlaps."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = []
    for size in (16_000_000, 300):
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", size)
        monkeypatch.setattr(decontaminate.indexes, "__defaults__", (size,))
        rows = decontaminate.flag(docs, items).where(F.size("leaks") > 0).select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.item_id", "l.score")
        found.append({(r.doc_id, r.item_id): round(r.score, 9) for r in rows.collect()})
    assert found[0] and found[0] == found[1]


def test_exceptions_are_merged_in_one_pass():
    rng = random.Random(8)
    for _ in range(300):
        found = {rng.randint(0, 60): 1.0 for _ in range(rng.randint(0, 20))}
        spans = [(a, a + rng.randint(0, 8)) for a in rng.choices(range(60), k=rng.randint(0, 6))]
        expected = {a: w for a, w in found.items() if not any(x <= a <= y for x, y in spans)}
        assert toxicity.uncovered(dict(found), spans) == expected
    matcher = toxicity.Matcher(toxicity.Lexicon({"idiot ": 3.0}, ["not idiot"], (1.0, 0.0, 0.0)))
    began = time.perf_counter()
    assert matcher.judge("not idiot idiot " * 100_000)[1] == 100_000 and time.perf_counter() - began < 20


def test_long_words_and_all_matches_count(spark):
    long = "x" * 60
    lexicon = toxicity.Lexicon({long + " ": 0.5}, [], (1.0, 0.0, -9.0))
    rows = spark.createDataFrame([(1, f"{long} {long}"), (2, long + "y"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.predicted, r.n_matches) for r in toxicity.score(rows, lexicon, ["doc_id"]).collect()}
    assert got == {1: (0, 2), 2: (0, 0), 3: (0, 0)}
    assert long + " " in toxicity.terms(f"a {long}")


def test_language_counts_kept_grams_in_every_language(spark, monkeypatch):
    """A word that is kept for one language has its count in the other too, though it ranks lower there."""
    monkeypatch.setattr(langid, "WORDS", 1)
    rows = [(k, "aa", "common common rare") for k in range(4)] + [(10 + k, "bb", "own own own common") for k in range(4)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert set(model.words) == {"common", "own"}
    total = {"aa": 12, "bb": 16}
    many = {"common": {"aa": 8, "bb": 4}, "own": {"aa": 0, "bb": 12}}
    for word, by in many.items():
        expected = [np.log((by[x] + 0.5) / (total[x] + 1.0)) for x in ("aa", "bb")]
        assert model.words[word] == pytest.approx(expected, abs=1e-5)


def test_toxicity_by_brute_force(spark, docs, odd):
    lexicon = toxicity.Lexicon({"idiot ": 3.0, "tra": 1.5, "clown ": 2.0}, [], (2.0, 1.0, -1.0))
    rows = docs.select("doc_id", "text").unionByName(odd)
    for r in toxicity.score(rows, lexicon, ["doc_id", "text"]).collect():
        folded = toxicity.fold(r.text or "")
        weight = sum({"idiot": 3.0, "clown": 2.0}.get(w, 1.5 if w.startswith("tra") else 0) for w in toxicity.TOKEN.findall(folded))
        x = np.log1p(weight / np.sqrt(1 + folded.count(" "))) if weight else 0.0
        assert r.score == pytest.approx(1 / (1 + np.exp(-(2 * x + np.log1p(weight) - 1))))
        assert r.predicted == int(r.score >= 0.5)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("toxic", "predicted").collect()
    found = Counter(map(tuple, rows))
    assert found[1, 1] / (found[1, 1] + found[1, 0]) > 0.85 and found[0, 1] / (found[0, 0] + found[0, 1]) < 0.01


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, none), ["doc_id"])
    assert scored.select("score").distinct().count() == 1
    assert toxicity.score(docs.limit(0), toxicity.Lexicon(), ["doc_id"]).isEmpty()


def test_held_out_rule(docs):
    for r in docs.select("doc_id", remainder("doc_id", 5).alias("a"), remainder("doc_id", 4).alias("b")).limit(50).collect():
        assert (r.a, r.b) == (zlib.crc32(str(r.doc_id).encode()) % 5, zlib.crc32(str(r.doc_id).encode()) % 4)
    assert abs(docs.where(hashed_below("doc_id", 0.5)).count() / docs.count() - 0.5) < 0.15


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    said = queries.op10_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = said.where("held_out").select((F.col("lang") == F.col("lang_pred")).alias("ok"), "score").collect()
    assert sum(r.ok for r in rows) / len(rows) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_language_backs_off(spark, docs):
    model = langid.fit(docs)
    known = next(iter(model.words))
    assert (langid.score_word(model, known) == model.words[known]).all()
    unknown = known + known + "zq"
    longest = max(n for n in range(1, 6) if any(g in model.grams[n - 1] for g in langid.grams_of(unknown, n)))
    parts = [model.grams[longest - 1][g] for g in langid.grams_of(unknown, longest) if g in model.grams[longest - 1]]
    assert np.allclose(langid.score_word(model, unknown), np.mean(parts, axis=0) - (langid.LONGEST - longest))


def test_language_reads_long_runs_whole(spark):
    # training texts are runs of over 40 letters; the text to judge begins like language a and goes on like b
    rng = random.Random(3)
    run = lambda letters, n: "".join(rng.choices(letters, k=n))
    rows = [(k, run("日本語文" if k % 2 else "中国汉字", 200), "b" if k % 2 else "a") for k in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = run("中国汉字", 60) + run("日本語文", 600)
    assert [x for x, _ in langid.Scorer(model)([text, text[:50], text[60:]])] == ["b", "a", "b"]
    assert model.languages[langid.score_word(model, text).argmax()] == "b"
    for n in range(1, langid.LONGEST + 1):
        assert [g for p in langid.pieces(text) for g in langid.grams_in(p, n)] == langid.grams_of(text, n)


def test_language_edges(spark, odd, docs):
    said = {r.doc_id: r.lang_pred for r in langid.predict(odd.where("doc_id in (0, 1, 2)"), langid.fit(docs), ["doc_id"]).collect()}
    assert said == {0: "und", 1: "und", 2: "und"}
    digits = spark.createDataFrame([(1, "12 ½ ² ..."), (2, "le a")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    assert [r.lang_pred for r in langid.predict(digits, langid.fit(docs), digits.columns).orderBy("doc_id").collect()][0] == "und"
    nothing = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert [r.lang_pred for r in langid.predict(digits, nothing, ["doc_id"]).collect()] == ["und", "und"]
    assert langid.predict(odd.limit(0), nothing, ["doc_id"]).isEmpty()


def test_block_max_wand_finds_all_above_the_threshold():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(2, 25)))) for k in range(70)]
    index = decontaminate.Index(items)
    for _ in range(300):
        query = sorted(rng.sample(range(len(index.term)), rng.randint(1, 40)))
        scores = Counter()
        for k in query:
            for d, x in index.postings[k]:
                scores[d] += x
        for threshold in (0.2, 0.5, 0.8):
            got = index.search(query, threshold)
            assert sorted(d for d, _ in got) == sorted(d for d, x in scores.items() if x >= threshold - 1e-9)
            assert all(abs(scores[d] - x) < 1e-9 for d, x in got)


def test_decontamination_finds_planted_items(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = {r.item_id: " ".join(decontaminate.tokens(r.text)) for r in items.collect()}
    more = [(10_000 + k, f"some words before it {x.text} and behind") for k, x in enumerate(items.collect())]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more + [(1, None), (2, "")], "doc_id long, text string"))
    expected = {(r.doc_id, i) for r in rows.collect() if r.text for i, x in plain.items() if x in " ".join(decontaminate.tokens(r.text))}
    flagged = decontaminate.flag(rows.withColumn("leaks", F.lit(0)), items.withColumn("text", F.when(F.col("item_id") >= 0, F.col("text"))))
    assert {(r.doc_id, x.item_id) for r in flagged.collect() for x in r.leaks} == expected
    assert len(expected) >= 40 and flagged.count() == rows.count()


def test_decontamination_leaves_parts_alone(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, " ")], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, "one two three four five six"), (3, "nine ten eleven twelve"), (4, item[::-1])], "doc_id long, text string")
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in decontaminate.flag(docs, items).collect()}
    assert found == {1: [1, 2], 2: [], 3: [], 4: []}
    assert decontaminate.clean(docs, items.limit(0)).count() == 4 and decontaminate.clean(docs.limit(0), items).isEmpty()


def test_several_indexes(spark):
    items = spark.createDataFrame([(k, f"alpha{k} beta{k} gamma{k} delta{k} epsilon{k}") for k in range(40)], "item_id long, text string")
    assert len(list(decontaminate.indexes(items, 200))) > 3
    docs = spark.createDataFrame([(k, f"x alpha{k} beta{k} gamma{k} delta{k} epsilon{k} y") for k in range(40)], "doc_id long, text string")
    size, decontaminate.indexes.__defaults__ = decontaminate.indexes.__defaults__, (200,)
    try:
        found = {(r.doc_id, x.item_id) for r in decontaminate.flag(docs, items).collect() for x in r.leaks}
    finally:
        decontaminate.indexes.__defaults__ = size
    assert found == {(k, k) for k in range(40)}


def test_question_and_answer():
    assert decontaminate.parts("What is it? Answer: a b") == (["what", "is", "it"], ["a", "b"])
    assert decontaminate.parts("a b c d e f g h i j k l") == (list("abcdefghi"), list("jkl"))
    assert decontaminate.parts(None) == ([], [])
