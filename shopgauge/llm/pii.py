"""Personal data: fixed patterns, and identifiers found by their context.

The fixed patterns give the seeds. Tokens with a digit or an @ stand in contexts,
the words around them; contexts and tokens make a graph. A context is as good as
the tokens it holds, a token as good as its best context, starting from the
seeds, for a few rounds. Tokens in contexts that come out well are sure as seeds
are, and so lead to further contexts. Those that no fixed pattern has found are
added.

Only DataFrame functions are used. Repetitions in the patterns are possessive
wherever that changes no match, so that no text makes them slow or deep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import store, text_of

# The patterns of the base kinds, in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone", "id")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: A token with a digit or an @, from blank to blank.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Shapes of credentials, which count as seeds besides the base kinds.
SHAPES = r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,64})$"
#: Code points of context on either side of a token, and what is known of a match. A word that reaches further is no context.
REACH = 60
SPAN = "struct<start:int,end:int,found:string,left:string,right:string>"
#: Spans in a block while they are gathered.
BLOCK = 64
#: Rounds of scoring, seeds that a context must hold, and the score from which it counts.
ROUNDS, LEAST_SEEDS, CONFIDENT = 3, 5, 0.8


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap: ``start`` and ``end`` in code points, ``found``, and what is around it.

    ``left`` and ``right`` reach over the neighbouring match at most. They come
    from the pieces that the text is cut into, since taking them out of the text
    by position would read it from its beginning for every match.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(found)
    no = F.array(F.lit(""))
    pieces = F.arrays_zip(
        found,
        F.slice(between, 1, n),
        F.slice(between, 2, n),
        F.slice(F.concat(no, found), 1, n),
        F.slice(F.concat(found, no), 2, n),
    )
    steps = F.transform(
        pieces,
        lambda p: F.struct(
            F.length(p["1"]).alias("skip"),
            p["0"].alias("found"),
            F.right(F.concat(F.right(p["3"], F.lit(REACH)), F.right(p["1"], F.lit(REACH))), F.lit(REACH)).alias("left"),
            F.left(F.concat(F.left(p["2"], F.lit(REACH)), F.left(p["4"], F.lit(REACH))), F.lit(REACH)).alias("right"),
        ),
    )

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["skip"]
        end = begin + F.length(x["found"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["found"], x["left"], x["right"])
        return F.struct(end.alias("at"), F.concat(acc["own"], F.array(span)).alias("own"))

    # Each step of an aggregate copies what it has gathered, so places are first
    # counted within short blocks, and then the blocks' beginnings are added.
    def blocks(all_: Column) -> Column:
        count = F.ceil(F.size(all_) / BLOCK).cast("int")
        own = F.transform(F.sequence(F.lit(1), count), lambda i: F.slice(all_, (i - 1) * BLOCK + 1, F.lit(BLOCK)))
        return F.when(count > 0, F.transform(own, lambda x: F.aggregate(x, F.struct(F.lit(0).alias("at"), none().alias("own")), add)))

    def shifted(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
        begins = F.aggregate(
            parts,
            start,
            lambda acc, p: F.struct((acc["at"] + p["at"]).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins")),
            lambda acc: acc["begins"],
        )
        move = lambda s, by: s.withField("start", s["start"] + by).withField("end", s["end"] + by)
        return F.flatten(F.zip_with(parts, begins, lambda p, by: F.transform(p["own"], lambda s: move(s, by))))

    return F.coalesce(let(let(steps, blocks), shifted), none())


def let(x: Column, body) -> Column:
    """``body`` of ``x``, which is worked out once however often the body names it."""
    return F.get(F.transform(F.array(x), body), 0)


def none() -> Column:
    return F.array().cast("array<" + SPAN + ">")


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d - F.when(d > 9, 9).otherwise(0), F.lit(0))) % 10 == 0


def is_card(x: Column) -> Column:
    n = F.length(digits(x))
    return F.when((n >= 14) & (n <= 19), luhn(digits(x))).otherwise(F.lit(False))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds: ``start, kind`` (place in KINDS)``, end``, in that order."""
    kinds = [
        (text.contains("@"), EMAIL, lambda x: F.lit(True)),
        (text.rlike(r"[0-9]\.[0-9]"), IP, lambda x: x.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        (text.rlike(r"(?:[0-9][\x20-]?){14}"), CARD, is_card),
        (text.contains("+"), PHONE, lambda x: F.length(digits(x)).between(10, 15)),
    ]

    def spans(k: int, gate: Column, pattern: str, good) -> Column:
        found = F.filter(F.when(gate, matches(text, pattern)).otherwise(none()), lambda s: good(s["found"]))
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))

    each = [spans(k, *kind) for k, kind in enumerate(kinds)]
    return F.sort_array(F.concat(*each))


def tokens(text: Column) -> Column:
    """Tokens with a digit or an @: ``start`` and ``end`` without signs at either end, ``own``, and the contexts they stand in."""

    def token(s: Column) -> Column:
        signs = r"^[^\p{L}\p{N}]++"
        rest = F.regexp_replace(s["found"], signs, "")
        # an end is looked for from the end: otherwise each sign of a long run would be tried
        core = F.reverse(F.regexp_replace(F.reverse(rest), signs, ""))
        begin = s["start"] + F.length(s["found"]) - F.length(rest)
        # a word at the edge may be cut, so the edge counts as a part of it
        whole = F.when(F.length(s["left"]) < REACH, F.concat(F.lit(" "), s["left"])).otherwise(s["left"])
        left, right = F.lower(whole), F.lower(s["right"])
        mask = lambda c: F.regexp_replace(c, "[0-9]+", "0")
        two = mask(F.regexp_extract(left, r"[\x20\x09-\x0D]([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", 1))
        one = mask(F.regexp_extract(left, r"[\x20\x09-\x0D]([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", 1))
        after = mask(F.regexp_extract(right, r"^[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)[\x20\x09-\x0D]", 1))
        contexts = F.array(
            F.when(two != "", F.concat(F.lit("2 "), two)),
            F.when((one != "") & (after != ""), F.concat(F.lit("1 "), one, F.lit(" _ "), after)),
        )
        return F.struct(begin.alias("start"), (begin + F.length(core)).alias("end"), core.alias("own"), F.array_compact(contexts).alias("contexts"))

    return F.transform(F.when(text.rlike("[0-9@]"), matches(text, TOKEN)).otherwise(none()), token)


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, _row`` (hash of the text), ``base`` spans and ``tokens`` of every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return own.select("doc_id", F.xxhash64("text").alias("_row"), base_spans(F.col("text")).alias("base"), tokens(F.col("text")).alias("tokens"))


def occurrences(measured: DataFrame) -> DataFrame:
    """One row per token: where it is, the token, its contexts, and whether it is a seed or overlaps a base span."""
    each = measured.where(F.size("tokens") > 0).select("doc_id", "_row", "base", F.explode("tokens").alias("t"))
    over = F.exists("base", lambda b: (b["start"] < F.col("t.end")) & (F.col("t.start") < b["end"]))
    shape = F.col("t.own").rlike(SHAPES)
    return each.select(
        "doc_id", "_row", "t.start", "t.end", F.sha2("t.own", 256).alias("token"), "t.contexts", over.alias("over"), (over | shape).alias("seed")
    )


def good_contexts(found: DataFrame, rounds: int = ROUNDS, least: int = LEAST_SEEDS, confident: float = CONFIDENT) -> DataFrame:
    """``context, score`` of those that hold enough sure tokens and score well.

    Edges are counted once for each context and token, merged before the
    shuffle, and written to the shared folder; every round reads them again.
    A context's score is the mean score of its tokens, with one bad token
    added; a token's is the best score among its contexts, 1 for a seed. A
    token of a context that has come out well is sure in the next round, as a
    seed is: so identifiers found in one context lead to others.
    """
    edges = store(
        found.select("token", "seed", F.explode("contexts").alias("context")).groupBy("context", "token").agg(F.max("seed").alias("seed")),
        "pii-edges",
    )
    scored = edges.select("context", "token", F.col("seed").alias("sure"), F.col("seed").cast("double").alias("score"))

    def contexts(of: DataFrame) -> DataFrame:
        good = F.sum("score") / (F.count("*") + 1)
        counted = of.groupBy("context").agg(good.alias("good"), F.count_if("sure").alias("seeds"))
        return counted.withColumn("accepted", (F.col("seeds") >= least) & (F.col("good") >= confident))

    for _ in range(rounds):
        best = edges.join(contexts(scored), "context").groupBy("token").agg(
            F.max("good").alias("best"), F.max(F.col("seed") | F.col("accepted")).alias("sure"), F.max("seed").alias("is_seed")
        )
        score = F.when(F.col("is_seed"), 1.0).otherwise(F.col("best"))
        scored = store(edges.join(best, "token").select("context", "token", "sure", score.alias("score")), "pii-scores")
    return contexts(scored).where("accepted").select("context", F.col("good").alias("score"))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (start, kind, end) of every row.

    ``base`` are the spans of the fixed patterns; ``spans`` has the identifiers
    found by shape or context besides, of kind ``id``, never over a base span.
    Null and empty texts have none. Rows that repeat id and text come out
    alike. An empty table gives an empty one; other columns aren't read.
    """
    measured = store(measure(docs), "pii-spans")
    found = occurrences(measured)
    new = found.where("not over")
    by_shape = new.where("seed").select("doc_id", "_row", "start", "end")
    by_context = (
        new.where("not seed")
        .select("doc_id", "_row", "start", "end", F.explode("contexts").alias("context"))
        .join(good_contexts(found), "context", "left_semi")
        .select("doc_id", "_row", "start", "end")
    )
    span = F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end")
    added = by_shape.unionByName(by_context).groupBy(F.col("doc_id").alias("_id"), F.col("_row").alias("_own")).agg(F.collect_set(span).alias("more"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_own"))
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "more")))
    return measured.drop("tokens").join(added, same, "left").select("doc_id", "base", spans.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
