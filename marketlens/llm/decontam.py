"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens; the ignored positions may
differ between the benchmark and a document. Each mask is a product of gaps, so
its hashes come from pairwise combinations of shifted hash arrays, all in
built-in functions. Benchmark and document hashes are equality-joined; around
every hit the texts are compared along the hit's diagonal for the stretch with
the most equal tokens among those whose share of equal tokens is high enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, unused, whole

TOKEN_BREAK = r"[^\p{L}\p{N}]+"
#: (gaps of a mask, the highest need of items that are sought by it). Offsets
#: are all sums of subsets of the gaps, so (1, 3) reads positions 0 1 3 4.
#: All of them ignore positions: 0 1 3 4 and 0 2 3 5 are sought for every item,
#: 0 1 4 5 for items of 10 tokens or fewer. Together they hit every overlap that
#: counts, from 5 equal tokens on (the first alone does from 10 on; tests try all
#: patterns up to 18 tokens, and patterns of any length by dynamic programming).
#: Items of 5 tokens need 4, which may lie in a row: no mask with an ignored
#: position fits into that, so three tokens in a row are sought for them besides.
MASKS = (((1, 3), None), ((2, 3), None), ((1, 4), 8), ((1, 1), 4))
MIN_MATCHED = 13    # tokens that must agree in the verified overlap,
MIN_SHARE = 0.8     # or this share of the item if that is fewer
MIN_ITEM = 5        # items with fewer tokens match nothing
PENALTY = 4         # equal tokens that each substitution asks for: MIN_SHARE as odds
ROW_BYTES = 64      # at most, of a seed or hit in a broadcast table
BROADCAST_BYTES = 16 << 20


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(whole(text)), TOKEN_BREAK), "")


def _combine(x: Column, gap: int) -> Column:
    """Hash of each entry with the one ``gap`` places on."""
    n = F.greatest(F.size(x) - gap, F.lit(0))
    return F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, F.lit(1 + gap), n), lambda a, b: F.xxhash64(a, b))


def _with_seeds(df: DataFrame, masks) -> DataFrame:
    """Adds ``seed_0``, ``seed_1`` ...: for each mask the hashes by position.
    Masks that begin alike share the work."""
    df = df.withColumn("seed_", F.transform("words", lambda w: F.xxhash64(w)))
    for k, mask in enumerate(masks):
        for i in range(len(mask)):
            name = "seed_" + "_".join(map(str, mask[:i + 1]))
            if name not in df.columns:
                below = "seed_" + "_".join(map(str, mask[:i]))
                df = df.withColumn(name, _combine(F.col(below), mask[i]))
        df = df.withColumn(f"mask{k}", F.col("seed_" + "_".join(map(str, mask))))
    return df


def _breaks(equal: Column) -> Column:
    """Places of the substitutions, between -1 and the length."""
    places = F.array_compact(F.transform(equal, lambda e, i: F.when(~e, i)))
    return F.concat(F.array(F.lit(-1)), places, F.array(F.size(equal)))


def _best_stretch(breaks: Column) -> Column:
    """(bm, bn, bf): equal tokens, length and first place of the stretch with
    the most equal tokens among all that agree in MIN_SHARE; of those the
    shortest, then the first.

    A stretch from behind break r to before break q has q - r - 1 substitutions
    and agrees enough exactly if break_r - 5 r <= break_q - 5 q + PENALTY. With
    the ends sorted by these numbers the first r so far is the best for q."""
    def ends(side: int, beside: int):
        def end(b, i):
            key = b - (PENALTY + 1) * i + PENALTY * side
            # only next to an equal token
            return F.when(F.abs(F.get(breaks, i + beside) - b) > 1,
                          F.struct(key.alias("key"), F.lit(side).alias("side"), i.alias("i"), b.alias("b")))
        return F.array_compact(F.transform(breaks, end))

    zero = F.struct(F.lit(2 ** 31 - 1).alias("r"), *[F.lit(0).alias(x) for x in ("b", "bm", "bn", "bf")])

    def step(a, e):
        opens = (e["side"] == 0) & (e["i"] < a["r"])
        n, f = e["b"] - a["b"] - 1, a["b"] + 1
        m = n - (e["i"] - a["r"] - 1)
        better = (e["side"] == 1) & (a["r"] < e["i"]) & (
            (m > a["bm"]) | ((m == a["bm"]) & ((n < a["bn"]) | ((n == a["bn"]) & (f < a["bf"])))))
        return F.struct(F.when(opens, e["i"]).otherwise(a["r"]).alias("r"), F.when(opens, e["b"]).otherwise(a["b"]).alias("b"),
                        F.when(better, m).otherwise(a["bm"]).alias("bm"), F.when(better, n).otherwise(a["bn"]).alias("bn"),
                        F.when(better, f).otherwise(a["bf"]).alias("bf"))

    return F.aggregate(F.array_sort(F.concat(ends(0, 1), ends(1, -1))), zero, step)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_matched: int = MIN_MATCHED) -> DataFrame:
    """(doc_id, item_id, matched, aligned, item_tokens, first_token): one row per
    document and benchmark item that overlap.

    ``aligned`` tokens of the item, starting at token ``first_token`` of the
    document, agree in ``matched`` tokens; substitutions inside are tolerated,
    insertions end an overlap. An overlap counts from ``min_matched`` equal
    tokens (5 or more), or 80 % of an item that is shorter than that asks for,
    if at least 80 % of its tokens agree; every such overlap is found. Items of
    fewer than 5 tokens and null or empty texts match nothing. A null doc_id keeps its row.
    Rows with the same doc_id and text give one row. Extra columns are
    ignored."""
    need = F.least(F.lit(min_matched), F.ceil(F.size("item") * MIN_SHARE).cast("int"))
    items = benchmark.select("item_id", tokens(F.col("text").cast("string")).alias("item")).where(
        F.size("item") >= MIN_ITEM).dropDuplicates().select(
        F.xxhash64("item_id", "item").alias("item_key"), "item_id", "item", F.size("item").alias("item_tokens"), need.alias("need"))
    least, n, chars = items.agg(F.min("need"), F.coalesce(F.sum("item_tokens"), F.lit(0)),
                                F.coalesce(F.sum(F.octet_length(F.array_join("item", ""))), F.lit(0))).first()
    masks = [(gaps, top) for gaps, top in MASKS if top is None or (least is not None and least <= top)]

    def bounded(df: DataFrame, n_bytes: int) -> DataFrame:
        return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df

    # From the explosion to the join everything is generated code (no
    # higher-order function, whose operators take whole rows). Keys, places and
    # hashes alone are joined; texts come back for the distinct diagonals. Keys
    # are hashes: a clash adds a diagonal that the comparison turns down.
    def seeds(df: DataFrame, *keep: str) -> DataFrame:
        df = _with_seeds(df, [gaps for gaps, _ in masks])
        sizes = [f"n{k}" for k in range(len(masks))]
        df = df.select(*keep, *[F.size(f"mask{k}").alias(n) for k, n in enumerate(sizes)],
                       F.concat(*[F.col(f"mask{k}") for k in range(len(masks))]).alias("seeds"))
        # the outer form: else the optimiser infers a filter on the size of the
        # hash array, and computes all of it once more, nested, to push it down
        df = df.select(*keep, *sizes, F.posexplode_outer("seeds").alias("at", "seed"))
        mask, at, total = F.lit(len(masks) - 1), F.col("at"), F.lit(0)
        for k, n in reversed(list(enumerate(sizes[:-1]))):
            before = sum((F.col(x) for x in sizes[:k]), F.lit(0))
            mask = F.when(F.col("at") < before + F.col(n), F.lit(k)).otherwise(mask)
        for k, n in enumerate(sizes):
            total = total + F.when(mask > k, F.col(n)).otherwise(0)
        return df.select(*keep, "seed", mask.alias("mask"), (at - total).alias("at"))

    sought = F.lit(True)
    for k, (_, top) in enumerate(masks):
        if top is not None:
            sought = sought & ((F.col("mask") != k) | (F.col("need") <= top))
    bench = seeds(items.withColumn("words", F.col("item")), "item_key", "item_tokens", "need").where(
        F.col("seed").isNotNull() & sought).select(
        "item_key", "item_tokens", "seed", F.col("at").alias("item_at"), F.col("mask").alias("item_mask"))
    keyed = docs.select("doc_id", whole(F.col("text").cast("string")).alias("text"))
    keyed = keyed.select(F.xxhash64("doc_id", "text").alias("doc_key"), "doc_id", "text")
    own = seeds(keyed.select("doc_key", tokens(F.col("text")).alias("words")), "doc_key")
    # the item's first token lies at `start` of the document, which may be before it
    hits = save(own.join(bounded(bench, n * len(masks) * ROW_BYTES), "seed").where("mask = item_mask").select(
        "doc_key", "item_key", "item_tokens", (F.col("at") - F.col("item_at")).alias("start")).distinct())
    hit_bytes = hits.count() * ROW_BYTES
    texts = keyed.join(bounded(hits.select("doc_key").distinct(), hit_bytes), "doc_key", "left_semi").select(
        "doc_key", "doc_id", tokens(F.col("text")).alias("words"))
    skip = F.greatest(-F.col("start"), F.lit(0))
    hits = texts.join(bounded(hits, hit_bytes), "doc_key").select(
        "doc_id", "item_key", "start", skip.alias("skip"),
        F.slice("words", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("item_tokens") - skip).alias("own"))
    hits = hits.join(bounded(items, 32 * n + chars), "item_key").withColumn(
        "item", F.slice("item", F.col("skip") + 1, F.col("item_tokens")))
    equal = F.zip_with("item", "own", lambda a, b: F.coalesce(a == b, F.lit(False)))
    hits = hits.select("doc_id", "item_id", "item_tokens", "need", "start", "skip", _breaks(equal).alias("breaks"))
    hits = hits.select("doc_id", "item_id", "item_tokens", "need", "start", "skip", _best_stretch(F.col("breaks")).alias("r"))
    # filtered after grouping, so that the comparison stays out of the join
    return hits.groupBy("doc_id", "item_id", "item_tokens", "need").agg(
        F.max(F.struct(F.col("r.bm").alias("matched"), (-F.col("r.bn")).alias("n"),
                       (-(F.col("start") + F.col("skip") + F.col("r.bf"))).alias("f"))).alias("x")
    ).where(F.col("x.matched") >= F.col("need")).select(
        "doc_id", "item_id", F.col("x.matched").alias("matched"), (-F.col("x.n")).alias("aligned"),
        "item_tokens", (-F.col("x.f")).alias("first_token"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents. Rows are judged by their own
    text, also where they share a doc_id or have none. Other columns stay as they
    are, whatever their names."""
    key, i, t = unused(docs, "_text_key", "_i", "_t")
    keyed = docs.withColumn(key, F.xxhash64(whole(F.col("text").cast("string"))))
    own = keyed.select(F.struct("doc_id", F.col(key).alias("t")).alias("doc_id"), "text")
    bad = contaminated(own, benchmark).select(F.col("doc_id.doc_id").alias(i), F.col("doc_id.t").alias(t)).distinct()
    clean = keyed.join(bad, (F.col(key) == F.col(t)) & F.col("doc_id").eqNullSafe(F.col(i)), "left_anti")
    return clean.drop(key)
