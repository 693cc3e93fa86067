"""URL filter, decontamination, sharding, toxicity, quality against plain
versions."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import decontam, queries, sharding, toxicity, urls
from marketlens.llm import quality as quality_mod

SF = "/root/testdata/sf0.001"
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"[^/?#]*", rest)
        host = re.sub("[A-Z]", lambda x: x.group().lower(), m.group())
        path = re.match(r"[^?#]*", rest[m.end():]).group()
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [None, "", "no scheme", "://", "http://", "http://A.ORG", "http://a.org/", "HTTP://x.Example.ORG/es/?q=1#f", "http://example.org/en/12",
        "http://notexample.org/es/", "http://org/x", "http://a.com/fr/1", "http://a.com/de", "http://a.com/de/", "http://com/de/x?://b",
        "x://y?z=/es/", "http://a.com#/de/", "http://a.b\nc/d\ne?f", "http://É.org/", "a://b://c/d", "http://h/" + "s/" * 20_000]


def test_url_parsing_and_stated_rules(spark):
    df = spark.createDataFrame([(k, u, "clash", "clash") for k, u in enumerate(URLS)] + [(1, "", "c", "c")],
                               "page_id long, url string, host string, verdict string")
    got = urls.judge(df).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule, verdict = plain_url(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule:
            assert r["verdict"] == verdict
    assert urls.judge(df.limit(0)).collect() == []


def test_url_rules_are_mined_pruned_and_applied(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(400):
        rows.append((f"http://{rnd.choice('abc')}.x.com/{rnd.choice(['de', 'fr'])}/{k}", ))
    pages = spark.createDataFrame([(k, u) for k, (u,) in enumerate(rows)] + [(999, "http://q.net/de/5"), (998, "http://q.net/zz/5")],
                                  "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert got[999]["verdict"] == "block" and got[999]["antecedent"] == ["path:de"] and got[999]["rule"] is None
    assert got[998]["verdict"] == "allow" and got[998]["confidence"] is None
    labelled = pages.limit(400).selectExpr("url", "if(url like '%/de/%', 'block', 'allow') as verdict")
    rules = urls.mine(labelled).collect()
    assert {tuple(r["antecedent"]) for r in rules} == {("path:de",), ("path:fr",)}  # longer ones are implied
    for r in rules:  # support and confidence recounted
        has = [u for (u,) in rows if f"/{r['antecedent'][0][5:]}/" in u]
        assert r["confidence"] == 1.0 and abs(r["support"] - len(has) / 400) < 1e-9


def test_url_query(spark):
    pages = duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in queries.op1_url_filters(spark, SF).collect()}
    assert len(got) == len(pages)
    for i, u in pages:
        host, path, rule, verdict = plain_url(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block")


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def exact_leaks(docs, items):
    """Items whose every token stands in a row in the document."""
    out = set()
    for i, t in docs:
        d = " " + " ".join(words(t)) + " "
        for j, s in items:
            w = words(s)
            if len(w) >= decontam.MIN_ITEM and " " + " ".join(w) + " " in d:
                out.add((i, j))
    return out


def test_decontamination_query_finds_every_whole_passage(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    got = queries.op6_benchmark_decontamination(spark, SF).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= exact_leaks(docs, items)
    text = dict(docs)
    for r in got:  # what is reported is there
        assert r["matched"] >= min(13, -(-8 * r["item_tokens"] // 10))
        assert words(text[r["doc_id"]])[r["first_token"]:][:r["aligned"]]


def test_decontamination_tolerates_substitutions_only(spark):
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(5000)]
    item = rnd.sample(vocabulary, 40)
    other = rnd.sample(vocabulary, 60)

    def changed(at):
        return [("zzz" if k in at else w) for k, w in enumerate(item)]

    docs = {0: other, 1: other + item + other, 2: other + changed({10, 22}) + other, 3: item[:9] + other, 4: other[:5] + item[20:36],
            5: changed(set(range(0, 40, 2))), 6: [], 7: changed({5, 11, 17, 25, 33})}
    rows = [(k, " ".join(w)) for k, w in docs.items()] + [(8, None), (None, " ".join(item)), (1, " ".join(docs[1]))]
    short = ["tiny item of six tokens here", "two words"]
    rows.append((9, "before it a TINY, item of six tokens: here and after"))
    d = spark.createDataFrame([(i, t, -1) for i, t in rows], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(0, " ".join(item), 1), (1, short[0], 1), (2, short[1], 1), (3, None, 1), (4, "", 1)],
                              "item_id long, text string, doc_id int")
    got = decontam.contaminated(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 0), (2, 0), (4, 0), (7, 0), (None, 0), (9, 1)}
    by = {(r["doc_id"], r["item_id"]): r for r in got}
    assert tuple(by[1, 0])[2:] == (40, 40, 40, 60) and tuple(by[2, 0])[2:] == (38, 40, 40, 60) and by[4, 0]["first_token"] == 5
    left = decontam.decontaminate(d, b)
    assert left.columns == d.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 3, 5, 6, 8]
    assert decontam.contaminated(d.limit(0), b).collect() == [] and decontam.contaminated(d, b.limit(0)).collect() == []


def plain_stretch(equal):
    """Most equal tokens, shortest, first, of all stretches that agree in 80 %."""
    found = [(sum(equal[a:b]), a - b, -a) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if 5 * sum(equal[a:b]) >= 4 * (b - a)]
    m, n, f = max(found, default=(0, 0, 0))
    return (m, -n, -f) if m else (0, 0, 0)


def test_best_stretch_against_all_stretches(spark):
    rnd = random.Random(11)
    rows = [[rnd.random() < rnd.choice((0.3, 0.7, 0.8, 0.9)) for _ in range(rnd.randint(0, 45))] for _ in range(600)]
    rows.append([k not in (5, 10) for k in range(15)])  # 13 of 15
    rows.append([k % 5 != 4 for k in range(59)])        # 48 of 59
    df = spark.createDataFrame(list(enumerate(rows)), "k int, equal array<boolean>")
    df = df.select("k", decontam._breaks(F.col("equal")).alias("b")).select("k", decontam._best_stretch(F.col("b")).alias("r"))
    for k, r in df.collect():
        assert (r["bm"], r["bn"], r["bf"]) == plain_stretch(rows[k]), rows[k]


def test_decontamination_of_a_short_item_with_substitutions(spark):
    item = [f"w{k}" for k in range(15)]
    doc = ["zzz" if k in (5, 10) else w for k, w in enumerate(item)]
    d = spark.createDataFrame([(1, "before it " + " ".join(doc) + " after")], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert [tuple(r) for r in decontam.contaminated(d, b).collect()] == [(1, 7, 13, 15, 15, 2)]


def test_seeds_hit_every_overlap_that_counts():
    for n in range(decontam.MIN_ITEM, 19):
        need = min(decontam.MIN_MATCHED, -(-8 * n // 10))
        equal = np.arange(2 ** n)[:, None] >> np.arange(n) & 1 == 1
        sums = np.concatenate([np.zeros((len(equal), 1), int), equal.cumsum(1)], axis=1)
        counts = np.zeros(len(equal), bool)
        for a in range(n):
            for b in range(a + 1, n + 1):
                m = sums[:, b] - sums[:, a]
                counts |= (m >= need) & (5 * m >= 4 * (b - a))
        hit = np.zeros(len(equal), bool)
        for gaps, top in decontam.MASKS:
            if top is None or need <= top:
                at = {0}
                for g in gaps:
                    at |= {x + g for x in at}
                for s in range(n - max(at)):
                    hit |= equal[:, [s + x for x in at]].all(1)
        assert counts.any() and not (counts & ~hit).any(), n


def offsets(gaps):
    at = {0}
    for g in gaps:
        at |= {x + g for x in at}
    return sorted(at)


@pytest.mark.parametrize("need", range(4, 14))
def test_no_pattern_of_any_length_avoids_the_seeds(need):
    """Grows all patterns that no mask hits, place by place, keeping for their
    last places and their equal tokens the fewest substitutions (as equal tokens
    less four a substitution): none comes to count as an overlap."""
    masks = [offsets(gaps) for gaps, top in decontam.MASKS if top is None or need <= top]
    if need > 4:  # without the supplement for items of five tokens every mask ignores a position
        assert len(masks) >= 2 and all(m[-1] + 1 > len(m) for m in masks)
    wide = (1 << max(m[-1] for m in masks) + 1) - 1
    best = {(0, 0): 0}
    new = dict(best)
    while new:
        grown = {}
        for (last, m), score in new.items():
            for equal in (0, 1):
                now = (last << 1 | equal) & wide
                if equal and any(all(now >> (k[-1] - x) & 1 for x in k) for k in masks):
                    continue  # hit
                then = score + (1 if equal else -4)
                state = (now, min(need, m + equal))
                assert not (equal and state[1] == need and then >= 0), (need, bin(now))
                if then >= -4 * need and then > best.get(state, -10 ** 9):
                    best[state] = grown[state] = then
        new = grown


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(17)
    items = [[f"i{j}w{k}" for k in range(n)] for j, n in enumerate([*range(3, 26), 59])]
    docs, want = [], {}
    for j, item in enumerate(items):
        for q in (0.1, 0.2, 0.3, 0):
            for t in range(8):
                equal = [rnd.random() >= q for _ in item] if q else [(k + t) % (5 + t % 3) > 0 for k in range(len(item))]
                m, n, f = plain_stretch(equal)
                if len(item) >= 5 and m >= min(13, -(-8 * len(item) // 10)):
                    want[len(docs), j] = (m, n, len(item), 3 + f)
                docs.append((len(docs), "x y z " + " ".join(w if e else "other" for w, e in zip(item, equal)) + " x y"))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontam.contaminated(d, b).collect()}
    assert len(want) > 200 and got == want


def test_decontamination_joins_narrow_rows(spark, monkeypatch):
    """Neither texts nor items travel with the seeds, and the result is the
    same when nothing is broadcast."""
    rnd = random.Random(5)
    items = [[f"i{j}w{k}" for k in range(n)] for j, n in enumerate([5, 9, 15, 30, 3000])]
    docs = [(k, " ".join(rnd.choices("abcdefgh", k=2000) + items[k % 5] + rnd.choices("abcdefgh", k=2000))) for k in range(20)]
    d = spark.createDataFrame(docs + docs[:2], "doc_id long, text string")
    b = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id long, text string")
    saved = []
    monkeypatch.setattr(decontam, "save", lambda df, save=decontam.save: saved.append(df) or save(df))
    want = sorted(map(tuple, decontam.contaminated(d, b).collect()))
    assert want == sorted((k, k % 5, len(items[k % 5]), len(items[k % 5]), len(items[k % 5]), 2000) for k in range(20))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, decontam.contaminated(d, b).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for df in saved:
        assert {kind for _, kind in df.dtypes} == {"bigint", "int"} and df.count() == df.distinct().count() == 20


def test_decontaminate_judges_rows_by_their_own_text(spark):
    item = " ".join(f"w{k}" for k in range(20))
    d = spark.createDataFrame([(i, t) for i in (1, None) for t in ("clean", item, "so " + item, None)] + [(2, item)], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    left = decontam.decontaminate(d, b).collect()
    assert sorted(map(str, left)) == sorted(map(str, d.where("text is null or text = 'clean'").collect()))


def test_sharding(spark):
    rows = [(i, None if i % 50 == 0 else "é" * (i % 7)) for i in range(1003)] + [(5, "again"), (5, "again"), (None, "x"), (7, "y" * 200_000)]
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, shard int")
    got = sharding.shuffle_into_shards(df).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shuffle_into_shards(df.repartition(5)).collect()  # however it is partitioned
    assert Counter(map(str, got)) == Counter(map(str, again))
    assert sharding.shuffle_into_shards(df.limit(0)).collect() == []


def test_sharding_is_uniform_and_written_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 200)
    df = spark.range(3000).selectExpr("id as doc_id", "cast(id % 10 as string) as text")
    got = sharding.shuffle_into_shards(df, 4, seed=1).collect()
    table = np.zeros((4, 4))
    for r in got:  # shard against quarter of the ids, and of the slots
        table[r["shard"], r["doc_id"] * 4 // 3000] += 1
    assert ((table - 187.5) ** 2 / 187.5).sum() < 30
    slots = np.array([(r["doc_id"], r["slot"]) for r in got])
    assert abs(np.corrcoef(slots.T)[0, 1]) < 0.08
    sharding.write_shards(df, str(tmp_path / "out"), 4, seed=1)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in back.collect()) == Counter((r["doc_id"], r["shard"], r["slot"]) for r in got)


def test_communication_matrix_sums():
    rows = np.array([0, 17, 1000, 3, 999])
    m = sharding.communication_matrix(rows, 7, 3)
    assert (m.sum(1) == rows).all() and m.sum(0).max() - m.sum(0).min() <= 1 and (m >= 0).all()
    big = sharding.communication_matrix(np.array([10 ** 10, 3 * 10 ** 9 + 1]), 5, 3)
    assert big.sum(0).max() - big.sum(0).min() <= 1


@pytest.fixture(scope="module")
def truth():
    return {i: (q, t) for i, q, t in duckdb.sql("select doc_id, quality, toxic from '/root/testdata/sf0.1/labels.parquet'").fetchall()}


def test_toxicity_accuracy_on_unseen_documents(spark, truth):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels.where("doc_id % 3 <> 0")).collect()}
    assert len(got) == 10_000
    held = [(truth[i][1] == 1, got[i]["toxic"]) for i in got if i in truth and i % 3 == 0]
    found, wrong = sum(y and p for y, p in held), sum(p and not y for y, p in held)
    assert found >= 0.85 * sum(y for y, _ in held) and wrong <= 0.01 * len(held)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "some words", 0), (1, "again", 0), (3, "x " * 200_000, 0)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, none).collect()
    assert len(got) == 5 and not any(r["toxic"] for r in got)
    one = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(toxicity.classify(docs, one).collect()) == 5
    kept = toxicity.drop_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5
    assert toxicity.classify(docs.limit(0), one).collect() == []


def test_quality_query_on_held_out_rows(spark, truth):
    got = {r["doc_id"]: r for r in queries.op9_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    own = dict((i, q) for i, q in duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    held = [(own[i], r["predicted"]) for i, r in got.items() if i in own and r["held_out"]]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_quality_reads_no_held_out_labels_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality", "toxic")
    a = sorted((r["doc_id"], r["score"]) for r in quality_mod.rank(docs, labels).collect())
    assert a == sorted((r["doc_id"], r["score"]) for r in quality_mod.rank(docs, flipped).collect())
    odd = spark.createDataFrame([(None, None, 0.1), (1, "", 0.1), (1, "", 0.1)], "doc_id long, text string, score double")
    got = quality_mod.rank(odd, labels.limit(0)).collect()
    assert [r["score"] for r in got] == [0.5] * 3 and [r["held_out"] for r in got][0] is False
    assert quality_mod.rank(odd.limit(0), labels).collect() == []


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(0)
    n = 600
    dense = rng.normal(size=(n, quality_mod.features.N_DENSE))
    good = (dense[:, 0] + 0.2 * rng.normal(size=n) > 0).astype(int)
    model = quality_mod.train(dense, [np.empty(0, np.int64)] * n, good)
    s = quality_mod.scores(dense, [np.empty(0, np.int64)] * n, model)
    wins = (s[good == 1][:, None] > s[good == 0][None]).mean()
    assert wins > 0.95 and abs((s >= 0.5).mean() - good.mean()) < 0.01


def test_equal_rows_spread_over_all_shards(spark, monkeypatch):
    """A tenth of the rows is one row: each copy has a place of its own."""
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 500)
    monkeypatch.setattr(sharding, "COPIES", 64)
    df = spark.range(20_000).selectExpr("if(id % 10 = 0, null, id) as doc_id", "if(id % 10 = 0, 'copy', cast(id as string)) as text", "id as copy")
    got = sharding.shuffle_into_shards(df, 16, seed=2).collect()
    assert len(got) == 20_000 and sorted(Counter(r["shard"] for r in got).values()) == [1250] * 16
    copies = [r for r in got if r["doc_id"] is None]
    assert len(copies) == 2000
    table = np.zeros((16, 10))
    for r in copies:  # shard against tenth of the slots
        table[r["shard"], r["slot"] * 10 // 1250] += 1
    expected = 2000 / table.size
    assert ((table - expected) ** 2 / expected).sum() < 230  # 159 degrees of freedom: beyond 1 in 5,000
    again = sharding.shuffle_into_shards(df.repartition(3), 16, seed=2).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_hypergeometric_law():
    """The drawn counts follow the exact probabilities, at any size."""
    rng = np.random.default_rng(5)
    for good, bad, n in ((5, 7, 4), (1, 30, 12), (40, 3, 20), (10, 10, 20), (0, 5, 3)):
        draws = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(4000))
        for k in range(max(0, n - bad), min(n, good) + 1):
            p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
            assert abs(draws[k] - 4000 * p) < 5 * math.sqrt(4000 * p * (1 - p)) + 1e-9, (good, bad, n, k)
        assert sum(draws.values()) == 4000
    good, bad, n = 10 ** 11, 3 * 10 ** 11, 10 ** 8  # beyond numpy's limit
    draws = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(300)])
    mean, sd = n / 4, math.sqrt(n * 3 / 16 * (good + bad - n) / (good + bad - 1))
    assert abs(draws.mean() - mean) < 5 * sd / math.sqrt(300) and 0.8 < draws.std() / sd < 1.2


def test_quality_learns_from_every_labelled_document(spark):
    """A word that only documents beyond any 10,000 in hash order hold."""
    n, late = 10_400, 400
    ids = spark.range(4 * n).where("crc32(cast(cast(id as string) as binary)) % 3 <> 1").limit(n)
    order = [r[0] for r in ids.selectExpr("id", "xxhash64(id) as h").orderBy("h").collect()]
    rows = [(i, f"word{k % 7} common", int(k % 2)) for k, i in enumerate(order[:-late])]
    rows += [(i, f"word{k % 7} zebra", 0) for k, i in enumerate(order[-late:])]
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(-1, "word1 zebra"), (-2, "word1 common")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality_mod.rank(docs, labels).where("doc_id < 0").collect()}
    assert got[-1] < 0.1 < got[-2]


def test_toxicity_learns_from_every_labelled_document(spark):
    n, late = 10_600, 600
    order = [r[0] for r in spark.range(n).selectExpr("id", "xxhash64(id) as h").orderBy("h").collect()]
    rows = [(i, f"word{k % 7} common", 0) for k, i in enumerate(order[:-late])]
    rows += [(i, f"word{k % 7} zebra", 1) for k, i in enumerate(order[-late:])]
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(-1, "word1 zebra"), (-2, "word1 common")], "doc_id long, text string")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.classify(docs, labels).where("doc_id < 0").collect()}
    assert got == {-1: True, -2: False}


def test_scoring_looks_up_the_chosen_features_only():
    from marketlens.llm import features
    texts = ["", "Alpha beta gamma-delta ALPHA", "beta 123 \u00e9t\u00e9 alphabet", "x " * 50 + "gamma", "zzz"]
    every = [features.Hasher()(t) for t in texts]
    chosen = np.unique(np.concatenate(every))[::3]
    few = [features.Hasher(chosen)(t) for t in texts]
    assert all(set(f) == set(e) & set(chosen) for f, e in zip(few, every))
    want = np.array([np.isin(chosen, e) for e in every], np.float32)
    assert (features.columns(few, chosen) == want).all() and (features.columns(every, chosen) == want).all()


def test_features_of_many_texts_hash_each_word_once(monkeypatch):
    from marketlens.llm import features
    rnd = random.Random(3)
    bits = ["th", "e", " a", "\u00c9", ".\nT", "_", "\u0130", "\u03a3 ", "\u65e5\u672c", "\u00d7", "\0", "\U0001f600", "\U00010400", "\u0663", "\u00b2", "\u0301", "\x1c", "9", "x" * 70]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 40))) for _ in range(300)] + ["", " ", "\0"]

    def plain(text):
        words = set(re.findall(r"\w+", text.lower()))
        parts = words | {f"{n}:{w[:n]}" for w in words for n in features.PREFIXES if len(w) >= n}
        return sorted({zlib.crc32(p.encode()) >> (32 - features.BITS) for p in parts})

    want = [plain(t) for t in texts]
    assert [x.tolist() for x in features.Hasher().many(texts)] == want
    chosen = np.unique(np.concatenate(want))[::3]
    assert [x.tolist() for x in features.Hasher(chosen).many(texts)] == [sorted(set(x) & set(chosen.tolist())) for x in want]
    assert features.Hasher().many([]) == []

    hashed, checksums = [], features.checksums
    monkeypatch.setattr(features, "checksums", lambda data, starts, ends, before=b"": hashed.append(len(starts)) or checksums(data, starts, ends, before))
    assert len(features.Hasher().many(["alpha beta ab " * 30] * 50)) == 50
    assert hashed == [3, 2, 2, 1, 0]


def test_feature_counts_are_written_once(spark):
    from marketlens.llm import learn
    rows = spark.createDataFrame([([1, 2], 1), ([2], 0)], "ids array<int>, y int")
    counts = learn.shares(rows, y=F.col("y") == 1)
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == [(1, 1, 1), (2, 2, 1)]
