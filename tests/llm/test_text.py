"""Personal data, SentencePiece and the pipeline."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import decontam, pii, queries, sentencepiece

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m.group() if c.isdigit()]
        odd = [sum(divmod(2 * x, 10)) for x in d[-2::-2]]
        if 12 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(odd)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_are_those_of_the_stated_patterns():
    rnd = random.Random(3)
    for _ in range(20_000):
        t = "".join(rnd.choices("a@.-+ 0123456789(b_%é", k=rnd.randint(0, 45)))
        assert pii.base_spans(t) == plain_spans(t), t
    for t in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+" * 100_000, "a@" * 100_000, "@" * 100_000):
        pii.base_spans(t)  # no quadratic scan


def test_field_carries_labels_to_similar_tokens():
    text = ("Pay with 4111 1111 1111 1111, then 4111.1111.1111.1111 ok. "
            "On 2024 and 2024 nothing. Number 123456789 and 123456789.")
    base, spans = pii.find(text, pii.train([]))
    assert set(base) <= set(spans) and base == plain_spans(text)
    assert [text[s:e] for k, s, e in spans if (k, s, e) not in base] == ["4111.1111.1111.1111"]
    assert pii.mask(text, spans).startswith("Pay with <CARD>, then <CARD> ok. On 2024")
    assert pii.find("no such data 12345 12345", pii.train([])) == ([], [])


def test_field_carries_labels_to_every_return():
    again, plain = "4111.1111.1111.1111", "card 4111 1111 1111 1111 now"
    for parts in ([plain] + [again] * 50, [again] * 50 + [plain], [again] * 25 + [plain] + [again] * 25):
        for sep in (" then ", " ", " 17 x2 "):
            text = sep.join(["Pay", *parts, "ok"])
            base, spans = pii.find(text, pii.train([]))
            assert len(base) == 1
            assert again not in pii.mask(text, spans) and pii.mask(text, spans).endswith(sep + "ok"), (sep, pii.mask(text, spans))


def test_pii_query(spark):
    docs = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    got = queries.op8_pii(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        base = plain_spans(docs[r["doc_id"]] or "")
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_pii_edges(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "x@y.zz", "c"), (2, "x@y.zz", "c"), (3, "7 " * 100_000, "c")],
                                 "doc_id long, text string, spans string")
    got = pii.detect(docs).collect()
    assert sorted((r["doc_id"] or 0, r["spans"]) for r in got) == [(0, "email:0:6"), (1, ""), (2, ""), (2, "email:0:6"), (3, "")]
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:9]) for r in out.collect()) == [(0, "<EMAIL>"), (1, ""), (2, ""), (2, "<EMAIL>"), (3, "7 7 7 7 7")]
    assert pii.detect(docs.limit(0)).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.Vocabulary(sentencepiece.read_model(sentencepiece.MODEL_PATH))


def every_segmentation(text, v, n):
    w, out = " " + text, []

    def go(at, score, ids):
        if at == len(w):
            out.append((score, ids))
            return
        for k in range(1, min(v.longest, len(w) - at) + 1):
            q = w[at:at + k]
            if sentencepiece.SPACE in q:
                if k == 1:
                    go(at + 1, score + 3 * v.floor, ids + [v.byte_id[b] for b in q.encode()])
                return
            hit = v.score.get(q.replace(" ", sentencepiece.SPACE))
            if hit:
                go(at + k, score + hit[0], ids + [hit[1]])
            elif k == 1:
                go(at + 1, score + v.floor * len(q.encode()), ids + [v.byte_id[b] for b in q.encode()])

    go(0, 0.0, [])
    return sorted(out, key=lambda s: -s[0])[:n]


def test_n_best_against_all_segmentations(vocabulary):
    rnd = random.Random(2)
    bits = ["th", "e", " ", "in", "a", "é", "\n", ",", sentencepiece.SPACE, "日", "\0"]
    plain = ["th", "e", " a", "in", "É", ".\nT", ",", "|", ".", "!"]  # without what ends the search for words early
    texts = ["".join(rnd.choices(plain, k=rnd.randint(1, 7))) for _ in range(150)] + ["", " ", "a", "  two  sp", sentencepiece.SPACE] + ["".join(rnd.choices(bits, k=rnd.randint(0, 7))) for _ in range(150)]
    encoder = sentencepiece.Encoder(vocabulary, 4)
    for t, got in zip(texts, encoder(texts)):
        want = every_segmentation(t, vocabulary, 4)
        ways = [got.ids(k) for k in range(len(got.scores))]
        assert [round(s, 6) for s in got.scores] == [round(s, 6) for s, _ in want]
        assert all(sentencepiece.decode(w, vocabulary) == t for w in ways) and len(set(map(tuple, ways))) == len(ways)
        assert got.sizes() == list(map(len, ways)) and got.spelt


def test_batch_search_equals_single_search(vocabulary):
    rnd = random.Random(5)
    found = ["▁" + "".join(rnd.choices("thereinaou,.", k=rnd.randint(1, 40))) for _ in range(300)] + ["x" * 3000, "ab" * 100]
    for w, (score, ids, loss) in zip(found, vocabulary.best_of(found)):
        best = vocabulary.n_best(w, 2)
        assert abs(best[0][0] - score) < 1e-6 and abs(best[0][0] - best[1][0] - loss) < 1e-6
        assert "".join(vocabulary.pieces[i] for i in ids) == w


def test_sentencepiece_query_decodes_to_the_texts(spark):
    docs = sorted((i, t or "") for i, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    got = queries.op4_sentencepiece(spark, SF)
    rows = got.collect()
    assert all(r["round_trip"] and list(r["nbest_scores"]) == sorted(r["nbest_scores"], reverse=True) for r in rows)
    assert sorted(map(tuple, sentencepiece.decode_documents(got).collect())) == docs


def test_sentencepiece_gives_all_segmentations(spark, vocabulary):
    texts = ["the rain in", "", " a ▁ \x00 \U0001f600", "é, x", None, "日本 the\nrest"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sentencepiece.encode(docs).collect():
        t = texts[r["doc_id"]] or ""
        ways = [list(w) for w in r["nbest_ids"]]
        want = sentencepiece.Encoder(vocabulary, 3)([t])[0]
        assert ways == [want.ids(k) for k in range(len(want.scores))] and ways[0] == list(r["ids"])
        assert list(map(len, ways)) == list(r["nbest_sizes"]) and len(ways) == len(r["nbest_scores"])
        assert all(sentencepiece.decode(w, vocabulary) == t for w in ways) and r["round_trip"]


def test_sentencepiece_round_trip_is_that_of_the_decoded_ids(vocabulary):
    """One wrong piece in any rank is noticed."""
    import pyarrow as pa

    model = sentencepiece.read_model(sentencepiece.MODEL_PATH)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["the rain in", "fine"])], ["doc_id", "text"])
    for rank in range(3):
        packed = sentencepiece.Segmentations.packed

        def wrong(self, k=0, packed=packed, rank=rank):
            ids = packed(self, k)
            return ids[:-4] if k == rank and len(self.best) == 3 else ids

        with pytest.MonkeyPatch.context() as m:
            m.setattr(sentencepiece.Segmentations, "packed", wrong)
            [out] = sentencepiece._task(model, 3, 1)([batch])
        assert out.column("round_trip").to_pylist() == [False, True]


def test_sentencepiece_looks_up_distinct_words_once(vocabulary):
    """Not every occurrence; and the vocabulary is not built in every task."""
    import pyarrow as pa

    class Table(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    encoder = sentencepiece.Encoder(vocabulary, 3)
    encoder.new = Table()
    encoder(["the rain in the rain " * 40 + "end"] * 20)
    assert encoder.new.asked <= 8

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["the rain"])], ["doc_id", "text"])
    run = sentencepiece._task(sentencepiece.read_model(sentencepiece.MODEL_PATH), 3, 1)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(sentencepiece, "Vocabulary", None)
        assert [list(run([batch]))[0].num_rows for _ in range(2)] == [1, 1]


def test_words_are_cut_alike_on_bytes_and_characters(vocabulary):
    rnd = random.Random(7)
    bits = ["th", "e", " a", "É", "\u024f", "\u0250", "\u00d7", "\u0200", "\u00bf", "日", "\U0001f600", ".", ",", "|", "!", "\n", ".\nT", "0"]
    texts = [t for t in ("".join(rnd.choices(bits, k=rnd.randint(0, 25))) for _ in range(2000)) if sentencepiece.Encoder._plain(t)]
    encoder = sentencepiece.Encoder(vocabulary, 3)
    words, first = encoder._plain_words(texts)
    words = [w.replace(" ", sentencepiece.SPACE) for w in words.to_pylist()]
    assert [words[i:j] for i, j in zip(first, first[1:])] == [encoder._words(t) for t in texts]


def test_sentencepiece_edges(spark, vocabulary):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 1), (None, " a ▁ \x00 \U0001f600", 1), (2, "long " * 50_000, 1)], "doc_id long, text string, ids int")
    rows = sentencepiece.encode(docs).collect()
    assert len(rows) == 4 and all(r["round_trip"] for r in rows)
    assert [list(r["ids"]) for r in rows if r["doc_id"] == 1] == [[vocabulary.score["▁"][1]]] * 2
    assert sentencepiece.encode(docs.limit(0)).collect() == []


def test_pipeline_stages_against_plain_versions(spark):
    from test_dedup import components, plain_fingerprint

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    state, texts = docs, dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    results = []
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, SF).checkpoint()
        results.append((name, state))
    for name, df in results[:-1]:
        assert df.columns == docs.columns
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for _, df in results]
    labels = {i: t for i, t in duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall()}
    gone = set(texts) - ids[0]
    assert {i for i, t in labels.items() if t == 1} - gone <= {i for i in ids[0]} and not {i for i in gone if labels.get(i) == 0}
    fps = {i: plain_fingerprint(texts[i]) for i in ids[0]}
    comp = components(sorted(fps), [(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4])
    assert ids[1] == set(comp.values())
    clean = decontam.contaminated(results[1][1], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids[2] == ids[1] - {r["doc_id"] for r in clean.collect()}
    assert ids[3] == ids[2] == ids[4]
    masked = {r["doc_id"]: r for r in results[3][1].collect()}
    for i, r in masked.items():
        assert plain_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
    back = dict(map(tuple, sentencepiece.decode_documents(results[4][1]).collect()))
    assert back == {i: r["text"] for i, r in masked.items()}
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, results[4][1].collect()))


def test_pipeline_edges(spark):
    rows = [(1, None, "en", "s", None), (None, "", None, None, 0), (2, "a b c d", "en", "s", 7), (2, "a b c d", "en", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df, most in ((docs, 2), (docs.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF).checkpoint()
        assert df.count() == most


def test_stages_keep_columns_of_any_name(spark):
    """Names that the stages could use themselves stay with their values."""
    item = duckdb.sql(f"select text from '{SF}/benchmark.parquet' where length(text) > 100 order by item_id limit 1").fetchall()[0][0]
    rows = [(1, "one clean text of some words", "en", "s", 5), (2, "one clean text of some words", "en", "s", 5), (None, "another clean text", "en", "s", 5),
            (3, "see " + item, "en", "s", 5), (4, "write to x@y.zz now", "en", "s", 5)]
    names = ["_text_key", "_i", "_T", "root", "fp", "best", "rank", "spans", "base", "no_id", "text_key", "label", "item_id", "words", "_text_key_"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", *[F.concat(F.lit(n + " of "), F.coalesce("doc_id", F.lit(0))).alias(n) for n in names])
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r[n] == f"{n} of {r['doc_id'] or 0}" for r in got for n in names), name
        kept.append(sorted(r["doc_id"] or 0 for r in got))
    assert kept == [[0, 1, 2, 3, 4], [0, 1, 3, 4], [0, 1, 2, 4], [0, 1, 2, 3, 4]]
    name, stage = corpus_pipeline.STAGES[-1]
    assert sorted(r["doc_id"] or 0 for r in stage(spark, docs, SF).collect()) == [0, 1, 2, 3, 4]


def test_training_reads_whole_documents(spark):
    """Candidates late in a long text shape the weights like early ones."""
    late = "pay 4111 1111 1111 1111 or 4111.1111.1111.1111 by x@y.zz "
    docs = [(k, "n 12 x " * 300 + late * 3 if k % 2 else "plain 7 words") for k in range(40)]
    whole = pii.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    cut = pii.fit(spark.createDataFrame([(k, t[:1000]) for k, t in docs], "doc_id long, text string"))
    assert any(abs(whole[k] - cut[k]).max() > 1e-3 for k in whole if whole[k].dtype.kind == "f")
