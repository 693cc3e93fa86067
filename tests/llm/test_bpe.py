"""BPE encoding by forced cuts, against the library's own encoder."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlens.llm import bpe, queries

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.MODEL)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return bpe.Model(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


PARTS = ["a", "B", "'s", "'LL", " ", "\n", "\x1c", "\x85", " ", " ", "​", "́", "é", "é", "Σ", "ΑΣ", "İ", "ǅ",
         "Ᲊ", "你", "🙂", "͸", "1", "²", "<|endoftext|>", "<|startoftext|>", "<|", "...", "ẞ", "ͅ", "ﬁ", "가", "가",
         "the", "ing", "�", "\U0001f1e9", "naïve", "2024-01-01", "aaaa", "==", "\0"]


def test_ids_are_those_of_the_library(model, library):
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 30))) for _ in range(4000)]
    texts += ["", " ", "\n\n", "a" * 100_000, "ab" * 30_000, "é" * 50_000, "=" * 50_000, "<|endoftext|>" * 500, "zq" * 40 + " " + "zq" * 400]
    encoder = bpe.Encoder(model)
    for i in range(0, len(texts), 400):
        part = texts[i:i + 400]
        for t, blob in zip(part, encoder(part)):
            ids = np.frombuffer(blob, "<u4").tolist()
            assert ids == ids_of(library, t), t[:200]
            assert bpe.decode(ids, model) == library.decode(ids, skip_special_tokens=False)


def test_no_token_spans_a_cut(model):
    """Every token of the vocabulary is one fragment when it stands as a word."""
    vocab = [t for t in model.tokens if t not in model.special]
    words = [bytes(model.byte_of[c] for c in t.removesuffix(bpe.END)) for t in vocab if t.endswith(bpe.END) and t != bpe.END]
    _, starts, first = bpe.cuts(words, model)
    assert len(starts) == len(words) and first.tolist() == list(range(len(words)))
    # and there are cuts: texts do fall apart
    _, starts, _ = bpe.cuts(["zqxj".encode(), "你好".encode(), b"..!?"], model)
    assert len(starts) > 3


def test_rounds_equal_the_heap(model):
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdetinghs", k=rnd.randint(1, 60))).encode() for _ in range(500)]
    ids, upto = bpe.encode_words(words, model)
    for k, w in enumerate(words):
        symbols = [int(x) for x in model.symbol_id[list(w[:-1]) + [w[-1] + 256]]]
        assert ids[upto[k]:upto[k + 1]].tolist() == bpe.merge_long(symbols, model)


def test_table_turnover_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 40)
    monkeypatch.setattr(bpe, "BLOCK", 7)
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcde", k=rnd.randint(1, 8))) for _ in range(200)] + ["x" * 90]
    encoder = bpe.Encoder(model)
    for _ in range(40):
        part = [" ".join(rnd.choices(words, k=25)) for _ in range(4)]
        for t, blob in zip(part, encoder(part)):
            assert np.frombuffer(blob, "<u4").tolist() == ids_of(library, t)


def test_query_equals_the_library(spark, library):
    docs = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    got = queries.op13_bpe(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        ids = ids_of(library, docs[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges(spark, library):
    rows = [(1, None, 7), (2, "", 7), (None, "Hello", 7), (2, "Hello", 7), (2, "Hello", 7), (3, "word " * 60_000, 7), (4, "x" * 200_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    got = sorted((r["doc_id"] or 0, tuple(r["ids"]), r["decoded"]) for r in bpe.encode(docs).collect())
    assert got == sorted((d or 0, tuple(ids_of(library, t or "")), library.decode(ids_of(library, t or ""), skip_special_tokens=False)) for d, t, _ in rows)
    back = bpe.decode_documents(bpe.encode(docs)).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in back) == [(d, t) for d, _, t in got]
    none = bpe.digests(bpe.encode(docs.where("false"), packed=True))
    assert none.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and none.count() == 0
    empty = bpe.digests(bpe.encode(docs.where("doc_id = 1"), packed=True)).first()
    assert empty["n_tokens"] == 0 and empty["ids_sha256"] == empty["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
