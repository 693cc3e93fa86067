"""Cross-tokenizer alignment, against a plain version of its definition."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marketlens.llm import align, bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(public_tokenizers.path(align.A_MODEL))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.B_MODEL))
    byte_of = {c: x for x, c in enumerate(bpe.byte_letters())}

    def groups_of(text):
        """The groups of a text, by its bytes: [(A ids, B ids)]."""
        if not text:
            return []
        want = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spell_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        spell_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(spell_a) != want or b"".join(spell_b) != want:
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in spell_a]).tolist(), np.cumsum([len(x) for x in spell_b]).tolist()
        out, x, y = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(cut, x) + 1, ends_b.index(cut, y) + 1
            out.append((ids_a[x:i], ids_b[y:j]))
            x, y = i, j
        return out

    def statistics(texts):
        """Result columns of each text of a corpus."""
        all_groups = [groups_of(t) for t in texts]
        links = [Counter((i, j) for a_ids, b_ids in g for i in a_ids for j in b_ids) for g in all_groups]
        count = Counter(p for c in links for p in c)
        most = {}
        for (i, _), n in count.items():
            most[i] = max(n, most.get(i, 0))
        out = []
        for g, c in zip(all_groups, links):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                        sum(n for p, n in c.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in c.items()),
                        hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return out

    return groups_of, statistics


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_the_definition(spark, plain):
    found = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = sorted((i, *s) for (i, _), s in zip(found, plain[1]([t for _, t in found])))
    got = queries.op12_tokenizer_alignment(spark, SF)
    assert got.columns == ["doc_id", *COLUMNS]
    assert sorted(tuple(r) for r in got.collect()) == want


PARTS = ["a", "Word", "'s", " ", "  ", "\n", "\t", "é", "é", "你", "🙂", "▁", "1", "2024", "<s>", "<|endoftext|>", "<0x41>", "==", "====",
         "abab", "zzz", "​", "\x1c", "\x85", " ", "͸", "Ᲊ", "Garay\U00010d50", "ﬁ", "the", "ing", "\0", "﻿"]


def test_groups_of_odd_texts(spark, plain):
    rnd = random.Random(9)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 25))) for _ in range(600)]
    texts += ["ab" * 4000, "=" * 5003, "z" * 3001 + " " + "abc" * 999, " " * 700 + "x", "a▁b", "▁"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in align.align(docs).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], plain[0](t)
        ends_a, ends_b = np.cumsum([0, *r["a_sizes"]]), np.cumsum([0, *r["b_sizes"]])
        own = [(r["a_ids"][ends_a[k]:ends_a[k + 1]], r["b_ids"][ends_b[k]:ends_b[k + 1]]) for k in range(len(r["a_sizes"]))]
        assert own == want, t[:80]
    stats = {r["doc_id"]: tuple(r)[1:] for r in align.link_statistics(docs).collect()}
    assert [stats[i] for i in range(len(texts))] == plain[1](texts)


def test_pointers_equal_common_ends():
    rnd = random.Random(10)
    for _ in range(2000):
        n = rnd.randint(1, 60)
        ends = [sorted({n, *rnd.sample(range(1, n + 1), rnd.randint(0, n))}) for _ in "ab"]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        got = align.groups(*map(np.array, ends))
        for own, g in zip(ends, got):
            assert g.tolist() == [int(np.searchsorted(cuts, e)) for e in own]


def test_bounds_change_nothing(spark, plain, monkeypatch):
    """Few frequent pairs, and few links expanded at once."""
    texts = ["the cat sat on the mat. " * 3, "the dog", "", None, "the the the", "abab" * 50, "a cat", "the cat sat on the mat. " * 3]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want = plain[1](texts)
    for frequent, pairs in ((0, 5), (3, 1), (10 ** 6, 10 ** 6)):
        monkeypatch.setattr(align, "FREQUENT", frequent)
        monkeypatch.setattr(align, "PAIRS", pairs)
        got = {r["doc_id"]: tuple(r)[1:] for r in align.link_statistics(docs).collect()}
        assert [got[k] for k in range(len(texts))] == want


def test_linked_in_small_blocks(monkeypatch):
    rnd = np.random.default_rng(11)
    doc = np.repeat(np.arange(5), 4)
    group_a, group_b = np.sort(rnd.integers(0, 20, 300)), np.sort(rnd.integers(0, 20, 200))
    a, b = rnd.integers(0, 6, 300), rnd.integers(0, 6, 200)
    want = Counter((int(doc[g]), int(a[i]), int(b[j])) for i, g in enumerate(group_a) for j in np.flatnonzero(group_b == g))
    for pairs in (1, 7, 10 ** 6):
        monkeypatch.setattr(align, "PAIRS", pairs)
        at, code, times = align.linked(doc, group_a, a, group_b, b)
        assert {(int(d), int(c >> 32), int(c & 0xFFFFFFFF)): int(t) for d, c, t in zip(at, code, times)} == want


def test_edges(spark, plain):
    rows = [(1, None, 7), (2, "", 7), (None, "Hello you", 7), (2, "Hello you", 7), (2, "Hello you", 7), (3, "word " * 40_000, 7), (4, "▁ no", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").selectExpr("*", "1 as pairs", "2 as a_ids")
    got = align.link_statistics(docs).collect()
    want = plain[1]([t for _, t, _ in rows])
    assert sorted((r["doc_id"] or 0, *tuple(r)[1:]) for r in got) == sorted((d or 0, *w) for (d, _, _), w in zip(rows, want))
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r["doc_id"] in (1, 4))
    assert align.link_statistics(docs.where("false")).count() == 0
