"""Cross-tokenizer alignment by pointer jumping, and link statistics.

A text is cut by two tokenizers, A and B. Every token points to the farthest-
right token that overlaps it: an A token to the B token over its last byte, a B
token to the A token that reaches beyond its end; a B token that ends where an A
token ends points to itself. Doubling all pointers at once (each takes over its
successor's) leads every token to the last one of its component, the group of
tokens between two places where both tokenizers cut.

All pairs of A and B tokens of a group are links. How many documents hold an id
pair linked is counted over the corpus. A document's distinct pairs then look
their counts up: the most frequent pairs, bounded in number, are broadcast; the
rest is joined by shuffle, where no pair is frequent any more.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .bpe import byte_letters
from .common import save

A_MODEL, B_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
SIZE = 300_000         # bytes cut at once, a longer text by itself
PAIRS = 4_000_000      # links expanded at once
FREQUENT = 400_000     # id pairs whose counts are broadcast, at most


class ByteTokens:
    """Tokenizer A: a byte-level BPE vocabulary. Its merges are run by a library
    for rank files, where the ids are the ranks; texts with characters that the
    two libraries' tables class differently go through the file's own library."""

    def __init__(self, blob: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(blob.decode())
        self.library.encode_special_tokens = True  # their strings in a text are plain text
        spec = json.loads(blob)
        vocab = dict(spec["model"]["vocab"])
        for t in spec["added_tokens"]:
            vocab.pop(t["content"], None)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        own = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
        self.spelling = [b""] * (max([*own.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for t, i in own.items():
            self.spelling[i] = t
        merges = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        ranked = all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own, special_tokens={}) if ranked else None
        alone = {bytes([b]): b for b in range(256)}
        self.classes = [tiktoken.Encoding("c", pat_str=p, mergeable_ranks=alone, special_tokens={}) for p in (r"\p{L}", r"\p{N}", r"\s")]
        self.alike: dict[str, bool] = {}

    def _agrees(self, c: str) -> bool:
        hit = self.alike.get(c)
        if hit is None:
            own = [bool(e.encode_ordinary(c)) for e in self.classes]
            split = self.library.pre_tokenizer.pre_tokenize_str
            lib = [len(split(x + c)) == 1 for x in "a1!"]  # letter, number, neither
            hit = self.alike[c] = own[:2] == lib[:2] and own[2] == (not any(lib))
        return hit

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        odd = {c for c in set().union(*map(set, texts)) if not self._agrees(c)}
        out = []
        for t in texts:
            if self.fast and (not odd or odd.isdisjoint(t)):
                out.append(self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int32))
            else:
                out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, np.int32))
        return out


class Pieces:
    """Tokenizer B: SentencePiece, which puts a space before the text."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.spelling = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in ((i, sp.id_to_piece(i)) for i in range(len(sp)))]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.sp.encode(texts, num_threads=1)]


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token, numbered from 0, of two cuts of the same bytes."""
    n = len(ends_a)
    over = np.searchsorted(ends_b, ends_a)          # the B token over an A token's last byte
    beyond = np.minimum(np.searchsorted(ends_a, ends_b), max(n - 1, 0))
    own = np.arange(n, n + len(ends_b))
    at = np.concatenate([n + over, np.where(ends_a[beyond] > ends_b, beyond, own) if n else own])
    while True:
        far = at[at]
        if np.array_equal(far, at):
            break
        at = far
    last = np.zeros(n + len(ends_b), bool)
    last[at] = True
    label = np.cumsum(last) - 1                      # terminal tokens are B tokens, in order
    return label[at[:n]], label[at[n:]]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _aligned(ids: list[np.ndarray], spelling: pa.Array, lengths: np.ndarray, want: pa.Array):
    """Ids in a row, tokens of each text, ends in bytes, and which texts are spelt."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    at = pa.array(np.cumsum([0, *sizes], dtype=np.int64))
    back = pc.binary_join(pa.LargeListArray.from_arrays(at, spelling.take(pa.array(flat))), pa.scalar(b"", pa.large_binary()))
    return flat, sizes, np.cumsum(lengths[flat]), pc.equal(back, want).to_numpy(zero_copy_only=False)


def cut(texts: list[str], a: ByteTokens, b: Pieces, tables) -> tuple:
    """For texts that are not empty: A ids, B ids, and the tokens of A and of B in
    each group, all in a row, with their numbers for each text."""
    (spell_a, len_a), (spell_b, len_b) = tables
    spaced = [" " + t for t in texts]
    want = pa.array([t.encode() for t in spaced], pa.large_binary())
    ids_a, ids_b = a(spaced), b(texts)
    spelt = _aligned(ids_a, spell_a, len_a, want)[3] & _aligned(ids_b, spell_b, len_b, want)[3]
    spelt &= np.array([t != "" for t in texts], bool)
    none = np.empty(0, np.int32)
    ids_a = [x if ok else none for x, ok in zip(ids_a, spelt)]
    ids_b = [x if ok else none for x, ok in zip(ids_b, spelt)]
    flat_a, n_a, ends_a, _ = _aligned(ids_a, spell_a, len_a, want)
    flat_b, n_b, ends_b, _ = _aligned(ids_b, spell_b, len_b, want)
    group_a, group_b = groups(ends_a, ends_b)
    many = int(group_b[-1]) + 1 if len(group_b) else 0
    per_a, per_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
    # a text ends where both end, so no group reaches over two texts
    stop = np.cumsum(n_b)
    upto = np.where(stop > 0, group_b[np.maximum(stop - 1, 0)] + 1 if many else 0, 0)
    return flat_a, n_a, flat_b, n_b, per_a, per_b, np.diff(np.append(0, upto))


ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes], dtype=np.int32)), pa.array(values.astype(np.int32)))


def _table(spelling: list[bytes]):
    return pa.array(spelling, pa.large_binary()), np.fromiter(map(len, spelling), np.int64, len(spelling))


def _align_task(a_blob: bytes, b_blob: bytes):
    def run(batches):
        a, b = ByteTokens(a_blob), Pieces(b_blob)
        tables = _table(a.spelling), _table(b.spelling)
        for batch in batches:
            length = pc.binary_length(batch.column(1)).to_pylist()
            start = 0
            while start < batch.num_rows:
                end, size = start, 0
                while end < batch.num_rows and (end == start or size + length[end] <= SIZE):
                    size += length[end]
                    end += 1
                texts = batch.column(1).slice(start, end - start).to_pylist()
                flat_a, n_a, flat_b, n_b, per_a, per_b, n_groups = cut(texts, a, b, tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), _lists(flat_a, n_a), _lists(flat_b, n_b), _lists(per_a, n_groups), _lists(per_b, n_groups)],
                    ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])
                start = end

    return run


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _models(a_path: str | None, b_path: str | None) -> tuple[bytes, bytes]:
    return _read(a_path or public_tokenizers.path(A_MODEL)), _read(b_path or public_tokenizers.path(B_MODEL))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_sizes, b_sizes), one row per input row: the ids of
    A over a space and the text, those of B over the text, and how many tokens of
    A and of B each group has, in order. Texts that are null, empty, or that
    either tokenizer does not spell byte by byte have empty lists. A null or
    repeated doc_id keeps its row; extra columns are ignored; long texts are cut
    whole, by themselves. The two model files are read on the driver."""
    return _rows(docs).mapInArrow(_align_task(*_models(a_path, b_path)), ALIGNED)


def _distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(keys) else times


def linked(doc: np.ndarray, group_a, ids_a, group_b, ids_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id pair (a * 2**32 + b) and number of links of all distinct id
    pairs of each document. ``doc``: the document of each group."""
    wide = np.int64(1) << 32
    a, times_a = _distinct(group_a * wide + ids_a, np.ones(len(ids_a), np.int64))
    b, times_b = _distinct(group_b * wide + ids_b, np.ones(len(ids_b), np.int64))
    own = a >> 32                                       # group of each distinct A id of a group
    per = np.bincount(b >> 32, minlength=len(doc))      # distinct B ids of each group
    first = _starts(per)
    count = per[own]
    upto = np.cumsum(count)
    parts, start = [], 0
    while start < len(a):  # a bounded number of pairs at once; one A id has at most the vocabulary of B
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, "right")))
        c = count[start:end]
        i = np.repeat(np.arange(start, end), c)
        j = first[own[i]] + np.arange(len(i)) - np.repeat(_starts(c), c)
        code = ((a[i] & (wide - 1)) << 32) | (b[j] & (wide - 1))
        at, times = doc[own[i]], times_a[i] * times_b[j]
        order = np.lexsort((code, at))
        at, code, times = at[order], code[order], times[order]
        new = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (at[1:] != at[:-1])))
        parts.append((at[new], code[new], np.add.reduceat(times, new)))
        start = end
    if not parts:
        return (np.empty(0, np.int64),) * 3
    at, code, times = (np.concatenate(x) for x in zip(*parts))
    if len(parts) > 1:
        order = np.lexsort((code, at))
        at, code, times = at[order], code[order], times[order]
        new = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (at[1:] != at[:-1])))
        at, code, times = at[new], code[new], np.add.reduceat(times, new)
    return at, code, times


PROFILE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _profile_task():
    """Digests and distinct pairs of aligned documents."""

    def run(batches):
        marks, words = [",", "|", ";", ""], pa.array([], pa.large_string())
        for batch in batches:
            start = 0
            lengths = [pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(1, 5)]
            while start < batch.num_rows:
                end, size = start, 0
                while end < batch.num_rows and (end == start or size + lengths[0][end] <= SIZE // 2):
                    size += lengths[0][end]
                    end += 1
                part = batch.slice(start, end - start)
                ids_a, ids_b, per_a, per_b = (part.column(c).flatten().to_numpy().astype(np.int64) for c in range(1, 5))
                n_a, n_b, n_groups = (x[start:end] for x in lengths[:3])
                doc = np.repeat(np.arange(end - start), n_groups)
                group_a, group_b = np.repeat(np.arange(len(per_a)), per_a), np.repeat(np.arange(len(per_b)), per_b)
                known, top = len(words) // 4, int(max(ids_a.max(initial=0), ids_b.max(initial=0)))
                if top >= known:
                    words = pa.array([str(i) + m for i in range(max(top + 1, 1 << 16)) for m in marks], pa.large_string())
                # all tokens, by group, A before B; each with the mark that follows it
                place_a = np.arange(len(ids_a)) + _starts(per_b)[group_a]
                place_b = np.arange(len(ids_b)) + np.cumsum(per_a)[group_b]
                code = np.zeros(len(ids_a) + len(ids_b), np.int64)
                code[place_a], code[place_b] = 4 * ids_a, 4 * ids_b
                code[np.cumsum(per_a) + _starts(per_b) - 1] += 1
                code[np.cumsum(per_a + per_b) - 1] += 2
                tokens = n_a + n_b
                code[(np.cumsum(tokens) - 1)[tokens > 0]] += 1
                at = pa.array(np.cumsum([0, *tokens], dtype=np.int64))
                spelt = pc.binary_join(pa.LargeListArray.from_arrays(at, words.take(pa.array(code))), pa.scalar("", pa.large_string()))
                sums = [hashlib.sha256(s.as_buffer()).hexdigest() if n else "" for s, n in zip(spelt.cast(pa.large_binary()), tokens)]
                where, pairs, times = linked(doc, group_a, ids_a, group_b, ids_b)
                links = np.zeros(end - start, np.int64)
                np.add.at(links, doc, per_a * per_b)
                at = pa.array(np.cumsum([0, *np.bincount(where, minlength=end - start)], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(links), pa.array(sums, pa.string()),
                     pa.ListArray.from_arrays(at, pa.array(pairs)), pa.ListArray.from_arrays(at, pa.array(times))],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                start = end

    return run


def link_counts(profiles: DataFrame) -> DataFrame:
    """(pair, n_docs, best): how many rows hold each id pair linked, and whether
    no other pair of its A id is held by more."""
    counts = profiles.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = save(counts.withColumn("a", F.shiftright("pair", 32)))
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))  # one row an A id: bounded by its vocabulary
    return counts.join(F.broadcast(most), "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _floor(counts: DataFrame) -> int:
    """The smallest power of two that at most FREQUENT pairs reach."""
    sizes = {r["k"]: r["n"] for r in counts.groupBy((F.length(F.bin("n_docs")) - 1).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, k = 0, 63
    while k and total + sizes.get(k - 1, 0) <= FREQUENT:
        k -= 1
        total += sizes.get(k, 0)
    return 1 << k if k < 63 else (1 << 63) - 1


def link_statistics(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one
    row per input row, of the groups that ``align`` gives: tokens, groups and
    links; links whose id pair no other of its A id is held by more documents; the
    sum of the pairs' document counts over the links; SHA-256 of the groups' ids.
    A document without tokens has zeros and an empty sum."""
    spark = docs.sparkSession
    out = f"{ensure_checkpoint_dir(spark)}/align-{uuid.uuid4().hex}"
    cut_up, profile = _align_task(*_models(a_path, b_path)), _profile_task()
    # one task function after the other in one worker: the tokens never leave it
    rows = _rows(docs).mapInArrow(lambda batches: profile(cut_up(batches)), PROFILE)
    rows.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(out)
    profiles = spark.read.parquet(out)
    counts = link_counts(profiles)
    floor = _floor(counts)
    own = profiles.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    frequent = F.broadcast(counts.where(F.col("n_docs") >= floor))
    rest = own.join(frequent.select("pair"), "pair", "left_anti").join(counts.where(F.col("n_docs") < floor), "pair")
    found = own.join(frequent, "pair").unionByName(rest).groupBy("row").agg(
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"))
    zero = F.lit(0).cast("long")
    return profiles.join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
