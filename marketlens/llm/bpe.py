"""BPE encoding by forced-boundary splitting, and decoding.

A merge makes a token of the vocabulary, so two neighbouring bytes that stand
side by side in no token of it are never merged into one: between them is a
certain cut, whatever lies around. Words are split at all certain cuts, the
fragments are encoded independently, and their ids put one after the other are
the ids of the word. Byte pairs at the end of a word are pairs of their own, as
the vocabulary marks ends of words.

Texts become words by the model's normaliser (NFC, white space, lower case) and
its pattern, neither of which reaches over white space. So the strings between
white space are encoded once, many at a time, and kept in a bounded table; a
text's ids are looked up. Characters that Python's tables treat otherwise than
the model's library send their text through the library's own normaliser and
splitter.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "word_bpe_49k.json"
END = "</w>"
CACHE = 200_000      # strings kept, twice
LONG = 64            # longer fragments are merged, and longer strings looked up, by themselves
BLOCK = 8192         # strings encoded at once
SIZE = 1_000_000     # characters encoded at once, a longer text by itself
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed: the model's own pattern
_WORDS, _WORDS_OF = regex.compile(WORD), regex.compile(WORD + "|\n")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: bytes
    that print stand for themselves, the others follow from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(rest)) for b in range(256)]


class Model:
    """A byte-level BPE vocabulary with ends of words."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(blob.decode())
        spec = json.loads(blob)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        # symbols: a byte, or (from 256 on) a byte at the end of a word
        self.symbol_id = np.array([vocab[c + end] for end in ("", END) for c in letters], np.int64)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs] + [-1], np.int64)  # by rank
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        codes = np.array([vocab[a] * len(self.tokens) + vocab[b] for a, b in pairs], np.int64)
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        #: can a byte and the symbol after it lie in one token?
        self.joined = np.zeros((256, 512), bool)
        for token in vocab:
            own = [self.byte_of[c] for c in token.removesuffix(END)]
            if token.endswith(END):
                own[-1:] = [x + 256 for x in own[-1:]]
            for x, y in zip(own, own[1:]):
                self.joined[x, y] = True
        self.spelling = pa.array(self.tokens, pa.large_string())

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, or the number of merges."""
        code = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.order[at], len(self.codes))


def merge_long(ids: list[int], model: Model) -> list[int]:
    """Encodes one long fragment: the merge of lowest rank first, of these the leftmost."""
    rank_of, made, n = model.rank.get, model.made, len(ids)
    after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
    heap = [(r, i) for i, p in enumerate(zip(ids, ids[1:])) if (r := rank_of(p)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if gone[i] or (j := after[i]) >= n or rank_of((ids[i], ids[j])) != r:
            continue
        ids[i], gone[j], after[i] = int(made[r]), True, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := rank_of((ids[i], ids[after[i]]))) is not None:
                heapq.heappush(heap, (r, i))
        if before[i] >= 0 and (r := rank_of((ids[before[i]], ids[i]))) is not None:
            heapq.heappush(heap, (r, before[i]))
    return [x for x, out in zip(ids, gone) if not out]


def merge_all(ids: np.ndarray, starts: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Encodes fragments, each by itself: in every round each of them makes its
    merge of lowest rank, the leftmost of these. Returns ids and their fragments."""
    none = len(model.codes)
    fragment = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
    rank = np.full(len(ids), none)
    inside = np.flatnonzero(fragment[:-1] == fragment[1:])
    rank[inside] = model.ranks(ids[inside], ids[inside + 1])
    done = []
    while len(ids):
        best = np.minimum.reduceat(rank, starts)
        size = np.diff(np.append(starts, len(ids)))
        if (best == none).any():  # these are finished
            out = np.repeat(best == none, size)
            done.append((ids[out], fragment[out]))
            ids, fragment, rank = ids[~out], fragment[~out], rank[~out]
            size, best = size[best < none], best[best < none]
            starts = np.cumsum(size) - size
            if not len(ids):
                break
        at = np.flatnonzero(rank == np.repeat(best, size))
        at = at[np.append(True, fragment[at[1:]] != fragment[at[:-1]])]
        ids[at] = model.made[rank[at]]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, fragment, rank = ids[keep], fragment[keep], rank[keep]
        starts = starts - np.arange(len(starts))
        at = at - np.arange(len(at))  # one id has gone in each fragment before
        near = np.concatenate([at, at[at > 0] - 1])
        rank[near] = none
        near = near[near + 1 < len(ids)]
        near = near[fragment[near] == fragment[near + 1]]
        rank[near] = model.ranks(ids[near], ids[near + 1])
    ids, fragment = (np.concatenate(x) for x in zip(*done)) if done else (ids, fragment)
    order = np.argsort(fragment, kind="stable")
    return ids[order], fragment[order]


def cuts(words: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words put one after the other: their symbols, where fragments start,
    and the first fragment of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    ends = np.cumsum(lengths)
    left = symbols.copy()
    symbols[ends - 1] += 256
    cut = np.ones(len(symbols), bool)
    cut[1:] = ~model.joined[left[:-1], symbols[1:]]
    cut[ends[:-1]] = True
    starts = np.flatnonzero(cut)
    return symbols, starts, np.searchsorted(starts, ends - lengths)


def encode_words(words: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and the number of ids up to each."""
    if not words:
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    symbols, starts, first = cuts(words, model)
    ids, sizes = model.symbol_id[symbols], np.diff(np.append(starts, len(symbols)))
    long = np.flatnonzero(sizes > LONG)
    if not len(long):
        ids, fragment = merge_all(ids, starts, model)
    else:
        short = np.flatnonzero(sizes <= LONG)
        part, own = merge_all(ids[np.repeat(sizes <= LONG, sizes)], np.cumsum(sizes[short]) - sizes[short], model)
        parts, owners = [part], [short[own]]
        for f in long.tolist():
            parts.append(np.array(merge_long(ids[starts[f]:starts[f] + sizes[f]].tolist(), model)))
            owners.append(np.full(len(parts[-1]), f))
        ids, fragment = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(fragment, kind="stable")
        ids, fragment = ids[order], fragment[order]
    return ids.astype(np.uint32), np.append(np.searchsorted(fragment, first), len(ids))


class Encoder:
    """Ids of many texts, with a bounded table of strings between white space."""

    def __init__(self, model: Model):
        self.m = model
        self.new: dict = {}
        self.old: dict = {}
        self.alike: dict[str, bool] = {}

    # -- texts to strings -------------------------------------------------
    def _agrees(self, c: str) -> bool:
        """Do Python's tables treat the character as the library does?"""
        hit = self.alike.get(c)
        if hit is None:
            own, lib = c.lower() if not c.isspace() else " ", self.m.library
            hit = self.alike[c] = unicodedata.category(c) != "Cn" and lib.normalizer.normalize_str(c) == own and all(
                len(lib.pre_tokenizer.pre_tokenize_str(x)) == len(_WORDS.findall(x)) for x in ("a" + c, c + c))
        return hit

    def _split(self, part: str, plain: bool) -> list:
        """Strings between white space; words as bytes where the library splits."""
        if plain:
            return part.split()
        lib, byte_of = self.m.library, self.m.byte_of
        return [bytes(byte_of[c] for c in w) for w, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(part))]

    def _keys(self, text: str, odd: set[str]) -> list:
        """What the text is looked up by; special tokens as their ids."""
        plain = (not odd or odd.isdisjoint(text)) and unicodedata.is_normalized("NFC", text)
        if not self.m.split or not self.m.split.search(text):
            return self._split(text, plain)
        out, at = [], 0
        for hit in self.m.split.finditer(text):
            out += self._split(text[at:hit.start()], plain)
            out.append(self.m.special[hit.group()])
            at = hit.end()
        return out + self._split(text[at:], plain)

    # -- strings to ids ---------------------------------------------------
    def _learn(self, strings: list) -> None:
        """Encodes new strings, each of one or more words."""
        text = [x for x in strings if isinstance(x, str)]
        whole = [x for x in strings if isinstance(x, bytes)]
        # lower case letter by letter: the library has no final sigma
        found = _WORDS_OF.findall("\n".join([*text, ""]).replace("Σ", "σ").lower())
        words, last = [], []  # last: words up to the end of each string
        for w in found:
            if w == "\n":
                last.append(len(words))
            else:
                words.append(w.encode())
        ids, upto = encode_words(words + whole, self.m)
        stops = upto[last + list(range(len(words) + 1, len(words) + len(whole) + 1))].tolist()
        blob = ids.astype("<u4").tobytes()
        self.new.update((x, blob[4 * i:4 * j]) for x, i, j in zip(text + whole, [0, *stops], stops))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        odd = {c for c in set().union(*map(set, texts)) if not self._agrees(c)}
        keys = [self._keys(t, odd) for t in texts]
        new, old, missing = self.new, self.old, []
        for x in set().union(*keys) - new.keys():
            if isinstance(x, int):
                new[x] = np.array([x], "<u4").tobytes()
            elif x in old:
                new[x] = old[x]
            else:
                missing.append(x)
        for i in range(0, len(missing), BLOCK):
            self._learn(missing[i:i + BLOCK])
        out = [b"".join(map(new.__getitem__, ks)) for ks in keys]
        for x in missing:
            if len(x) > LONG:
                del new[x]
        if len(new) >= CACHE:
            self.old, self.new = new, {}
        return out


def decode(ids, model: Model) -> str:
    """The tokens, special ones too, with spaces between: the model names no decoder."""
    return " ".join(model.tokens[i] for i in ids)


def _task(blob: bytes, packed: bool):
    def run(batches):
        model = Model(blob)
        encoder = Encoder(model)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            start = 0
            while start < b.num_rows:
                end, size = start, 0
                while end < b.num_rows and (end == start or size + len(texts[end]) <= SIZE):
                    size += len(texts[end])
                    end += 1
                blobs = encoder(texts[start:end])
                ids = pa.array(np.frombuffer(b"".join(blobs), "<i4"))
                at = pa.array(np.cumsum([0, *(len(x) // 4 for x in blobs)], dtype=np.int64))
                decoded = pc.binary_join(pa.LargeListArray.from_arrays(at, model.spelling.take(ids)), pa.scalar(" ", pa.large_string()))
                column = pa.array(blobs, pa.binary()) if packed else pa.LargeListArray.from_arrays(at, ids).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), column, decoded.cast(pa.string())], ["doc_id", "ids", "decoded"])
                start = end

    return run


def encode(docs: DataFrame, model_path: str | None = None, packed: bool = False) -> DataFrame:
    """(doc_id, ids, decoded), one row per input row: the ids of the whole text
    (``packed``: as little-endian unsigned 32-bit integers in a binary, else as
    an array) and the text that they decode to. Strings of special tokens in a
    text are those tokens. Null texts count as empty, which have no ids; a null
    or repeated doc_id keeps its row; extra columns are ignored. Very long texts
    are encoded whole, by themselves. The model file, one vocabulary, is read on
    the driver."""
    with open(model_path or public_tokenizers.path(MODEL), "rb") as f:
        blob = f.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_task(blob, packed), f"doc_id long, ids {'binary' if packed else 'array<int>'}, decoded string")


def decode_documents(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, decoded) of (doc_id, ids) with ids as arrays; null ids decode to the empty text."""
    with open(model_path or public_tokenizers.path(MODEL), "rb") as f:
        blob = f.read()

    def run(batches):
        model = Model(blob)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(i or [], model) for i in b.column(1).to_pylist()], pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Token counts and SHA-256 sums of packed ids and decoded texts."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
