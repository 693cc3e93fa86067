"""Text features of the trained classifiers: hashed words and word beginnings,
and a few densities. Everything is computed from the whole text."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa

BITS = 20
PREFIXES = (3, 4, 5, 6)
TOGETHER = 1_000_000     # characters of texts whose words are hashed at once
TABLE = 32               # texts whose features are told apart at once
LONG_WORD = 64           # bytes of words hashed by themselves
_WORD = re.compile(r"\w+")
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"?", b"|", b"%#$&*@^~=<>", b".,;:", b"\n")
_WORD_BYTE = np.array([b >= 0x80 or bool(_WORD.match(chr(b))) for b in range(256)])


def densities(text: str) -> list[float]:
    """Shares of character classes, word lengths and repetition; a text without
    words gives zeros but for its length."""
    data = text.encode()
    n = max(1, len(data))
    shares = [(len(data) - len(data.translate(None, c))) / n for c in _CLASSES]
    words = text.split()
    k = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    return [*[s ** 0.5 for s in shares], np.log1p(len(data)), np.log1p(len(words)), min(len(data) / k, 50.0),
            len(set(words)) / k, len(set(lines)) / max(1, len(lines)), sum(map(str.isupper, words)) / k]


N_DENSE = len(densities(""))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ 0xEDB88320, table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: bytes = b"") -> np.ndarray:
    """CRC-32 of stretches of bytes, each put behind ``before``."""
    size = ends - starts
    out = np.full(len(size), zlib.crc32(before) ^ 0xFFFFFFFF, np.uint32)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]], zlib.crc32(before)) ^ 0xFFFFFFFF
    order = np.argsort(size, kind="stable")
    order = order[np.searchsorted(size[order], 1):np.searchsorted(size[order], LONG_WORD, "right")]
    at, size, state = starts[order], size[order], out[order]
    first = np.searchsorted(size, np.arange(1, LONG_WORD + 1))  # of those that have a byte of each number
    for k, i in enumerate(first.tolist()):
        if i == len(size):
            break
        state[i:] = _CRC[(state[i:] ^ data[at[i:] + k]) & 0xFF] ^ state[i:] >> 8
    out[order] = state
    return out ^ np.uint32(0xFFFFFFFF)


class Hasher:
    """Distinct hashed features of texts, or those of them that are in ``only``;
    every distinct word of many texts is hashed once."""

    def __init__(self, only: np.ndarray | None = None):
        self.only = None if only is None else np.isin(np.arange(1 << BITS), only)
        self._in_words = np.full(0x110000, -1, np.int8)  # of characters seen so far
        self._some, self._place = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, np.int32)

    def __call__(self, text: str) -> np.ndarray:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The features of each text, in order."""
        out, start = [], 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size < TOGETHER):
                size += len(texts[end])
                end += 1
            out += self._features(texts[start:end])
            start = end
        return out

    def _words(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The words of all texts, lower-cased, and the number of words before
        each text; words are those of ``_WORD``."""
        blobs = [t.lower().encode() for t in texts]
        data = np.frombuffer(b"\0".join([*blobs, b""]), np.uint8)
        inside = _WORD_BYTE[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):  # characters of several bytes
            head, size = data[lead].astype(np.int64), 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
            code = head & (0x7F >> size)
            for k in range(1, 4):
                more = size > k
                code[more] = code[more] << 6 | data[lead[more] + k] & 0x3F
            for c in np.unique(code[self._in_words[code] < 0]).tolist():
                self._in_words[c] = bool(_WORD.match(chr(c)))
            out = self._in_words[code] == 0
            for k in range(4):
                inside[lead[out & (size > k)] + k] = False
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # the last byte stands between texts
        starts, ends = edges[::2], edges[1::2]
        offsets = np.cumsum(np.r_[0, ends - starts], dtype=np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
        return words, np.searchsorted(starts, np.cumsum([0, *(len(b) + 1 for b in blobs)]))

    def _hashes(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The features of words, one after the other, and how many each has."""
        _, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * words.offset)
        data = np.frombuffer(data or b"", np.uint8)
        starts, ends = ends[:-1], ends[1:]
        heads = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))  # where characters begin
        first, last = np.searchsorted(heads, starts), np.searchsorted(heads, ends)
        ids = np.empty((len(words), 1 + len(PREFIXES)), np.int64)
        held = np.ones(ids.shape, bool)
        ids[:, 0] = checksums(data, starts, ends) >> (32 - BITS)
        for k, n in enumerate(PREFIXES, 1):
            held[:, k] = own = last - first >= n
            ids[own, k] = checksums(data, starts[own], heads[first[own] + n], b"%d:" % n) >> (32 - BITS)
        if self.only is not None:
            held[held] = self.only[ids[held]]
        return ids[held], held.sum(1)

    def _features(self, texts: list[str]) -> list[np.ndarray]:
        words, first = self._words(texts)
        coded = words.dictionary_encode()
        flat, size = self._hashes(coded.dictionary)
        at, begin = coded.indices.to_numpy(), np.cumsum(size) - size
        out = []
        for i in range(0, len(texts), TABLE):
            j = min(len(texts), i + TABLE)
            word = at[first[i]:first[j]]
            each = size[word]
            ids = flat[np.repeat(begin[word] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
            row = np.repeat(np.repeat(np.arange(j - i), np.diff(first[i:j + 1])), each)
            # a table of the texts and the features that any of them has
            self._some[ids] = True
            some = np.flatnonzero(self._some)
            self._some[some] = False
            self._place[some] = np.arange(len(some))
            table = np.zeros((j - i) * len(some), bool)
            table[row * len(some) + self._place[ids]] = True
            row, column = np.divmod(np.flatnonzero(table), max(1, len(some)))
            out += np.split(some[column], np.searchsorted(row, np.arange(1, j - i)))
        return out


def select(rows: list[np.ndarray], label: np.ndarray, most: int) -> np.ndarray:
    """The hashed features whose document shares differ most between labels."""
    size = 1 << BITS
    ids = np.concatenate(rows) if rows else np.empty(0, np.int64)
    owner = np.repeat(label, [len(r) for r in rows])
    one = np.bincount(ids[owner == 1], minlength=size)
    zero = np.bincount(ids[owner == 0], minlength=size)
    n1, n0 = max(1, (label == 1).sum()), max(1, (label == 0).sum())
    p = (one + zero + 1) / (n1 + n0 + 2)
    z = np.abs((one + 0.5) / (n1 + 1) - (zero + 0.5) / (n0 + 1)) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    z[one + zero < 3] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(best[z[best] > 3])


def columns(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """0/1 matrix of the chosen features, which are in order."""
    out = np.zeros((len(rows), len(chosen)), np.float32)
    if rows and len(chosen):
        ids, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        at = np.minimum(np.searchsorted(chosen, ids), len(chosen) - 1)
        held = chosen[at] == ids
        out[owner[held], at[held]] = 1
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
