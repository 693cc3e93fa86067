"""SentencePiece encoding with the n best segmentations, and decoding.

The pieces of a text form a lattice. Forward Viterbi scores give for every
position the best score up to it; searching backwards from the end, they are
the exact cost of what is still to come, so an A* search pops segmentations in
order of their scores.

No piece crosses the start of a word (spaces are written as U+2581 and stand
first in pieces) or joins a letter to most punctuation, which is read off the
vocabulary, so the lattice falls apart into words: their forward and
backward scores are computed for many distinct words at once and kept in a
bounded table. The best segmentation of a text joins its words' best ones; the
others differ in few words, those whose second-best segmentation costs least,
and only these words are searched further.

The piece scores: a unigram model's own log probabilities; a BPE model holds
merge ranks, which become log probabilities by Zipf's law. Characters without
a piece are spelt in byte pieces. Encoding is lossless: decoding gives the text
back.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NBEST = 3
CACHE = 150_000     # words whose best segmentation is kept, twice
LONG_WORD = 48      # longer words go through the search by themselves
BLOCK = 2048        # words of like length searched at once
LEARNT = 16384      # new words searched before they are stored
BYTE_LOSS = 10.0    # a byte piece scores so much less than the rarest piece
MARKS = ",.;:!?|\n"   # where a word may end, if no piece of the model joins them to a letter
LETTER = "[A-Za-z\u00c0-\u024f]"
TOGETHER = 500_000   # characters of texts searched at once
FINE = 1 << 20      # scores are summed in multiples of its inverse, and the rest by itself
_WORD = re.compile(f"{SPACE}*+[^{SPACE}]*+")
_LETTER = np.array([bool(re.match("[A-Za-z]", chr(b))) for b in range(256)])  # bytes of LETTER
_LEADS = np.isin(np.arange(256), np.arange(0xC3, 0xC9))  # any that follows makes a LETTER; behind 0xC9 up to 0x8F


class Vocabulary:
    """Pieces with their scores, and the byte pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [sp.id_to_piece(i) for i in range(len(sp))]
        self.byte_id = {}
        scores = np.array([sp.get_score(i) for i in range(len(sp))])
        ranks = len(scores) and float(scores.min()) < -1000  # merge ranks, not log probabilities
        self.score: dict[str, tuple[float, int]] = {}
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[p] = (-math.log(2.0 - scores[i]) - math.log(math.log(len(sp) + 2.0)) if ranks else float(scores[i]), i)
        crossing = [p for p in self.score if SPACE in p.lstrip(SPACE)]
        for p in crossing:  # would span two words
            del self.score[p]
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces")
        self.longest = max(map(len, self.score))
        self.floor = min(s for s, _ in self.score.values()) - BYTE_LOSS
        self.id_of_byte = np.array([self.byte_id[b] for b in range(256)])
        self.bytes_of = [b"" if i in (0, 1, 2) else p.encode() for i, p in enumerate(self.pieces)]
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])
        byte_ids = set(self.byte_id.values())
        joined = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        apart = [c for c in MARKS if not any(re.match(LETTER, x) and x[1] == c for x in joined)]
        ahead = "" if any(x[0] == "\n" and re.match(LETTER, x[1]) for x in joined) else f"|(?<=\n)(?={LETTER})"
        self.cut = re.compile(f"(?<={LETTER})(?=[{re.escape(''.join(apart))}]){ahead}") if apart else None
        self.ends_word = np.zeros(256, bool)  # the same for bytes
        self.ends_word[list("".join(apart).encode())] = True
        self.cuts_lines = bool(apart and ahead)
        self.space_of = [None if i in byte_ids else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        self._index()

    def _index(self):
        """Arrays for the batch search: polynomial hashes of the pieces by
        length, sorted, and a bitmap that most other strings fail."""
        self.base = np.uint64(0x9E3779B97F4A7C15)
        by_hash = {}
        for p, (s, i) in self.score.items():
            h = 0
            for c in p:
                h = (h * int(self.base) + ord(c) + 1) % (1 << 64)
            by_hash[h] = (s, i)
        self.hashes = np.array(sorted(by_hash), np.uint64)
        self.hash_score = np.array([by_hash[h][0] for h in self.hashes.tolist()])
        self.hash_id = np.array([by_hash[h][1] for h in self.hashes.tolist()])
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[self._slot(self.hashes)] = True
        starts = set()  # hashes of all beginnings of pieces
        for p in self.score:
            h = 0
            for c in p:
                h = (h * int(self.base) + ord(c) + 1) % (1 << 64)
                starts.add(h)
        self.beginnings = np.zeros(1 << 20, bool)
        self.beginnings[self._slot(np.array(sorted(starts), np.uint64))] = True
        byte_len = np.ones(0x110000, np.int8)
        byte_len[0x80:] = 2
        byte_len[0x800:] = 3
        byte_len[0x10000:] = 4
        self.byte_len = byte_len

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(44)

    # -- one word at a time ---------------------------------------------
    def edges_to(self, word: str, end: int):
        """(start, score, piece or None) of the lattice's edges that end at
        ``end``; None stands for the last character's byte pieces."""
        for n in range(1, min(self.longest, end) + 1):
            hit = self.score.get(word[end - n:end])
            if hit:
                yield end - n, hit[0], hit[1]
            elif n == 1:
                yield end - 1, self.floor * len(word[end - 1].encode()), None

    def forward(self, word: str) -> list[float]:
        """Best score of a segmentation of every beginning of the word."""
        best = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            best[end] = max(best[s] + x for s, x, _ in self.edges_to(word, end))
        return best

    def n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations, best first."""
        best = self.forward(word)
        # (cost in all, position, turn, ids so far from the end, score so far);
        # of equal costs the one nearest to the start goes on, so that ties
        # don't widen the search
        heap, out, turn = [(-round(best[-1], 9), len(word), 0, (), 0.0)], [], 0
        while heap and len(out) < n:
            _, at, _, ids, done = heapq.heappop(heap)
            if at == 0:
                flat, rest = [], ids
                while rest:
                    piece, rest = rest
                    flat.extend(piece)
                out.append((done, tuple(flat)))
                continue
            for s, x, piece in self.edges_to(word, at):
                own = (piece,) if piece is not None else tuple(int(self.id_of_byte[b]) for b in word[s].encode())
                turn += 1
                heapq.heappush(heap, (-round(best[s] + x + done, 9), s, turn, (own, ids), done + x))
        return out

    # -- many words at once ---------------------------------------------
    def best_of(self, words: list[str]) -> list[tuple[float, tuple[int, ...], float]]:
        """(score, ids, loss of the second-best) for each word; infinite loss
        where there is one segmentation only."""
        return [(score, tuple(np.frombuffer(ids, np.int32).tolist()), loss) for score, ids, loss in self.best_packed(words)]

    def best_packed(self, words: list[str]) -> list[tuple[float, bytes, float]]:
        """The same with the ids as 4-byte integers."""
        out: list = [None] * len(words)
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) > LONG_WORD:
                two = self.n_best(w, 2)
                out[k] = (two[0][0], pack(two[0][1]), two[0][0] - two[1][0] if len(two) > 1 else math.inf)
            else:
                groups.setdefault(-(-len(w) // 4) * 4, []).append(k)
        for width, which in groups.items():
            for i in range(0, len(which), BLOCK):
                part = which[i:i + BLOCK]
                self._best_block([words[k] for k in part], width, part, out)
        return out

    def _best_block(self, words, width, which, out):
        # arrays by position, then word: every step works on whole rows
        m = len(words)
        size = np.array([len(w) for w in words])
        code = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(m, width)
        code = np.ascontiguousarray(code.T)
        inside = np.arange(width)[:, None] < size
        most, every = min(self.longest, width), np.arange(m)
        score = np.full((most, width, m), -np.inf)  # of the piece from a position, by its length
        piece = np.full((most, width, m), -1, np.int32)
        unit = code.ravel().astype(np.uint64) + np.uint64(1)
        seen = [set() for _ in range(most + 1)]  # positions with a piece of each length
        seen[1].update(range(width))
        # a position goes on to the next length while its characters begin a piece
        live = np.flatnonzero(inside.ravel())
        h, known = np.zeros(len(live), np.uint64), inside.ravel()
        for n in range(1, most + 1):
            if n > 1:
                live, h = live[live < (width - n + 1) * m], h[live < (width - n + 1) * m]
                on = known[live + (n - 1) * m]
                live, h = live[on], h[on]
            h = h * self.base + unit[live + (n - 1) * m]
            slot = self._slot(h)
            on = self.beginnings[slot]
            live, h, slot = live[on], h[on], slot[on]
            own = np.flatnonzero(self.bitmap[slot])
            at = np.minimum(np.searchsorted(self.hashes, h[own]), len(self.hashes) - 1)
            ok = self.hashes[at] == h[own]
            at, (r, c) = at[ok], np.divmod(live[own[ok]], m)
            if not len(at):
                continue
            score[n - 1, r, c] = self.hash_score[at]
            piece[n - 1, r, c] = self.hash_id[at]
            seen[n].update(np.unique(r).tolist())
        lost = (score[0] == -np.inf) & inside
        score[0][lost] = self.floor * self.byte_len[code[lost]]
        # forward and backward scores
        fore = np.full((width + 1, m), -np.inf)
        fore[0] = 0
        step = np.zeros((width + 1, m), np.int16)
        for end in range(1, width + 1):
            for n in [n for n in range(1, min(most, end) + 1) if end - n in seen[n]]:
                x = fore[end - n] + score[n - 1, end - n]
                better = x > fore[end]
                np.copyto(fore[end], x, where=better)
                np.copyto(step[end], n, where=better)
        back = np.full((width + 1, m), -np.inf)
        back[size, every] = 0
        for at in range(width - 1, -1, -1):
            for n in [n for n in range(1, min(most, width - at) + 1) if at in seen[n]]:
                np.maximum(back[at], score[n - 1, at] + back[at + n], out=back[at])
        total = fore[size, every]
        # the best segmentation from the end; its edges leave the lattice, and
        # the best way through what is left with one of them missing is second
        at, rows = size.copy(), every
        path = []
        while len(rows):
            n = step[at[rows], rows].astype(np.int64)
            s = at[rows] - n
            path.append((rows, s, n))
            at[rows] = s
            rows = rows[s > 0]
        rest = score.copy()
        for r, s, n in path:
            rest[n - 1, s, r] = -np.inf
        through = np.full(m, -np.inf)
        for n in [n for n in range(1, most + 1) if seen[n]]:
            x = fore[:width - n + 1] + rest[n - 1, :width - n + 1]
            x += back[n:]
            np.maximum(through, x.max(0), out=through)
        # the edges of all words in a row, from the start of each
        own, start, n = (np.concatenate(x) for x in zip(*path))
        turn = np.repeat(np.arange(len(path)), [len(r) for r, _, _ in path])
        order = np.lexsort((-turn, own))
        own, start = own[order], start[order]
        ids = piece[n[order] - 1, start, own].astype("<i4")
        lost = np.flatnonzero(ids < 0)
        if len(lost):  # a character without a piece: its bytes' pieces
            spelt = [self.id_of_byte[list(words[k][p].encode())] for k, p in zip(own[lost].tolist(), start[lost].tolist())]
            each = np.ones(len(ids), np.int64)
            each[lost] = [len(x) for x in spelt]
            at = np.cumsum(each) - each
            wide = np.repeat(ids, each)
            for i, x in zip(at[lost].tolist(), spelt):
                wide[i:i + len(x)] = x
            ids, own = wide, np.repeat(own, each)
        stops = np.searchsorted(own, every, "right").tolist()
        blob, loss = ids.tobytes(), (total - through).tolist()
        for k, w, t, i, j in zip(range(m), which, total.tolist(), [0, *stops], stops):
            out[w] = (t, blob[4 * i:4 * j], loss[k])


def pack(ids) -> bytes:
    """Piece ids as 4-byte integers."""
    return array("i", ids).tobytes()


class Segmentations:
    """The n best of one text: they share all words but a few. ``best``: the
    packed ids of each word; ``spelt``: do the pieces spell the words, and the
    words the text?"""

    def __init__(self, best: pa.LargeBinaryArray, options, ways, spelt: bool):
        self.best, self.options, self.ways, self.spelt = best, options, ways, spelt
        self.scores = [s for s, _ in ways]
        _, ends, data = best.buffers()
        self._ends = np.frombuffer(ends, np.int64, len(best) + 1, 8 * best.offset)
        self._data = memoryview(data) if data else b""

    def packed(self, rank: int = 0) -> bytes:
        """Piece ids as 4-byte integers."""
        parts, at = [], self._ends[0]
        for (k, o), j in zip(self.options.items(), self.ways[rank][1]):
            parts += [self._data[at:self._ends[k]], o[j][1]]
            at = self._ends[k + 1]
        return b"".join([*parts, self._data[at:self._ends[-1]]])

    def ids(self, rank: int = 0) -> list[int]:
        return np.frombuffer(self.packed(rank), np.int32).tolist()

    def sizes(self) -> list[int]:
        own = int(self._ends[-1] - self._ends[0]) - sum(int(self._ends[k + 1] - self._ends[k]) for k in self.options)
        return [(own + sum(len(o[j][1]) for o, j in zip(self.options.values(), c))) // 4 for _, c in self.ways]


class Encoder:
    """N-best segmentations of texts, with a bounded table of words."""

    def __init__(self, vocabulary: Vocabulary, n: int = NBEST):
        self.v, self.n = vocabulary, n
        self.new: dict = {}
        self.old: dict = {}
        self.more: dict = {}
        self.wrong: set[str] = set()
        self._spelling = pa.array(vocabulary.pieces, pa.large_string())

    @staticmethod
    def _plain(text: str) -> bool:
        """Does every space, and nothing else, stand for a mark?"""
        return "  " not in text and SPACE not in text and "\0" not in text and not text.startswith(" ")

    def _words(self, text: str) -> list[str]:
        if self._plain(text):
            if self.v.cut:  # words also end where no piece joins two characters
                text = self.v.cut.sub("\0", text)
            return (SPACE + text.replace(" ", "\0" + SPACE)).split("\0")
        # the mark itself is spelt in bytes, so it can't be taken for a space
        parts = (" " + text).split(SPACE)
        words: list[str] = []
        for i, part in enumerate(parts):
            if i:
                words.append("")
            words.extend(w for w in _WORD.findall(part.replace(" ", SPACE)) if w)
        return words

    def _plain_words(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The words of plain texts, with spaces for their marks, and the number
        of words before each text; cuts as ``_words`` does, on bytes."""
        blobs = [b" " + t.encode() for t in texts]
        blob = b"".join(blobs)
        data = np.frombuffer(blob, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)))
        found = self.v.ends_word.copy()
        found[[32, 10]] = True
        at = np.flatnonzero(found[data])
        kind = data[at]
        start = np.zeros(len(data), bool)
        start[at[kind == 32]] = True
        mark = at[self.v.ends_word[kind]]
        one, two = data[mark - 1], data[mark - 2]  # a mark stands behind a space at least
        start[mark[_LETTER[one] | (one >= 0x80) & (_LEADS[two] | (two == 0xC9) & (one <= 0x8F))]] = True
        if self.v.cuts_lines:
            line = at[kind == 10] + 1
            line = line[line < len(data)]
            one, two = data[line], data[np.minimum(line + 1, len(data) - 1)]
            start[line[_LETTER[one] | _LEADS[one] | (one == 0xC9) & (two <= 0x8F)]] = True
        starts = np.flatnonzero(start)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(blob))
        return words, np.r_[0, np.searchsorted(starts, ends)]

    def _check(self, words: list[str], blobs: list[bytes]) -> None:
        """Notes the words that their pieces don't spell."""
        ids = np.frombuffer(b"".join(blobs), np.int32)
        at = np.cumsum([0, *(len(x) // 4 for x in blobs)], dtype=np.int64)
        spelt = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), self._spelling.take(pa.array(ids))), pa.scalar("", pa.large_string()))
        same = pc.equal(spelt, pa.array(words, pa.large_string())).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(~same).tolist():  # byte pieces, mostly
            if spell(ids[at[k]:at[k + 1]].tolist(), self.v) != (words[k].replace(SPACE, " ") or SPACE):
                self.wrong.add(words[k])

    def _learn(self, words: list[str]) -> None:
        new, old = self.new, self.old
        missing = []
        for w in words:
            if w not in new:
                if w in old:
                    new[w] = old[w]
                else:
                    missing.append(w)
        missing.sort()
        for i in range(0, len(missing), LEARNT):
            part = missing[i:i + LEARNT]
            marked = [w.replace(" ", SPACE) for w in part]
            found = self.v.best_packed(marked)
            self._check(marked, [ids for _, ids, _ in found])
            new.update(zip(part, found))

    def _trim(self) -> None:
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        if len(self.more) >= CACHE // 4:
            self.more = {}

    def __call__(self, texts: list[str]) -> list[Segmentations]:
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if self._plain(t)]
        other = sorted(set(range(len(texts))).difference(plain))
        if plain:
            words, first = self._plain_words([texts[i] for i in plain])
            for i, found in zip(plain, self._texts(words, first, [True] * len(plain))):
                out[i] = found
        if other:
            split = [self._words(texts[i]) for i in other]
            first = np.cumsum([0, *map(len, split)], dtype=np.int64)
            spelt = [self._spelt(texts[i], ws) for i, ws in zip(other, split)]
            for i, found in zip(other, self._texts(pa.array([w for ws in split for w in ws], pa.large_string()), first, spelt)):
                out[i] = found
        self._trim()
        return out

    @staticmethod
    def _spelt(text: str, words: list[str]) -> bool:
        """Do the words spell the text? A mark of the text is the empty word."""
        whole = "".join(words) if SPACE not in text else "".join(w.replace(SPACE, " ") or SPACE for w in words)
        return whole == (SPACE + text.replace(" ", SPACE) if SPACE not in text else " " + text)

    def _texts(self, words: pa.LargeStringArray, first: np.ndarray, spelt: list[bool]):
        """The segmentations of texts whose words lie one after the other, each
        text's from ``first`` on; every distinct word is looked up once."""
        coded = words.dictionary_encode()
        own, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        self._learn([w for w in own if w])
        self.new[""] = (3 * self.v.floor, pack([int(self.v.id_of_byte[b]) for b in SPACE.encode()]), math.inf)
        score, best, losses = zip(*map(self.new.__getitem__, own))
        score, losses = np.array(score), np.array(losses)[at]
        best = pa.array(best, pa.large_binary()).take(coded.indices)
        # summed in two parts without rounding, so that the order does not matter
        coarse = np.round(score * FINE) / FINE
        total = (np.add.reduceat(coarse[at], first[:-1]) + np.add.reduceat((score - coarse)[at], first[:-1])).tolist()
        if self.wrong:
            wrong = np.array([w.replace(" ", SPACE) in self.wrong for w in own])[at]
            spelt = (np.array(spelt) & ~np.logical_or.reduceat(wrong, first[:-1])).tolist()
        ends = first.tolist()
        for i, j, t, s in zip(ends, ends[1:], total, spelt):
            # a segmentation of rank k differs from the best in words among the
            # k - 1 that lose least by their second-best
            loss = losses[i:j]
            few = np.argpartition(loss, self.n - 2)[:self.n - 1] if 1 < self.n <= len(loss) else np.arange(len(loss) * (self.n > 1))
            names = {k: own[at[i + k]].replace(" ", SPACE) for k in sorted(few.tolist()) if loss[k] < math.inf}
            options = {k: self._more(w) for k, w in names.items()}
            ways: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
            for o in options.values():
                ways = heapq.nsmallest(self.n, ((x + o[0][0] - y, c + (k,)) for x, c in ways for k, (y, _) in enumerate(o)))
            yield Segmentations(best.slice(i, j - i), options, [(t - x, c) for x, c in ways], s and self.wrong.isdisjoint(names.values()))

    def _more(self, word: str):
        hit = self.more.get(word)
        if hit is None:
            found = self.v.n_best(word, self.n)
            if any("".join([self.v.pieces[i] for i in ids]) != word and spell(ids, self.v) != (word.replace(SPACE, " ") or SPACE) for _, ids in found):
                self.wrong.add(word)
            hit = self.more[word] = [(score, pack(ids)) for score, ids in found]
        return hit


def spell(ids, vocabulary: Vocabulary) -> str:
    """What pieces stand for, spaces and all."""
    v, out, run = vocabulary, [], bytearray()
    for i in ids:
        s = v.space_of[i]
        if s is None:
            run += v.bytes_of[i]
        else:
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(s)
    if run:
        out.append(run.decode("utf-8", "replace"))
    return "".join(out)


def decode(ids, vocabulary: Vocabulary) -> str:
    """The text of piece ids; the space put before the text is removed."""
    text = spell(ids, vocabulary)
    return text[1:] if text.startswith(" ") else text


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def spellings(vocabulary: Vocabulary) -> pa.Array:
    """What each piece stands for, in bytes; those of a text spell it when put
    one after the other."""
    return pa.array([b if s is None else s.encode() for s, b in zip(vocabulary.space_of, vocabulary.bytes_of)], pa.large_binary())


def _task(model: bytes, n: int, at: int):
    vocabulary = Vocabulary(model)  # once, not in every task

    def run(batches):
        encoder, spelling = Encoder(vocabulary, n), spellings(vocabulary)
        for b in batches:
            start = 0
            texts = [t or "" for t in b.column(at).to_pylist()]
            while start < b.num_rows:  # by size, so that long texts come alone
                end, size = start, 0
                while end < b.num_rows and (end == start or size < TOGETHER):
                    size += len(texts[end])
                    end += 1
                own = texts[start:end]
                found = encoder(own)
                ways = np.array([len(f.scores) for f in found])
                blobs = [f.packed(k) for f in found for k in range(len(f.scores))]
                ends = pa.array(np.cumsum([0, *(len(x) // 4 for x in blobs)], dtype=np.int32))
                first = np.cumsum([0, *ways], dtype=np.int32)
                ids = pa.array(np.frombuffer(b"".join(blobs), np.int32))
                nbest = pa.ListArray.from_arrays(pa.array(first), pa.ListArray.from_arrays(ends, ids))
                # all of them are decoded, and compared with the text
                texts_back = pc.binary_join(pa.ListArray.from_arrays(ends, spelling.take(ids)), pa.scalar(b"", pa.large_binary()))
                asked = pa.array([b" " + t.encode() for t in own], pa.large_binary()).take(pa.array(np.repeat(np.arange(len(own)), ways)))
                back = pa.array(np.logical_and.reduceat(pc.equal(texts_back, asked).to_numpy(zero_copy_only=False), first[:-1]))
                scores = pa.array([f.scores for f in found], pa.list_(pa.float64()))
                sizes = pa.array([f.sizes() for f in found], pa.list_(pa.int32()))
                part = b.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([part.column(0), nbest, scores, sizes, back], ["doc_id", *NEW])
                start = end

    return run


NEW = ("nbest_ids", "nbest_scores", "nbest_sizes", "round_trip")


def encode(docs: DataFrame, model_path: str = MODEL_PATH, n: int = NBEST) -> DataFrame:
    """(doc_id, ids, nbest_ids, nbest_scores, nbest_sizes, round_trip), one row
    per input row: piece ids of the best segmentation; ids, scores and piece
    counts of the ``n`` best (fewer if there are fewer); and whether each of
    them, decoded, is the text. Null texts count as empty, which have the one segmentation of the
    space that is put before every text; a null doc_id keeps its row. Extra
    columns are ignored. The model file is read on the driver; its size is that
    of one vocabulary."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(_task(read_model(model_path), n, 1),
                          "doc_id long, nbest_ids array<array<int>>, nbest_scores array<double>, nbest_sizes array<int>, round_trip boolean")
    return out.select("doc_id", F.get("nbest_ids", F.lit(0)).alias("ids"), *NEW)


def decode_documents(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    model = read_model(model_path)

    def run(batches):
        v = Vocabulary(model)
        for b in batches:
            texts = [decode(i or [], v) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
