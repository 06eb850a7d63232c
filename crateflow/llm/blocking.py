"""Candidate pairs of bags of words: every two bags that the channel model may take as writings of one recording.

Level 1: a bag's keys are its pairs of whole words, for bags of three words or fewer also one whole word with the first
letters of the others (of those that can't be mistyped light words), and all its letters (which stay the same if words are
run together). A key is a sum of hashes, so a batch's keys are made by NumPy at once. Bags that differ in at most five words
share at least four of their nine words of smallest hash (prefix filtering), so longer bags need no more than these nine.

A key under which more than ``block`` right bags stand is crowded and replaced by finer ones, again and again: the key with
one more whole word, or with what one more word may be typed as (letters left out, its beginning, its first letter for an
initial, all remaining letters); under the latter only bags meet whose words differ there. Any two bags within the channel's
limit that share a key share a finer one: with two or more words left one of them differs by one edit at most, as two edits
each would exceed the limit, and a last word is met up to as many edits as the channel allows. Words run together and
misspelt besides, under a crowded key, are the one exception.

Very frequent keys are found in each batch before the shuffle and never meet in one task. Pairs that the looks of their words
rule out are left out where they meet, all at once in NumPy; the channel weighs the others on the spot.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.recordings import CANNOT, INITIAL, JOINED, LIGHT, LIMIT, LOST, SHORTENED, TYPO, _lost, _lost_word, _mark, _run_together, channel_cost, is_near_article, is_near_light, word_cost
from crateflow.session import plain_unions, written

#: Right bags that may share a key before finer keys are used; so many times as many left ones.
BLOCK, LEFT_TIMES = 512, 32
#: So many times as many where only bags with different words meet; numbers that tell such words apart, in bits 12 to 31 of meta.
TYPED_TIMES, TYPED = 8, (1 << 20) - 2
BUCKET_FORMS = 10_000
#: Words that the keys of a bag are made of: 5 differing ones and 4 shared ones.
KEY_WORDS = 9
#: After so many refinements all words of a bag stand in its key and the rest is multiplied out.
LEVELS = 8
LEFT, RIGHT, HOT = 1, 2, 4
#: Kinds of keys in the lowest bits: may be refined, or is complete.
OPEN, CLOSED = 0, 1
_ROWS = "bucket int, packed binary"
#: Stands between a form and its version, if it has one.
SIGN = "\x1f"
#: Words of a bag that pairs are weighed by at once, words of them that may differ, and letters of a word; the channel is asked about others.
SEEN, FEW, LETTERS = 10, 5, 24
TYPOS = np.array([TYPO * d for d in range(5)])


@lru_cache(maxsize=1 << 12)
def _letter(c: str) -> int:
    return _mark("letters", c)


@lru_cache(maxsize=1 << 15)
def _traits(w: str) -> tuple[int, int, int, bool, bool, bool]:
    """Hashes of a word, its first letter and its letters; is it light, near light, whole."""
    letters = sum(map(_letter, w)) & ((1 << 64) - 1)
    return _mark("word", w) & ~1, _mark("letter", w[0]), letters, w in LIGHT and len(w) > 1, is_near_light(w), len(w) > 1 and w[-1] != "*"


def _table(form: pa.Array, version: pa.Array) -> dict:
    """The words of a batch of bags with their traits, and the words that its keys are made of."""
    lists = pc.split_pattern(form.combine_chunks() if isinstance(form, pa.ChunkedArray) else form, " ")
    flat = lists.flatten().dictionary_encode()
    code = flat.indices.to_numpy()
    cols = list(zip(*map(_traits, flat.dictionary.to_pylist()), strict=True)) if len(flat.dictionary) else [()] * 6
    word, first, letters = (np.array(c, np.uint64)[code] for c in cols[:3])
    light, near, whole = (np.array(c, bool)[code] for c in cols[3:])
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    count = lambda m: np.bincount(row[m], minlength=len(sizes))
    seen = ~light & ~near
    sure = np.where(seen, first, np.uint64(0))
    marks = [_mark("version", v) for v in version.dictionary_encode().dictionary.to_pylist()] if len(version) else []
    base = np.array(marks, np.uint64)[version.dictionary_encode().indices.to_numpy()] if len(version) else np.zeros(0, np.uint64)
    own = base + np.add.reduceat(word, np.cumsum(sizes) - sizes) if len(sizes) else base
    return {"row": row, "word": word, "first": first, "sure": sure, "letters": letters, "whole": whole, "full": ~light, "few": count(seen) <= 3, "base": base, "own": own, "n": len(sizes)}


def _key_words(t: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of bags with equally many key words: (rows, places of their key words in the batch)."""
    at = np.flatnonzero(t["full"])
    o = at[np.lexsort((t["word"][at], t["row"][at]))]
    r = t["row"][o]
    start = np.r_[0, np.flatnonzero(r[1:] != r[:-1]) + 1] if len(r) else np.zeros(0, np.int64)
    rank = np.arange(len(r)) - np.repeat(start, np.diff(np.r_[start, len(r)]))
    keep = rank < KEY_WORDS
    o, r = o[keep], r[keep]
    n = np.bincount(r, minlength=t["n"])
    for k in np.unique(n[n > 0]):
        rows = np.flatnonzero(n == k)
        yield rows, o[(n == k)[r]].reshape(len(rows), k)


def _kind(keys: np.ndarray, kind: int) -> np.ndarray:
    return (keys & ~np.uint64(1)) | np.uint64(kind)


_PAIR, _SINGLE, _ALL = (np.uint64(_mark("kind", k)) for k in ("pair", "single", "letters"))


def _first_level(t: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, mask) of a batch; the mask says which key words, by hash, stand in the key."""
    rows_out, keys_out, masks_out = [], [], []

    def add(rows: np.ndarray, keys: np.ndarray, ok: np.ndarray, kind: int, mask: int) -> None:
        rows_out.append(rows[ok])
        keys_out.append(_kind(keys, kind)[ok])
        masks_out.append(np.full(len(rows_out[-1]), mask))

    with np.errstate(over="ignore"):
        for rows, at in _key_words(t):
            k = at.shape[1]
            word, first, whole, base = t["word"][at], t["sure"][at], t["whole"][at], t["base"][rows]
            for i, j in combinations(range(k), 2):
                add(rows, base + _PAIR + word[:, i] + word[:, j], whole[:, i] & whole[:, j], OPEN, 1 << i | 1 << j)
            few = t["few"][rows]
            if few.any():
                rest = base + _SINGLE + first.sum(1)
                for i in range(k):
                    add(rows, rest - first[:, i] + word[:, i], whole[:, i] & few, OPEN, 1 << i)
        full = t["full"]
        total = np.zeros(t["n"], np.uint64)
        if t["n"]:
            total = np.add.reduceat(np.where(full, t["letters"], np.uint64(0)), np.r_[0, np.flatnonzero(t["row"][1:] != t["row"][:-1]) + 1])
        some = np.bincount(t["row"][full], minlength=t["n"]) > 1
        cut = np.bincount(t["row"][full & ~t["whole"]], minlength=t["n"]) > 0
        add(np.arange(t["n"]), t["base"] + _ALL + total, some & ~cut, CLOSED, 0)
    return np.concatenate(rows_out), np.concatenate(keys_out).view(np.int64), np.concatenate(masks_out)


def _cuts(w: str, most: int) -> set[str]:
    out = now = {w}
    for _ in range(most):
        now = {x[:i] + x[i + 1 :] for x in now for i in range(len(x))}
        out = out | now
    return out


def _typed(w: str, alone: bool) -> Iterator[tuple[str, int]]:
    """What a word may be typed as, with the side that it then stands on: 0 for both."""
    u = w.rstrip("*").replace("ph", "f")
    for x in _cuts(u, (1 if len(u) < 5 else 2 if len(u) < 10 else 3) if alone else 1):
        yield "-" + x, 0
    # an initial, a cut-off word or a short form stands on one side, whole words with their beginnings on the other
    cut = len(w) == 1 or w[-1] == "*"
    for kind, small, large in (("<", LEFT, RIGHT), (">", RIGHT, LEFT)):
        yield kind + w[0], small if cut else large
        if len(w) > 2 and not cut:
            yield kind + w, small
            for i in range(3, len(w) - 1):
                yield kind + w[:i], large


def _key_order(tokens: list[str]) -> list[str]:
    """The key words of a bag in the order of the masks."""
    return sorted((w for w in tokens if w not in LIGHT or len(w) == 1), key=lambda w: _mark("word", w) & ~1)[:KEY_WORDS]


@lru_cache(maxsize=1 << 13)
def _typed_marks(w: str, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of what a word may be typed as, and sides."""
    got = list(set(_typed(w, alone)))
    return np.array([xxhash.xxh64_intdigest(x) for x, _ in got], np.uint64), np.array([side for _, side in got], np.int64)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """Hashes of numbers."""
    with np.errstate(over="ignore"):
        keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return keys ^ (keys >> np.uint64(31))


_REST, _RUN, _TYPED = (np.uint64(_mark("kind", k)) for k in ("rest", "run", "typed"))


def _finer(key: np.ndarray, bags: pa.Array, meta: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, meta) in the place of crowded keys."""
    named = bags.dictionary_encode()
    orders = [_key_order(b.partition(SIGN)[0].split(" ")) for b in named.dictionary.to_pylist()]
    plain = meta & 0xFFB  # mask and role
    rest, run, letters, word_rows, word_add, word_meta, typed, typed_rows, typed_meta = ([] for _ in range(9))
    for row, (code, m) in enumerate(zip(named.indices.to_pylist(), plain.tolist(), strict=True)):
        ws = orders[code]
        left = [i for i in range(len(ws)) if not m >> (i + 3) & 1]
        if last or all(len(ws[i]) == 1 or ws[i][-1] == "*" or is_near_article(ws[i]) for i in left):  # what is left may be lost
            rest.append(row)
        if last or not left:
            continue
        run.append(row)
        letters.append(sum(_traits(ws[i])[2] for i in left) & (1 << 64) - 1)
        for i in left:
            w, now = ws[i], m | 1 << (i + 3)
            word = _traits(w)[0]
            if len(w) > 1 and w[-1] != "*":  # a sum, so the order of words doesn't matter
                word_rows.append(row)
                word_add.append(word)
                word_meta.append(now)
            typed.append(_typed_marks(w, len(left) == 1))
            typed_rows.append(row)
            typed_meta.append(now | (1 + (word >> 20) % TYPED) << 12)
    open_, u = key.view(np.uint64) & ~np.uint64(1), lambda x: np.array(x, np.uint64)
    n = [len(t[0]) for t in typed]
    marks, side = (np.concatenate([t[k] for t in typed] or [np.zeros(0, np.int64)]) for k in range(2))
    typed_rows, typed_meta = np.repeat(np.array(typed_rows, np.int64), n), np.repeat(np.array(typed_meta, np.int64), n)
    role = np.where(side > 0, typed_meta & side, typed_meta & 3)
    ok = role > 0
    with np.errstate(over="ignore"):
        keys = [
            _kind(_mixed(open_[rest] ^ _REST), CLOSED),
            _kind(_mixed(open_[run] ^ _RUN) + u(letters), CLOSED),
            open_[word_rows] + u(word_add),
            _kind(_mixed(_mixed(open_[typed_rows[ok]] ^ _TYPED) + marks[ok].astype(np.uint64)), OPEN),
        ]
    rows = [np.array(x, np.int64) for x in (rest, run, word_rows, typed_rows[ok])]
    metas = [plain[rows[0]], plain[rows[1]], np.array(word_meta, np.int64), (typed_meta[ok] & ~3) | role[ok]]
    return np.concatenate(rows), np.concatenate(keys).view(np.int64), np.concatenate(metas)


def _own(bags: pa.Array) -> np.ndarray:
    named = bags.dictionary_encode()
    return np.array([_mark("bag", b) for b in named.dictionary.to_pylist()], np.uint64)[named.indices.to_numpy()] if len(bags) else np.zeros(0, np.uint64)


def _spread(key: np.ndarray, bag: pa.Array, own: np.ndarray, meta: np.ndarray, buckets: int, block: int) -> pa.RecordBatch:
    """The rows of each bucket in one piece.

    Keys crowded in this batch alone go, by bag, to buckets that pass them on; a mark without a role tells the key's bucket.
    """
    if len(key):
        o = np.argsort(key)
        same = key[o][1:] == key[o][:-1]
        many = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        again = o[many]
        o[many] = again[np.lexsort((own[again], key[again]))]
        key, own, meta = key[o], own[o], meta[o]
        new = np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]) | (meta[1:] != meta[:-1])]
        key, own, meta, o = key[new], own[new], meta[new], o[new]
        bag = bag.take(pa.array(o))
        run = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1]
        right, left = np.add.reduceat((meta & RIGHT) > 0, run, dtype=np.int64), np.add.reduceat((meta & LEFT) > 0, run, dtype=np.int64)
        hot = _crowded(key[run], right, left, meta[run], block)
        is_hot = np.repeat(hot, np.diff(np.r_[run, len(key)]))
        marks = key[run][hot]
        bucket = np.where(is_hot, (own % np.uint64(buckets)).astype(np.int64), key % buckets)
        meta, bucket = np.where(is_hot, meta | HOT, meta), np.concatenate([bucket, marks % buckets])
        key, meta = np.concatenate([key, marks]), np.concatenate([meta, np.zeros(len(marks), np.int64)])
        o = np.argsort(bucket, kind="stable")
        key, meta, bucket = key[o], meta[o], bucket[o]
        bag = pa.concat_arrays([bag, pa.array([""] * len(marks), pa.string())]).take(pa.array(o))
        run = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1]
        pieces = [_piece(key[a:b], bag.slice(a, b - a), meta[a:b]) for a, b in zip(run, np.r_[run[1:], len(key)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[run], pa.int32()), pa.array(pieces, pa.binary())], ["bucket", "packed"])
    return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())], ["bucket", "packed"])


def _piece(key: np.ndarray, bag: pa.Array, meta: np.ndarray) -> bytes:
    """Rows as bytes: their number, that of their text, and both compressed."""
    ends = np.frombuffer(bag.buffers()[1], np.int32)[bag.offset : bag.offset + len(bag) + 1]
    text = (bag.buffers()[2] or b"")[int(ends[0]) : int(ends[-1])]
    held = b"".join((key.tobytes(), meta.astype(np.uint32).tobytes(), np.diff(ends).astype(np.uint32).tobytes(), text))
    return np.array([len(key), len(text)], np.uint32).tobytes() + pa.compress(held, codec="zstd", asbytes=True)


def _unpacked(pieces: pa.ChunkedArray) -> pa.Table:
    """key, bag and meta of all pieces."""
    got: list[tuple] = []
    for p in pieces.to_pylist():
        n, text = np.frombuffer(p, np.uint32, 2).tolist()
        held = pa.decompress(memoryview(p)[8:], 16 * n + text, codec="zstd", asbytes=True)
        got.append((np.frombuffer(held, np.int64, n), np.frombuffer(held, np.uint32, n, 8 * n), np.frombuffer(held, np.uint32, n, 12 * n), held[16 * n :]))
    keys, metas, sizes, texts = zip(*got, strict=True) if got else [()] * 4
    of = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
    ends = np.r_[0, np.cumsum(of(sizes))]
    bag = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))).cast(pa.string())
    return pa.table({"key": pa.array(of(keys), pa.int64()), "bag": bag, "meta": pa.array(of(metas), pa.int64())})


def _crowded(key: np.ndarray, right: np.ndarray, left: np.ndarray, meta: np.ndarray, block: int) -> np.ndarray:
    most = np.where(meta >> 12 & TYPED + 1 > 0, block * TYPED_TIMES, block)
    return ((right > most) | (left > most * LEFT_TIMES)) & ((key & 1) == OPEN)


def _bits(w: str) -> int:
    """The letters of a word as bits."""
    bits = 0
    for c in w.replace("ph", "f"):
        bits |= 1 << (ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 6)
    return bits


class _Words:
    """The words of distinct bags, SEEN words a bag at most, for weighing many pairs at once; tables have a column for each pair.

    Words are numbered in their order, so that the first of equal costs is the one that the channel takes. Two numbers more
    stand for no word, one on each side.
    """

    def __init__(self, forms: pa.Array):
        lists = pc.split_pattern(forms, " ")
        flat = lists.flatten().dictionary_encode()
        order = pc.array_sort_indices(flat.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words = ws = flat.dictionary.take(pa.array(order)).to_pylist()
        n = self.n = len(ws)
        self.size_of = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(forms)), self.size_of)
        place = np.arange(len(row)) - np.repeat(np.cumsum(self.size_of) - self.size_of, self.size_of)
        self.id = np.full((SEEN, len(forms)), n, np.int32)
        seen = place < SEEN
        self.id[place[seen], row[seen]] = rank[flat.indices.to_numpy()[seen]]
        self.id.sort(axis=0)
        self._looks(ws)
        # a number for all letters of a bag
        ends = np.cumsum(self.size_of)
        self.total = np.add.reduceat(self.sum[rank[flat.indices.to_numpy()]], ends - self.size_of) if len(ends) else np.zeros(0, np.uint64)
        # first letters of words that are surely no light ones, their number, and whether a bag has one that may be light
        near = self._told(is_near_light, self.size < 9) & ~self.light
        surely = ~(self.light | near)
        surely[n:] = False
        letter = np.where(surely, np.uint64(1) << (self.char[0] % 64).astype(np.uint64), np.uint64(0))
        self.letters = np.bitwise_or.reduce(letter[self.id], axis=0)
        self.count, self.may = surely[self.id].sum(0), near[self.id].any(0)

    def _looks(self, ws: list[str]) -> None:
        self.size = np.array([*map(len, ws), 0, 0], np.int8 if max(map(len, ws), default=0) < 128 else np.int64)
        size = self.size.astype(np.int64)
        points = np.frombuffer("".join(ws).encode("utf-32-le"), np.uint32)
        start = np.cumsum(size) - size
        self.char = np.zeros((LETTERS, len(size)), np.uint32)
        bits = np.zeros(len(size), np.uint64)
        for k in range(LETTERS):
            at = np.flatnonzero(size > k)
            c = points[start[at] + k]
            self.char[k, at] = c
            bits[at] |= np.uint64(1) << np.where((c >= 97) & (c <= 122), c - 97, 26 + c % 6).astype(np.uint64)
        last = np.zeros(len(size), np.uint32)
        last[:-2] = points[start[:-2] + size[:-2] - 1]
        self.sum = np.add.reduceat(_mixed(points.astype(np.uint64) + _ALL), start[:-2]) if len(points) else np.zeros(0, np.uint64)
        self.light = self._told(LIGHT.__contains__, size <= max(map(len, LIGHT)))
        self.cut = last == ord("*")
        self.digit = self._told(str.isdigit, (self.char[0] < 97) | (self.char[0] > 122))
        self.ph = ((self.char[:-1] == ord("p")) & (self.char[1:] == ord("h"))).any(0)
        # such words are weighed one by one
        self.odd = self.cut | self.ph | (size > LETTERS)
        for k in np.flatnonzero(self.odd):
            bits[k] = _bits(ws[k])
        c = self.char
        self.last = last
        few = np.int64(1) << 62  # words without a beginning have none in common
        self.begin = np.where(size >= 3, (c[0].astype(np.int64) << 42) | (c[1].astype(np.int64) << 21) | c[2], few + np.arange(len(size)))
        self.look = (c[0] & 255).astype(np.uint8), (c[1] & 255).astype(np.uint8), (last & 255).astype(np.uint8), bits.astype(np.uint32)
        self.lost = np.where(size > 0, LOST, 0.0)
        for k in np.flatnonzero((self.light | self.cut | (size <= 5)) & (size > 0)):
            self.lost[k] = _lost_word(ws[k])
        self.heavy, self.one = ~self.light, (size == 1) | self.cut
        self.heavy[self.n :] = False
        self.firm = self.lost == LOST
        self.counts = None

    def _told(self, test, ask: np.ndarray) -> np.ndarray:
        """What a test says of the words that may pass it."""
        out = np.zeros(self.n + 2, bool)
        at = np.flatnonzero(ask[: self.n])
        out[at] = [bool(test(self.words[k])) for k in at]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs that the first letters of their words rule out.

        With equally many words and none that may be light, one first letter may differ at most; else the limit leaves, besides a
        lost or joined word for each of difference, room for two typos in first letters.
        """
        few = np.abs(self.count[a] - self.count[b])
        most = np.where((few == 0) & ~self.may[a] & ~self.may[b], 2, few + 4)
        return (np.bitwise_count(self.letters[a] ^ self.letters[b]) > most) & (np.maximum(self.size_of[a], self.size_of[b]) <= SEEN)

    def rests(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words that only one bag of a pair has, FEW at most, and their numbers."""
        wide = int(min(SEEN, max(self.size_of[a].max(), self.size_of[b].max())))
        x, y = np.take(self.id[:wide], a, axis=1), np.take(self.id[:wide], b, axis=1)
        in_x, in_y = x < self.n, y < self.n
        for i in range(wide):
            for j in range(wide):
                apart = x[i] != y[j]
                in_x[i] &= apart
                in_y[j] &= apart
        return *self._packed(x, in_x, self.n), *self._packed(y, in_y, self.n + 1)

    @staticmethod
    def _packed(x: np.ndarray, held: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
        out = np.full((FEW, x.shape[1]), none, np.int32)
        n = np.zeros(x.shape[1], np.int8)
        for i in range(len(x)):
            at = np.flatnonzero(held[i] & (n < FEW))
            out[n[at], at] = x[i, at]
            n += held[i]
        return out, n

    def unlike(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """A word that can't be lost has no partner, and no words are run together."""
        x, y = x.astype(np.intp), y.astype(np.intp)
        first_x, second_x, last_x, bits_x = (t.take(x) for t in self.look)
        first_y, second_y, last_y, bits_y = (t.take(y) for t in self.look)
        sx, sy, bx, by = self.size.take(x), self.size.take(y), self.begin.take(x), self.begin.take(y)
        odd = self.one | self.ph
        ox, oy, fx, fy = odd.take(x), odd.take(y), self.firm.take(x), self.firm.take(y)
        for i in range(len(x)):
            for j in range(len(y)):
                first = first_x[i] == first_y[j]
                odd = ox[i] | oy[j]
                ends = first | (last_x[i] == last_y[j]) | odd | ((first_x[i] == second_y[j]) & (second_x[i] == first_y[j]))
                near = ends & (np.abs(sx[i] - sy[j]) <= 4) & (np.bitwise_count(bits_x[i] ^ bits_y[j]) <= 6)
                none = ~(near | (first & odd) | (bx[i] == by[j]))
                fx[i] &= none
                fy[j] &= none
        out = fx.any(0) | fy.any(0)
        at = np.flatnonzero(out)
        at = at[self.heavy[x[:, at]].sum(0) != self.heavy[y[:, at]].sum(0)]
        out[at] = ~self._joinable(x[:, at], y[:, at])
        return out

    def _joinable(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words may be run together: other numbers of them, about as many letters, about the same ones."""
        hx, hy = self.heavy[x], self.heavy[y]
        length = lambda t, h: np.where(h, self.size[t], 0).sum(0, dtype=np.int64)
        letters = lambda t, h: np.bitwise_or.reduce(np.where(h, self.look[3][t], np.uint32(0)), axis=0)
        return (hx.sum(0) != hy.sum(0)) & (np.abs(length(x, hx) - length(y, hy)) <= 2) & (np.bitwise_count(letters(x, hx) ^ letters(y, hy)) <= 6)

    def word_costs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Costs of many words as others, as ``word_cost`` has them."""
        size = self.size
        swap = size[x] > size[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        m, n = size[x].astype(np.int64), size[y].astype(np.int64)
        char, last = self.char, self.last
        most = np.where(n < 5, 1, np.where(n < 10, 2, 3))
        first = char[0][x] == char[0][y]
        ends = first | (last[x] == last[y]) | ((char[0][x] == char[1][y]) & (char[1][x] == char[0][y]))
        begins = (m >= 3) & (m <= n - 2) & first
        for k in range(1, LETTERS):
            at = np.flatnonzero(begins & (m > k))
            begins[at] = char[k][x[at]] == char[k][y[at]]
        out = np.where(begins, SHORTENED, CANNOT)
        out = np.where(m == 1, np.where(first, INITIAL, CANNOT), out)
        odd = self.odd[x] | self.odd[y] | (self.light[x] & self.light[y])
        at = np.flatnonzero(ends & (n - m <= most) & (m > 1) & ~odd & ~self.digit[x] & ~self.digit[y])
        d = self._distances(x[at], y[at])
        ok = d <= most[at]
        out[at[ok]] = TYPOS[d[ok]]
        for k in np.flatnonzero(odd):
            out[k] = word_cost(self.words[x[k]], self.words[y[k]])
        return out

    def _distances(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``distance`` of many words at once, those above three as four; the shorter word is the first."""
        out = np.full(len(x), 4, np.int64)
        m, n = self.size[x].astype(np.int64), self.size[y].astype(np.int64)
        o = np.argsort(-m, kind="stable")
        x, y, m, n = x[o], y[o], m[o], n[o]
        if not len(x):
            return out
        cx, cy = self.char[:, x], self.char[:, y]
        # the cells at most three off the diagonal: band[b] is column i + b - 3 of row i
        band, before = np.full((7, len(x)), 9, np.int8), np.full((7, len(x)), 9, np.int8)
        for j in range(4):
            band[3 + j] = j
        for i in range(1, int(m[0]) + 1):
            k = int(np.searchsorted(-m, -i, "right"))  # words of i letters or more
            band, before = band[:, :k], before[:, :k]
            row = np.full((7, k), 9, np.int8)
            for b in range(7):
                j = i + b - 3
                if j < 0 or j > LETTERS:
                    continue
                if j == 0:
                    row[b] = i
                    continue
                d = band[b] + (cx[i - 1, :k] != cy[j - 1, :k])
                if b < 6:
                    d = np.minimum(d, band[b + 1] + 1)
                if b:
                    d = np.minimum(d, row[b - 1] + 1)
                if i > 1 and j > 1:
                    swapped = (cx[i - 1, :k] == cy[j - 2, :k]) & (cx[i - 2, :k] == cy[j - 1, :k])
                    d = np.where(swapped, np.minimum(d, before[b] + 1), d)
                row[b] = np.minimum(d, 9)
            band, before = row, band
            at = np.flatnonzero((m[:k] == i) & (n[:k] - i <= 3))
            out[o[at]] = np.minimum(row[n[at] - i + 3, at], 4)
        return out

    def costs(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
        """Costs of pairs that share a word, by the words that they don't share, and the (place, word, word) taken as typos."""
        k, n = len(x), x.shape[1]
        hx, hy = self.heavy[x], self.heavy[y]
        some_x, some_y = hx.sum(0), hy.sum(0)
        # first letters of equally many words: one may differ at most
        met = np.zeros(n, np.int8)
        free = hy.copy()
        for i in range(k):
            open_ = hx[i].copy()
            for j in range(k):
                hit = open_ & free[j] & (self.char[0][x[i]] == self.char[0][y[j]])
                met += hit
                open_ &= ~hit
                free[j] &= ~hit
        cannot = (some_x == some_y) & (some_x > 1) & (some_x - met > 1)
        both = np.stack([(x[i].astype(np.int64) << 32) | y[j] for i in range(k) for j in range(k)])
        held = np.stack([(x[i] < self.n) & (y[j] < self.n) for i in range(k) for j in range(k)]) & ~cannot
        cost = np.full(both.shape, CANNOT)
        named, inverse = np.unique(both[held], return_inverse=True)
        cost[held] = self.word_costs(named >> 32, named & 0xFFFFFFFF)[inverse]
        total, lost_x, lost_y = np.zeros(n), self.lost[x], self.lost[y]
        typos = []
        for _ in range(k):
            best = cost.argmin(0)
            c = cost[best, np.arange(n)]
            at = np.flatnonzero(c < CANNOT)
            if not len(at):
                break
            i, j = best[at] // k, best[at] % k
            total[at] += c[at]
            lost_x[i, at] = lost_y[j, at] = 0.0
            typed = c[at] >= TYPO
            typos.append((at[typed], x[i, at][typed], y[j, at][typed]))
            for q in range(k):
                cost[i * k + q, at] = cost[q * k + j, at] = CANNOT
        # in the channel's own order of sums
        add = lambda t: reduce(np.add, t, np.zeros(n))
        total = total + add(lost_x) + add(lost_y)
        total[cannot] = CANNOT
        joined = np.flatnonzero((total > JOINED) & self._joinable(x, y) & (some_x > 0) & (some_y > 0))
        joined = joined[~cannot[joined] & self._same_letters(x[:, joined], y[:, joined])]
        again = np.zeros(n, bool)
        for p in joined:
            mine, theirs = ([self.words[w] for w in t[:, p] if w < self.n] for t in (x, y))
            light = [_lost([w for w in t if w in LIGHT]) for t in (mine, theirs)]
            other = _run_together([w for w in mine if w not in LIGHT], [w for w in theirs if w not in LIGHT]) + light[0] + light[1]
            if other < total[p]:
                total[p], again[p] = other, True
        return total, ((p, v, w) for at, a, b in typos for p, v, w in zip(at.tolist(), a.tolist(), b.tolist(), strict=True) if total[p] <= LIMIT and not again[p])

    def _same_letters(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """At most two letters differ: each edit changes two counts at most."""
        if self.counts is None:
            at = [np.flatnonzero(self.size > k) for k in range(LETTERS)]
            cells = np.concatenate([w * 32 + self.char[k, w] % 32 for k, w in enumerate(at)])
            self.counts = np.bincount(cells, minlength=32 * len(self.size)).reshape(-1, 32).astype(np.int16)
        away = sum(np.where(self.heavy[t][:, None], self.counts[t], 0) for t in x) - sum(np.where(self.heavy[t][:, None], self.counts[t], 0) for t in y)
        long = (self.size[x] > LETTERS).any(0) | (self.size[y] > LETTERS).any(0)
        return (np.abs(away).sum(1) <= 4) | long


_TYPOS = pa.list_(pa.struct([("x", pa.string()), ("y", pa.string())]))
_MET = pa.schema([("key", pa.int64()), ("bag", pa.string()), ("meta", pa.int64()), ("other", pa.string()), ("cost", pa.float64()), ("typos", _TYPOS)])


def _distinct(x: np.ndarray) -> np.ndarray:
    """Distinct numbers in order; their memory is used."""
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _weighed(words: _Words, pairs: np.ndarray, bags: list[str], typed: bool = True) -> dict[tuple[int, int], tuple[float, list]]:
    """Costs of the pairs within the limit, and, if ``typed``, the words of a pair taken as typos."""
    got: dict[tuple[int, int], tuple[float, list]] = {}
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    long = np.maximum(words.size_of[a], words.size_of[b])
    asked = [np.flatnonzero(long > SEEN)]
    rests: dict[int, list] = {1: [], 2: [], 3: [], FEW: []}
    for small, large in ((0, 4), (4, FEW), (FEW, 7), (7, SEEN)):
        sized = np.flatnonzero((long > small) & (long <= large))
        for p in range(0, len(sized), 1 << 15):
            at = sized[p : p + (1 << 15)]
            x, nx, y, ny = words.rests(a[at], b[at])
            rest = np.maximum(nx, ny)
            # so many different words, or no common one: the channel looks at letters alone
            most = (rest > FEW) | (nx == words.size_of[a[at]]) | (ny == words.size_of[b[at]])
            asked.append(at[most & (words.total[a[at]] == words.total[b[at]])])
            few = -1
            for many, kept in rests.items():
                own = np.flatnonzero((rest > few) & (rest <= many) & ~most)
                own = own[~words.unlike(x[:many, own], y[:many, own])]
                kept.append((at[own], x[:many, own], y[:many, own]))
                few = many
    for kept in rests.values():
        if not kept:
            continue
        own, x, y = (np.concatenate(c, axis=-1) for c in zip(*kept, strict=True))
        for p in range(0, len(own), 1 << 16):
            at = own[p : p + (1 << 16)]
            cost, typos = words.costs(x[:, p : p + (1 << 16)], y[:, p : p + (1 << 16)])
            near = np.flatnonzero(cost <= LIMIT)
            ends = dict(zip(near.tolist(), zip(a[at[near]].tolist(), b[at[near]].tolist(), strict=True), strict=True))
            got |= {e: (c, []) for e, c in zip(ends.values(), cost[near].tolist(), strict=True)}
            for i, v, w in typos if typed else ():
                got[ends[i]][1].append((words.words[v], words.words[w]))
    for i in np.concatenate(asked):
        x, y = int(a[i]), int(b[i])
        cost, typos = channel_cost(*(bags[i].partition(SIGN)[0].split(" ") for i in (x, y)))
        if cost <= LIMIT:
            got[x, y] = cost, typos
    return got


def _meet(block: int, symmetric: bool, typed: bool = True):
    """Near pairs of one bucket's rows with their costs, key null, and the members of crowded keys."""

    def run(t: pa.Table) -> pa.Table:
        t = _unpacked(t.column("packed"))
        key, meta = t.column("key").to_numpy(), t.column("meta").to_numpy()
        passing = (meta & HOT) > 0
        marks = np.unique(key[meta == 0])
        at = np.flatnonzero(~passing & (meta > 0))
        at = at[np.argsort(key[at], kind="stable")]
        crowded = [np.flatnonzero(passing)]
        got: dict[tuple[int, int], tuple[float, list]] = {}
        bags: list[str] = []
        if len(at):
            k, m = key[at], meta[at]
            run_at = np.r_[0, np.flatnonzero(k[1:] != k[:-1]) + 1]
            size = np.diff(np.r_[run_at, len(k)])
            right, left = np.add.reduceat((m & RIGHT) > 0, run_at, dtype=np.int64), np.add.reduceat((m & LEFT) > 0, run_at, dtype=np.int64)
            full = (_crowded(k[run_at], right, left, m[run_at], block) & (right > 0) & (left > 0)) | np.isin(k[run_at], marks)
            full_rows = np.repeat(full, size)
            crowded.append(at[full_rows])
            at = at[~full_rows & np.repeat((right > 0) & (left > 0) & (size > 1), size)]
            k, m = key[at], meta[at]
            rows = t.take(pa.array(at))
            # one number for each distinct bag
            named = pa.concat_arrays([*rows.column("bag").chunks, pa.array([], pa.string())]).dictionary_encode()
            code, bags = named.indices.to_numpy(), named.dictionary.to_pylist()
            words = _Words(pc.list_element(pc.split_pattern(named.dictionary, SIGN, max_splits=1), 0) if len(bags) else named.dictionary)
            # rows of a key in the order of the words that tell them apart; rows with the same one don't meet
            seg = np.cumsum(np.r_[False, k[1:] != k[:-1]]) if len(k) else k
            apart = m >> 12 & TYPED + 1
            li, ri = np.flatnonzero(m & LEFT), np.flatnonzero(m & RIGHT)
            ri = ri[np.argsort(seg[ri] << 20 | apart[ri], kind="stable")]
            place = seg[ri] << 20 | apart[ri]
            pairs = [np.zeros(0, np.int64)]
            for s in range(0, len(li), 1 << 12):
                mine = li[s : s + (1 << 12)]
                own = seg[mine] << 20 | apart[mine]
                lo, hi = np.searchsorted(place, own), np.searchsorted(place, own, "right")
                lo, hi = np.where(apart[mine] > 0, lo, hi), hi
                a, b = np.searchsorted(place, seg[mine] << 20), np.searchsorted(place, seg[mine] + 1 << 20)
                a, b, who = np.r_[a, hi], np.r_[lo, b], np.r_[mine, mine]
                n = b - a
                x = np.repeat(code[who], n).astype(np.int64)
                y = code[ri[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]].astype(np.int64)
                ok = (x != y) & ~words.apart(x, y)
                x, y = x[ok], y[ok]
                if symmetric:
                    x, y = np.minimum(x, y), np.maximum(x, y)
                pairs.append(_distinct(x << 32 | y))
                if s % (1 << 17) == 0:  # a pair meets under several keys
                    pairs = [_distinct(np.concatenate(pairs))]
            got = _weighed(words, _distinct(np.concatenate(pairs)), bags, typed)
        out = t.take(pa.array(np.concatenate(crowded)))
        more = pa.table([out.column("key"), out.column("bag"), pa.array(out.column("meta").to_numpy() & ~HOT), pa.nulls(len(out), pa.string()), pa.nulls(len(out), pa.float64()), pa.nulls(len(out), _TYPOS)], schema=_MET)
        ends = [(bags[x], bags[y]) if bags[x] < bags[y] or not symmetric else (bags[y], bags[x]) for x, y in got]
        typos = pa.array([[{"x": p, "y": q} for p, q in v[1]] for v in got.values()], _TYPOS) if typed else pa.nulls(len(got), _TYPOS)
        found = pa.table([pa.nulls(len(got), pa.int64()), pa.array([a for a, _ in ends], pa.string()), pa.nulls(len(got), pa.int64()), pa.array([b for _, b in ends], pa.string()), pa.array([v[0] for v in got.values()], pa.float64()), typos], schema=_MET)
        return pa.concat_tables([found, more])

    return run


def near_bags(forms: DataFrame, symmetric: bool, block: int = BLOCK, typed: bool = True) -> DataFrame:
    """(f, g, cost), if ``typed`` typos too: left bags with right bags within the channel's limit; f and g are the hashes of form and version.

    ``forms`` has form, version and role (LEFT, RIGHT or both added), each bag once; if ``symmetric``, all are both and a pair
    comes once. Rows carry the bags themselves, so pairs are weighed where they meet and only near ones leave.
    """
    plain_unions(forms.sparkSession)
    bag = F.when(F.col("version") == "", F.col("form")).otherwise(F.concat("form", F.lit(SIGN), "version"))
    forms = forms.select("form", "version", "role", bag.alias("bag"))
    buckets = max(48, forms.count() // BUCKET_FORMS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            t = _table(r.column(0), r.column(1))
            rows, keys, mask = _first_level(t)
            yield _spread(keys, r.column(3).take(pa.array(rows)), t["own"][rows], r.column(2).to_numpy().astype(np.int64)[rows] | mask << 3, buckets, block)

    def further(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in batches:
                rows, key, meta = _finer(r.column(0).to_numpy(), r.column(1), r.column(2).to_numpy(), last)
                yield _spread(key, r.column(1).take(pa.array(rows)), _own(r.column(1))[rows], meta, buckets, block)

        return run

    shape = "key bigint, bag string, meta bigint, other string, cost double, typos array<struct<x: string, y: string>>"
    # as many tasks as the data ask for, whatever the session's number of shuffle partitions
    meet = lambda keyed, level: written(keyed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_meet(block, symmetric, typed), shape), f"bags-met-{level}")
    met = meet(forms.mapInArrow(first, _ROWS), 1)
    found = [met.where("key IS NULL")]
    for level in range(2, LEVELS + 1):
        crowded = met.where("key IS NOT NULL").select("key", "bag", "meta")
        if not crowded.limit(1).count():
            break
        met = meet(crowded.mapInArrow(further(level == LEVELS), _ROWS), level)
        found.append(met.where("key IS NULL"))
    out = reduce(DataFrame.unionByName, found)
    hashed = lambda c: F.xxhash64(F.substring_index(c, SIGN, 1), F.when(F.instr(c, SIGN) > 0, F.substring_index(c, SIGN, -1)).otherwise(""))
    ends = out.select(hashed(F.col("bag")).alias("f"), hashed(F.col("other")).alias("g"), "cost", "typos")
    if not typed:
        return ends.groupBy("f", "g").agg(F.min("cost").alias("cost"))
    return ends.groupBy("f", "g").agg(F.min(F.struct("cost", "typos")).alias("m")).select("f", "g", "m.cost", "m.typos")
