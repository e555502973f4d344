"""Vectorised word scanning of Arrow string columns.

The operators of this package read words many times over whole corpora, so the
one hot loop - find the words of a batch of texts and give each a 64-bit key -
works on the UTF-8 buffer of the Arrow column: byte classes find the word
borders, and a word's key is a chain of ``mix`` over its 8-byte lanes, one numpy
pass for each lane of the words that still have one.  Words of more than
``LONG`` bytes get eight bytes of BLAKE2 instead.  Equal words have equal keys;
the chain is a bijection of a word's last differing lane, so two different words
share a key with probability 2^-64.

Memory is bounded: rows are taken in chunks of ``CHUNK`` bytes and a long text is
scanned in blocks of that size, which may end inside a word: only per-word arrays
(not per-byte ones) ever span a whole text, however long its words are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Bytes of a word from which on it is hashed alone.
LONG = 64

#: The lowest 0..8 bytes of a lane.
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _class(keep) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[b for b in range(256) if keep(b)]] = True
    return t


#: ``[^\x20\x09-\x0D]+`` - everything but ASCII white space.
SPACED = _class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, letters and all non-ASCII.
ALNUM = _class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (spreads the key over all bits)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def byte_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit key of each byte range ``data[start:end]``; ``lower``: as if A-Z were a-z."""
    size = end - start
    out = mix(size.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))
    todo = np.flatnonzero((size > 0) & (size <= LONG))
    if len(todo):
        # whole lanes can be read up to the last eight bytes; ranges that end there read a padded copy
        tail = max(0, len(data) - 2 * LONG)
        late = end[todo] > len(data) - 8
        sides = [(data, 0, todo[~late])] if not late.all() else []
        if late.any():
            sides.append((np.concatenate((data[tail:], np.zeros(8, np.uint8))), tail, todo[late]))
        for raw, base, which in sides:
            lanes = np.ndarray(len(raw) - 7, "<u8", np.ascontiguousarray(raw), 0, (1,))
            at, left, h = start[which] - base, size[which], out[which]
            while len(which):
                lane = lanes[at] & _KEEP[np.minimum(left, 8)]
                if lower:
                    lane = _lowered(lane)
                h = mix((h ^ lane) * np.uint64(0x9FB21C651E98DF25))
                more = left > 8
                if not more.all():
                    out[which[~more]] = h[~more]
                    which, at, left, h = which[more], at[more], left[more], h[more]
                at, left = at + 8, left - 8
    for i in np.flatnonzero(size > LONG).tolist():
        digest = hashlib.blake2b(digest_size=8)
        for lo in range(int(start[i]), int(end[i]), CHUNK):
            part = data[lo:min(lo + CHUNK, int(end[i]))]
            digest.update(_LOWER[part] if lower else np.ascontiguousarray(part))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def _lowered(lane: np.ndarray) -> np.ndarray:
    """A-Z to a-z in each of a lane's eight bytes, whatever the others are."""
    ascii_, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
    low = lane & ascii_
    from_a = low + np.uint64(0x3F3F3F3F3F3F3F3F)  # high bit set from "A" on
    past_z = low + np.uint64(0x2525252525252525)  # high bit set after "Z"
    return lane | ((from_a & ~past_z & ~lane & high) >> np.uint64(2))


@dataclass
class Words:
    """Words of a chunk of texts, in reading order."""

    doc: np.ndarray    # row of the chunk
    start: np.ndarray  # byte offsets in the chunk's buffer
    end: np.ndarray
    key: np.ndarray    # uint64
    offsets: np.ndarray  # byte offsets of the rows (len rows + 1)
    data: np.ndarray   # the buffer

    def __len__(self) -> int:
        return len(self.key)

    def counts(self) -> np.ndarray:
        """Words per row."""
        return np.bincount(self.doc, minlength=len(self.offsets) - 1)

    def first(self) -> np.ndarray:
        """Index of each row's first word (len rows + 1)."""
        return np.concatenate(([0], np.cumsum(self.counts())))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(col: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) with at most ``size`` bytes, or one row."""
    data, offs = buffer_of(col)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def scan(data: np.ndarray, offs: np.ndarray, words: np.ndarray = SPACED, lower: bool = False,
         with_gap: bool = False, block: int = CHUNK) -> Words:
    """Words of rows ``offs`` of ``data``; ``words`` says which bytes are word bytes.

    ``with_gap``: a word starts right after the end of the one before it, so the
    white space in front belongs to it, and what follows a row's last word is a
    word too (then the units of a row, joined, give the row back).
    """
    n, starts, ends, inside = len(data), [], [], False
    edges = offs[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    for lo in range(0, n, block):
        w = words[data[lo:lo + block]]
        s, t = w.copy(), ~w  # a word begins here; the one before has ended
        s[1:] &= ~w[:-1]
        t[1:] &= w[:-1]
        s[0] &= not inside
        t[0] &= inside
        e = edges[np.searchsorted(edges, lo):np.searchsorted(edges, lo + len(w))] - lo
        if len(e):
            s[e] = w[e]
            t[e] = np.where(e > 0, w[e - 1], inside)
        starts.append(np.flatnonzero(s) + lo)
        ends.append(np.flatnonzero(t) + lo)
        inside = bool(w[-1])
    if inside:
        ends.append(np.array([n]))
    start, end = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends))
    if with_gap and n:
        first, last = offs[:-1], offs[1:]
        before = np.searchsorted(end, last, "right") - 1
        done = np.where(before >= 0, end[np.maximum(before, 0)] if len(end) else 0, 0)
        end = np.sort(np.concatenate((end, last[last > np.maximum(done, first)])))
        start = np.concatenate(([0], end[:-1]))
    doc = np.searchsorted(offs, start, "right") - 1
    return Words(doc, start, end, byte_keys(data, start, end, lower), offs, data)


def keys_of(texts: list[str], words: np.ndarray = SPACED, lower: bool = False) -> list[np.ndarray]:
    """Word keys of each text (small lists: fixed phrases, benchmark items)."""
    data, offs = buffer_of(pa.array(texts, pa.string()))
    w = scan(data, offs, words, lower)
    f = w.first()
    return [w.key[f[i]:f[i + 1]] for i in range(len(texts))]


def rolling(key: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Key of each run of ``k`` consecutive words, from the words' keys (length n - k + 1)."""
    n = len(key) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(salt * 0x5851F42D4C957F2D & (1 << 64) - 1), np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + key[j:j + n]
    return mix(h)


def signed(key: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return key.view(np.int64)


def spans(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each of the lengths, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(first, lengths)


class KeyMap:
    """64-bit keys -> numbers, in sorted arrays: 12 bytes an entry instead of a dict's hundred.

    New keys go to a small sorted run that is merged into the large one when it has grown.
    """

    RUN = 1 << 17

    def __init__(self) -> None:
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.runs)

    def get(self, key: np.ndarray) -> np.ndarray:
        """The numbers of ``key`` (best in order), -1 where unknown."""
        out = np.full(len(key), -1, np.int64)
        for known, number in self.runs:
            if len(known):
                at = np.searchsorted(known, key)
                at[at == len(known)] = 0
                hit = known[at] == key
                out[hit] = number[at[hit]]
        return out

    def add(self, key: np.ndarray, number: np.ndarray) -> None:
        """Add unknown keys."""
        self.runs[1] = self._merged(self.runs[1], (key, number))
        if len(self.runs[1][0]) > self.RUN:
            self.runs[0] = self._merged(*self.runs)
            self.runs[1] = (np.zeros(0, np.uint64), np.zeros(0, np.int32))

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys, in order, and their numbers."""
        return self._merged(*self.runs)

    @staticmethod
    def _merged(a, b):
        key, number = (np.concatenate(x) for x in zip(a, b))
        by = np.argsort(key, kind="stable")
        return key[by], number[by]
