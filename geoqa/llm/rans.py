"""Static range asymmetric numeral system (rANS) over token ids, in numpy.

A block of ids is dealt to ``lanes`` interleaved coders, id i to lane i % lanes, that
share one table of frequencies (they add up to 2^``SCALE``).  All lanes take a step
together: states stay within 2^21 <= state < 2^53 and give off or take in one 32-bit
word when they leave that range, so every step needs one renormalisation at most, and
a state divided as a double by a frequency (at most 2^20) has an exact integer part.
The words of a step stand in lane order, steps in the order of the ids, so a decoder
reads them forwards.

Every ``every`` steps the states and the place in the words are kept as a checkpoint:
from there on a decoder needs nothing that was decoded before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SCALE = 20
LANES = 4096
_LOW = np.uint64(1 << 21)
_WORD = np.uint64(32)
#: Steps whose frequencies are looked up together.
_AHEAD = 32


class Table:
    """Frequencies of the symbols, scaled to 2^SCALE; a symbol that occurs has one slot at least."""

    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, np.int64)
        total = int(self.freq.sum())
        if total != 1 << SCALE:
            raise ValueError(f"frequencies add up to {total}, not 2^{SCALE}")
        self.start = np.cumsum(self.freq) - self.freq

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> "Table":
        """The table nearest to ``counts`` (of all ids of a corpus; zero: never occurs)."""
        counts = np.asarray(counts, np.int64)
        used = np.flatnonzero(counts)
        if not len(used):  # any table will do
            counts = np.bincount([0], minlength=len(counts))
            used = np.zeros(1, np.int64)
        if len(used) > 1 << SCALE:
            raise ValueError("more symbols than slots")
        size = 1 << SCALE
        total = int(counts.sum())
        exact = counts[used].astype(np.float64) * (size / total)
        freq = np.maximum(np.floor(exact).astype(np.int64), 1)
        left = size - int(freq.sum())
        if left > 0:  # largest remainders first
            order = np.lexsort((used, -(exact - freq)))
            freq[order[:left]] += 1
            freq[order[0]] += size - int(freq.sum())
        while left < 0:  # what the rarest got comes from the largest, in proportion
            take = np.minimum((freq - 1) * -left // max(1, int((freq - 1).sum())), freq - 1)
            if not take.any():
                order = np.lexsort((used, -freq))
                take[order[:-left]] = 1
            freq -= take
            left = size - int(freq.sum())
        freq[int(np.argmax(freq))] += size - int(freq.sum())
        out = np.zeros(len(counts), np.int64)
        out[used] = freq
        return cls(out)

    def symbols(self) -> np.ndarray:
        """The symbol of each slot."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)


@dataclass
class Coded:
    """A coded run of ids."""

    n: int
    lanes: int
    every: int              # steps between checkpoints
    states: np.ndarray      # uint64, a row of lanes for each checkpoint (the first at step 0)
    at: np.ndarray          # uint32, words before each checkpoint
    words: np.ndarray       # uint32


def lanes_for(n: int, most: int = LANES) -> int:
    """Lanes that suit a run of ``n`` ids: states cost eight bytes a lane."""
    return max(1, min(most, 1 << max(0, (n // 64).bit_length() - 1)))


def encode(ids: np.ndarray, table: Table, lanes: int, every: int) -> Coded:
    n = len(ids)
    steps = -(-n // lanes)
    freq_of, start_of = table.freq.astype(np.uint64), table.start.astype(np.uint64)
    scale, room = np.uint64(SCALE), np.uint64(53 - SCALE)
    state = np.full(lanes, _LOW, np.uint64)
    out: list[np.ndarray] = []
    kept: list[np.ndarray] = []
    ahead = 0
    for t in range(steps - 1, -1, -1):
        lo, hi = t * lanes, min((t + 1) * lanes, n)
        if t == steps - 1 or lo < ahead:
            ahead = max(0, t + 1 - _AHEAD) * lanes
            freq = freq_of.take(ids[ahead:hi])
            if len(freq) and int(freq.min()) == 0:
                raise ValueError("an id that the table does not have")
            start, real, most = start_of.take(ids[ahead:hi]), freq.astype(np.float64), freq << room
        x, here = state[:hi - lo], slice(lo - ahead, hi - ahead)
        give = np.flatnonzero(x >= most[here])
        moved = x.take(give)
        out.append(moved.astype(np.uint32))  # the low word
        x[give] = moved >> _WORD
        q = (x / real[here]).astype(np.uint64)
        x += start[here] - q * freq[here] + (q << scale)
        if t % every == 0:
            kept.append(state.copy())
    out.reverse()
    kept.reverse()
    sizes = np.cumsum([0, *(len(w) for w in out)])
    words = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return Coded(n, lanes, every, np.array(kept, np.uint64).reshape(-1, lanes), sizes[:-1][::every].astype(np.uint32) if steps else np.zeros(0, np.uint32), words)


def decode(coded: Coded, table: Table, symbols: np.ndarray, part: int) -> np.ndarray:
    """Ids from checkpoint ``part`` to the next one."""
    lanes, every = coded.lanes, coded.every
    lo, hi = part * every * lanes, min((part + 1) * every * lanes, coded.n)
    out = np.empty(hi - lo, np.uint32)
    state = coded.states[part].copy()
    words, p = coded.words.astype(np.uint64), int(coded.at[part])
    freq, start = table.freq.astype(np.uint64), table.start.astype(np.uint64)
    mask, scale = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for at in range(0, hi - lo, lanes):
        x = state[:min(lanes, hi - lo - at)]
        slot = x & mask
        s = symbols.take(slot.view(np.int64))
        out[at:at + len(x)] = s
        x >>= scale
        x *= freq.take(s)
        x += slot
        x -= start.take(s)
        need = np.flatnonzero(x < _LOW)
        if len(need):
            if p + len(need) > len(words):
                raise ValueError("the words of a coded run end too early")
            x[need] = (x.take(need) << _WORD) | words[p:p + len(need)]
            p += len(need)
    return out
