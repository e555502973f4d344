"""Token ids of whole text columns from a byte-level BPE tokenizer.

A text is cut where white space begins after something else; the tokenizer never
joins tokens across such a place, so the ids of a text are those of its units, one
after the other.  A worker keeps the ids of the units it has met in flat arrays whose
bytes are bounded, and asks the tokenizer only for units it does not know.  Texts with
characters on which scanner and tokenizer may differ about white space are encoded
whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from geoqa.llm import textscan as T

#: Bytes that a worker's known units may take before it starts anew.
ARENA_BYTES = 28 << 20
#: Units that go to the tokenizer in one string.
RUN = 256


class KnownUnits:
    """Ids of the units a worker has met: key -> slice of one array.  A tokenizer's class says how new ones are made."""

    def __init__(self, kind: type, arena_bytes: int = ARENA_BYTES):
        self.kind, self.arena_bytes = kind, arena_bytes
        self.clear()

    def _new(self, w: T.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, ids, counts) of units ``which``."""
        raise NotImplementedError

    def clear(self) -> None:
        self.at = T.KeyMap()
        self.bound = np.zeros(1 << 12, np.uint32)  # of unit i's ids: bound[i] <= j < bound[i + 1]
        self.again = np.zeros(1 << 12, bool)       # unit i was met a second time
        self.ids, self.used = np.zeros(1 << 14, self.kind), 0

    def _make_room(self) -> None:
        """Keep the units that were met again; start anew if these are most of what is there."""
        key, number = self.at.items()
        stay = self.again[number]
        key, number = key[stay], number[stay]
        start = self.bound[number].astype(np.int64)
        count = self.bound[number + 1] - start
        ids = self.ids[np.repeat(start, count) + T.spans(count)]
        self.clear()
        if 16 * len(key) + ids.nbytes < 0.8 * self.arena_bytes:
            self._add(key, ids, count)

    def held(self) -> int:
        """Bytes in use."""
        return len(self.at) * 16 + self.used * self.ids.itemsize

    def _add(self, key: np.ndarray, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The numbers of the new units."""
        n = len(self.at)
        while n + len(count) >= len(self.bound):
            self.bound, self.again = (np.concatenate((x, np.zeros_like(x))) for x in (self.bound, self.again))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.bound[n + 1:n + 1 + len(count)] = self.used + np.cumsum(count)
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        number = n + np.arange(len(count), dtype=np.int32)
        self.at.add(key, number)
        return number

    def encode(self, w: T.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order, and the number of ids of each unit."""
        if self.held() > self.arena_bytes:
            self._make_room()
        key, first, place, times = np.unique(w.key, return_index=True, return_inverse=True, return_counts=True)
        unit = self.at.get(key)
        new = np.flatnonzero(unit < 0)
        self.again[unit[unit >= 0]] = True
        if len(new):
            by, ids, count = self._new(w, first[new])
            unit[new[by]] = self._add(key[new[by]], ids, count)
            self.again[unit[new]] = times[new] > 1
        unit = unit[place]
        start = self.bound[unit].astype(np.int64)
        size = self.bound[unit + 1] - start
        return self.ids[np.repeat(start, size) + T.spans(size)], size


class TokenIds(KnownUnits):
    """Ids of a byte-level BPE tokenizer of the tokenizers library."""

    def __init__(self, path: str, plain_specials: bool = False, arena_bytes: int = ARENA_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = plain_specials
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():  # the byte-level alphabet has a character for each byte
            self.n_bytes[i] = len(token)
        super().__init__(np.uint16 if len(self.n_bytes) <= 1 << 16 else np.uint32, arena_bytes)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, w: T.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units that begin with white space tokenize the same when they stand one after the other, so they
        go to the tokenizer in runs and the ids are told apart by their bytes; the others go one by one."""
        spaced = ~T.SPACED[w.data[w.start[which]]] & T.SPACED[w.data[w.end[which] - 1]]
        by = np.argsort(~spaced, kind="stable")
        which, m = which[by], int(spaced.sum())
        size = (w.end - w.start)[which]
        ids, count = np.zeros(0, self.kind), np.zeros(0, np.int64)
        if m:
            cut = list(range(0, m, RUN)) + [m]
            raw = w.data[np.repeat(w.start[which[:m]], size[:m]) + T.spans(size[:m])].tobytes()
            end = np.cumsum(size[:m])
            edge = [0, *(int(end[c - 1]) for c in cut[1:])]
            ids = np.concatenate([np.array(x, self.kind) for x in self._encode([raw[a:z].decode() for a, z in zip(edge, edge[1:])])])
            cover = np.cumsum(self.n_bytes[ids])
            done = np.searchsorted(cover, end) + 1
            count = np.diff(done, prepend=0)
            if len(ids) != done[-1] or int(cover[-1]) != len(raw):
                raise ValueError("the tokenizer's ids do not cover the text")
        if m < len(which):
            more = [np.array(self._encode([w.text(i).decode()])[0], self.kind) for i in which[m:]]
            ids = np.concatenate((ids, *more))
            count = np.concatenate((count, [len(x) for x in more])).astype(np.int64)
        return by, ids, count

    def rows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows ``offs`` of ``data``, one row after the other, and the number of each row."""
        w = T.scan(data, offs, with_gap=True)
        ids, size = self.encode(w)
        n = np.bincount(w.doc, size, len(offs) - 1).astype(np.int64)
        odd = _odd_rows(data, offs)
        if odd:
            each = np.split(ids, np.cumsum(n)[:-1])
            for i, text in odd.items():
                each[i] = np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind)
                n[i] = len(each[i])
            ids = np.concatenate(each)
        return ids, n


#: All bytes but the space, which is the only one that pieces of a sentencepiece model begin with.
_NOT_SPACE = np.arange(256) != 0x20


class PieceIds(KnownUnits):
    """Ids of a sentencepiece model that puts a space before the text: of texts that begin with that space.

    Units begin with the spaces before them.  That is exact for models in which no piece has a space after
    something else, where no merge crosses such a place; for others every text is one unit.  A unit whose
    pieces do not give its bytes back has no ids.
    """

    def __init__(self, path: str, arena_bytes: int = ARENA_BYTES):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.n_bytes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.cut = not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        self.space = self.model.piece_to_id("\u2581")
        super().__init__(np.uint16 if len(pieces) <= 1 << 16 else np.uint32, arena_bytes)

    def _new(self, w: T.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        units = [w.text(i) for i in which.tolist()]
        ids = self.model.encode([u[1:].decode() for u in units], num_threads=1)
        for i, u in enumerate(units):
            if u == b" ":  # of an empty text the model makes nothing
                ids[i] = [self.space]
            if b"".join([self.bytes_of[j] for j in ids[i]]) != u:
                ids[i] = []
        count = np.array([len(x) for x in ids], np.int64)
        return np.arange(len(which)), np.fromiter((j for x in ids for j in x), self.kind, int(count.sum())), count

    def rows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows that begin with a space, one row after the other, and the number of each row; rows
        whose pieces do not give their bytes back have none."""
        if self.cut:
            w = T.scan(data, offs, _NOT_SPACE, with_gap=True)
        else:
            full = np.flatnonzero(np.diff(offs))
            w = T.Words(full, offs[full], offs[full + 1], T.byte_keys(data, offs[full], offs[full + 1]), offs, data)
        ids, size = self.encode(w)
        rows = len(offs) - 1
        n = np.bincount(w.doc, size, rows).astype(np.int64)
        broken = np.zeros(rows, bool)
        broken[w.doc[size == 0]] = True
        if broken.any():  # the library has the last word on the text as a whole
            each = np.split(ids, np.cumsum(n)[:-1])
            for i in np.flatnonzero(broken).tolist():
                text = data[offs[i]:offs[i + 1]].tobytes()
                got = self.model.encode(text[1:].decode(), num_threads=1)
                got = got if b"".join([self.bytes_of[j] for j in got]) == text else []
                each[i], n[i] = np.array(got, self.kind), len(got)
            ids = np.concatenate(each)
        return ids, n


#: Characters that the tokenizer's pattern takes for white space and the scanner does
#: not, or might: a text that holds one is encoded whole.
_ODD_SPACE = re.compile("[%s]" % "".join(map(chr, (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF))))
_LEAD = np.zeros(256, bool)
_LEAD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True


def _odd_rows(data: np.ndarray, offs: np.ndarray) -> dict[int, str]:
    rows = np.unique(np.searchsorted(offs, np.flatnonzero(_LEAD[data]), "right") - 1).tolist()
    texts = ((i, data[offs[i]:offs[i + 1]].tobytes().decode()) for i in rows)
    return {i: t for i, t in texts if _ODD_SPACE.search(t)}


def ids_of_rows(known: TokenIds, col: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, lengths) of the rows of a string column, ``end_id`` after each row, by chunk of rows."""
    for _, _, data, offs in T.chunks(col):
        ids, n = known.rows(data, offs)
        yield np.insert(ids, np.cumsum(n), end_id), n + 1
