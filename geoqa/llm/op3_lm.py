"""Operator 3 - language-model scores from a log-frequency Bloom filter.

Unigrams and bigrams of the training documents are counted over the whole corpus.
The filter keeps a count c as ``1 + floor(log_b c)`` levels: an n-gram is inserted
once with each level up to its own, and its count is read back by probing level
after level until one is missing.  A level stands for the mean count of the n-grams
that have it.  Every n-gram of the training documents enters, whatever its count and
the size of the corpus.  Probabilities are a bigram model with absolute discounting,

    p(w | h) = max(c(h w) - D, 0) / c(h) + beta(h) * p(w),   p(w) = (c(w) + 1) / (N + V + 1),

where ``1 - beta(h)``, the discounted share of the bigrams of h, is stored in the same
filter in steps of 1 / ``SHARES``.

The filter grows with the corpus: ``ENTRY_BITS`` bits for each (n-gram, level), in as
many parts of at most ``FILTER_BITS`` bits as that takes.  An n-gram's key names its
part.  Tasks fill segments of the parts and write them to the shared folder; nothing of
the filter passes through the driver, and a worker reads and holds one part at a time:
it scans a group of texts (more text for more parts, up to ``GROUP``) and probes the
distinct n-grams of the group part after part.

A level stands for a mean count, so the probabilities after a history need not add up to
exactly one (tests hold their sum against it).

The exact unigram sum (base score) uses a broadcast table of at most ``TABLE``
frequent words and a shuffled join for all other words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, batches_of, crc32_of_id, only, stored, table, worker_cache
from geoqa.llm.files import opened, shared_folder

FILTER_BITS, PROBES, SEGMENTS = 1 << 28, 6, 64
ENTRY_BITS = 16
#: MB of text in the largest group (four for each part of the filter up to there).
GROUP = 16
BASE, DISCOUNT, SHARES = 1.5, 0.75, 20
TABLE = 1 << 20
#: Distinct n-grams that a counting task adds up before it hands them on.
HELD = 1 << 21
#: Keys that a look into the filter takes at once.
AT_ONCE = 1 << 14
#: Rows of n-grams in a batch.
SHORT = 1 << 16
#: Least weight of the unigram model after any history.
FLOOR = 0.02
#: Key of the end token (no word has it but by chance, 2^-64) - it also stands before the first word.
END = np.uint64(0xE0DE0DE0DE0DE0D1)


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Key of a bigram: 32 bits of its history's key, 32 of both words."""
    both = T.mix(first * np.uint64(0x9E3779B97F4A7C15) + T.mix(second ^ np.uint64(0x5555AAAA5555AAAA)))
    return (first & np.uint64(0xFFFFFFFF00000000)) | (both >> np.uint64(32))


def share_key(word: np.ndarray) -> np.ndarray:
    """Key under which the share of a history's bigrams is stored."""
    return T.mix(word ^ np.uint64(0x94D049BB133111EB))


def level_of(count: str) -> F.Column:
    """Levels of a count: 1 + floor(log_b count)."""
    return (F.floor(F.log(F.col(count)) / math.log(BASE) + 1e-9) + 1).cast("long")


def level_means(counts: DataFrame) -> np.ndarray:
    """Mean count of each level (0 for level 0)."""
    rows = counts.groupBy(level_of("n").alias("level")).agg(F.avg("n").alias("mean")).collect()  # a row a level
    out = np.zeros(max([r.level for r in rows], default=0) + 1)
    for r in rows:
        out[r.level] = r.mean
    return out


def tokens(w: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, key before) of every token: each row's words, then the end."""
    n = len(w.offsets) - 1
    at = np.cumsum(w.counts())
    key = np.insert(w.key, at, END)
    row = np.insert(w.doc, at, np.arange(n))
    before = np.empty_like(key)
    before[1:] = key[:-1]  # a row's first word follows the end of the row before it
    before[:1] = END
    return row, key, before


class _Counts:
    """Sums of counts by key, in sorted arrays, handed on when there are many."""

    def __init__(self, held: int):
        self.most, self.new, self.n_new = held, [], 0
        self.key, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, key: np.ndarray) -> None:
        self.new.append(np.unique(key, return_counts=True))
        self.n_new += len(self.new[-1][0])
        if self.n_new > self.most // 2:
            self._merge()

    def _merge(self) -> None:
        key = np.concatenate([self.key, *(k for k, _ in self.new)])
        n = np.concatenate([self.n, *(c for _, c in self.new)])
        self.new, self.n_new = [], 0
        by = np.argsort(key, kind="stable")
        key, n = key[by], n[by]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.key, self.n = key[first], np.add.reduceat(n, first) if len(first) else n

    def batch(self, order: int, least: int = 0):
        """What there is, if it is more than ``least``."""
        if len(self.key) + self.n_new > least:
            self._merge()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(self.key), order, np.int8)), pa.array(T.signed(self.key)), pa.array(self.n)], ["order", "key", "n"])
            self.key, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)


def ngram_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """``order, key, n`` of the unigrams (1) and bigrams (2) of (text), in one pass."""

    def run(batches):
        ones, twos = _Counts(held), _Counts(held)
        for b in batches:
            for _, _, data, offs in T.chunks(b.column(0)):
                _, key, before = tokens(T.scan(data, offs, T.SPACED, lower=True))
                ones.add(key)
                twos.add(pair_key(before, key))
                yield from ones.batch(1, held)
                yield from twos.batch(2, held)
        yield from ones.batch(1)
        yield from twos.batch(2)

    return arrow_map(docs.select("text"), run, "order byte, key long, n long").groupBy("order", "key").agg(F.sum("n").alias("n"))


class Filter:
    """A part of the blocked Bloom filter over (n-gram, level); a block is 512 bits in the segment of the n-gram's key."""

    def __init__(self, words: np.ndarray):
        self.words = words  # uint64, at most FILTER_BITS bits
        self.blocks = len(words) // SEGMENTS // 8

    @staticmethod
    def places(key: np.ndarray, level: int | np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(first word of the block within the segment, bit numbers in the block)."""
        h = T.mix(key ^ (np.uint64(0xC2B2AE3D27D4EB4F) * np.asarray(level, np.uint64)))
        block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64) * 8
        g = T.mix(h + np.uint64(0x165667B19E3779F9))
        return block, [(g >> np.uint64(9 * i)) & np.uint64(511) for i in range(PROBES)]

    @staticmethod
    def segment(key: np.ndarray) -> np.ndarray:
        return (T.mix(key) % np.uint64(SEGMENTS)).astype(np.int64)

    def has(self, key: np.ndarray, base: np.ndarray, level: int) -> np.ndarray:
        """Which of the keys, whose segments begin at the words ``base``, are there at a level (their indexes)."""
        h = T.mix(key ^ np.uint64(0xC2B2AE3D27D4EB4F * level & (1 << 64) - 1))
        block = (((h >> np.uint64(32)) * np.uint64(self.blocks) >> np.uint64(32)) << np.uint64(3)) + base
        g = T.mix(h + np.uint64(0x165667B19E3779F9))
        left = None
        for some in (range(2), range(2, PROBES)):  # most keys that are not there fail at the first two
            ok = np.uint64(1)
            for i in some:
                bit = g >> np.uint64(9 * i)
                ok = ok & (self.words[(block + ((bit >> np.uint64(6)) & np.uint64(7))).view(np.int64)] >> (bit & np.uint64(63)))
            hit = np.flatnonzero(ok)
            left = hit if left is None else left[hit]
            block, g = block[hit], g[hit]
        return left

    def levels(self, key: np.ndarray) -> np.ndarray:
        """The level of each key, by probes from level 1 on until one is missing.

        Keys are taken in the order of their segments, some at a time: then a segment and all that is
        made on the way stay in the processor's cache."""
        segment = self.segment(key)
        by = np.argsort(segment.astype(np.uint8), kind="stable")
        key, base = key[by], segment[by].view(np.uint64) * np.uint64(self.blocks * 8)
        found, rest = np.zeros(len(key), np.int64), []
        for lo in range(0, len(key), AT_ONCE):
            k, at = key[lo:lo + AT_ONCE], base[lo:lo + AT_ONCE]
            left = np.arange(len(k))
            for level in range(1, 4):
                left = left[self.has(k[left], at[left], level)]
                found[lo + left] = level
            rest.append(lo + left)
        left, level = np.concatenate(rest) if rest else np.zeros(0, np.int64), 3
        while len(left):
            level += 1
            left = left[self.has(key[left], base[left], level)]
            found[left] = level
        out = np.empty(len(key), np.int64)
        out[by] = found
        return out


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of the filter that has a key."""
    return (T.mix(key) // np.uint64(SEGMENTS) % np.uint64(parts)).astype(np.int64)


@dataclass
class Parts:
    """The filter in the shared folder: a file for each segment of each part (none: no n-gram has it)."""

    folder: str
    parts: int
    blocks: int  # of a segment

    def name(self, segment: int) -> str:
        return f"{self.folder}/segment-{segment}"

    def write(self, segment: int, words: np.ndarray) -> None:
        """A whole file at once; a task that runs again writes the same."""
        import uuid
        system, path = opened(self.name(segment))
        part = f"{path}.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as f:
            f.write(words.tobytes())
        system.move(part, path)

    def read(self, part: int) -> Filter:
        """The worker's part; it holds one."""
        mine = worker_cache("op3")
        if mine.get("part") != (self.folder, part):
            mine.clear()
            words = np.zeros(SEGMENTS * self.blocks * 8, np.uint64)
            system, folder = opened(self.folder)
            for s in range(SEGMENTS):
                try:
                    with system.open_input_file(f"{folder}/segment-{part * SEGMENTS + s}") as f:
                        words[s * self.blocks * 8:(s + 1) * self.blocks * 8] = np.frombuffer(f.read(), np.uint64)
                except FileNotFoundError:
                    pass
            mine.update(part=(self.folder, part), filter=Filter(words))
        return mine["filter"]

    def levels(self, key: np.ndarray) -> np.ndarray:
        """The level of each key, part by part."""
        out = np.zeros(len(key), np.int64)
        part = part_of(key, self.parts)
        by = np.argsort(part.astype(np.uint16) if self.parts <= 1 << 16 else part, kind="stable")  # short numbers are sorted by digits
        ends = np.searchsorted(part[by], np.arange(self.parts + 1))
        for p in range(self.parts):
            at = by[ends[p]:ends[p + 1]]
            if len(at):
                out[at] = self.read(p).levels(key[at])
        return out


def build_filter(entries: DataFrame, room: int, bits: int = FILTER_BITS) -> Parts:
    """The filter that holds (key, level), ``room`` of them in all; each segment is filled by one task."""
    parts = max(1, -(-room * ENTRY_BITS // bits))
    blocks = max(1, -(-room * ENTRY_BITS // (parts * SEGMENTS * 512)))
    out = Parts(shared_folder(entries.sparkSession, "filter"), parts, blocks)

    def mark(batches):
        for b in batches:
            key = b.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(part_of(key, parts) * SEGMENTS + Filter.segment(key)), b.column(0), b.column(1)], ["segment", "key", "level"])

    def fill(batches):
        segments: dict[int, np.ndarray] = {}
        for b in batches:
            seg, key, level = (b.column(i).to_numpy() for i in range(3))
            key = key.view(np.uint64)
            by = np.argsort(seg.astype(np.uint16), kind="stable")  # short numbers are sorted by digits; equal ones stay runs
            for part in np.split(by, np.flatnonzero(np.diff(seg[by])) + 1) if len(by) else ():
                own = int(seg[part[0]])
                if own not in segments:
                    segments[own] = np.zeros(blocks * 512, bool)
                marks = segments[own]
                k = np.repeat(key[part], level[part])
                block, places = Filter.places(k, T.spans(level[part]) + 1, blocks)
                block *= 64
                for p in places:
                    marks[block + p.view(np.int64)] = True
        for s, marks in segments.items():
            out.write(s, np.packbits(marks, bitorder="little").view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([len(segments)], pa.int64())], ["segments"])

    # a task has few segments, however many there are
    marked = arrow_map(entries.select("key", "level"), mark, "segment long, key long, level long", rows=SHORT).repartition(SEGMENTS * -(-parts // 4), "segment")
    with batches_of(entries.sparkSession, SHORT):
        arrow_map(marked, fill, "segments long", owner="op3", rows=SHORT).agg(F.sum("segments")).first()
    return out


def least_count(counts: DataFrame, room: int) -> int:
    """The smallest count from which on the n-grams fit ``room`` rows."""
    # counts above 2^16 share a row: there are few such n-grams
    hist = counts.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count("*").alias("m")).collect()  # <= 2^16 rows
    total, best = 0, (1 << 16) + 1
    for r in sorted(hist, key=lambda r: -r.n):
        total += r.m
        if total > room:
            break
        best = r.n
    return best


@dataclass
class Model:
    n: int              # training tokens
    v: int              # distinct ones
    means: tuple        # mean count by level of unigrams and of bigrams
    known: np.ndarray   # keys of frequent words, in order
    logs: np.ndarray    # their exact log10(count + 1)


def history_shares(one: DataFrame, two: DataFrame) -> DataFrame:
    """(key, level): for each history, by how many SHARES of its count its bigrams outweigh their discounts."""
    mass = two.groupBy(F.shiftright("key", 32).alias("h")).agg((F.sum("n") - DISCOUNT * F.count("*")).alias("mass"))
    rows = one.select("key", "n", F.shiftright("key", 32).alias("h")).join(mass, "h")
    rows = rows.select("key", F.least(F.ceil(SHARES * F.col("mass") / F.col("n")), F.lit(SHARES)).cast("long").alias("level")).where("level > 0")

    def rekey(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(T.signed(share_key(b.column(0).to_numpy().view(np.uint64)))), b.column(1)], ["key", "level"])

    return arrow_map(rows, rekey, "key long, level long", rows=SHORT)


def model_of(train: DataFrame, bits: int = FILTER_BITS, entries: int = TABLE):
    """(model, filter, unigram counts, least count of the frequent words) of the rows of (text)."""
    grams = stored(ngram_counts(train), "n-grams")
    one, two = (grams.where(F.col("order") == k).select("key", "n") for k in (1, 2))
    one = stored(one, "unigrams")  # read several times
    n, v = one.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    with batches_of(train.sparkSession, SHORT):
        shares = stored(history_shares(one, two), "shares")
    total = lambda df, level: df.agg(F.coalesce(F.sum(level), F.lit(0))).first()[0]
    room = total(one, level_of("n")) + total(two, level_of("n")) + total(shares, F.col("level"))
    levels = one.select("key", level_of("n").alias("level")).unionAll(two.select("key", level_of("n").alias("level")))
    parts = build_filter(levels.unionAll(shares), int(room), bits)
    low = 1 if v <= entries else least_count(one, entries)
    top = one.where(F.col("n") >= low).toArrow().combine_chunks()  # <= entries rows
    key = top.column("key").to_numpy().view(np.uint64)
    by = np.argsort(key)
    logs = np.log10(top.column("n").to_numpy()[by] + 1.0)
    return Model(int(n), int(v), (level_means(one), level_means(two)), key[by], logs), parts, one, low


def grouped(batches, size: int):
    """(ids, their number, row, distinct words, place of each token's word among them, key, key before) of the tokens of
    about ``size`` bytes of (id, text) at a time.  Each chunk's distinct words are found first, then those of all chunks."""
    held, total, rows = [], 0, 0

    def group():
        ids, row, key, before, words, places = zip(*held)
        held.clear()  # not kept beside the group
        word, place = np.unique(np.concatenate(words), return_inverse=True)
        of_chunk = np.split(place, np.cumsum([len(w) for w in words])[:-1])
        place = np.concatenate([all_[own] for all_, own in zip(of_chunk, places)])
        return pa.concat_arrays(ids), rows, np.concatenate(row), word, place, np.concatenate(key), np.concatenate(before)

    for b in batches:
        at = 0
        for lo, hi, data, offs in T.chunks(b.column(1)):
            new = int(offs[-1] - offs[0])
            if held and total + new > size:
                yield group()
                total, rows = 0, 0
            row, key, before = tokens(T.scan(data, offs, T.SPACED, lower=True))
            held.append((b.column(0).slice(at, hi - lo), row + rows, key, before, *np.unique(key, return_inverse=True)))
            total, rows, at = total + new, rows + hi - lo, at + hi - lo
    if held:
        yield group()


def score_texts(df: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits: int = FILTER_BITS, entries: int = TABLE) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``df`` under the model of the
    texts of ``train``.  Null text counts as empty: its one token is the end.  Rows keep their number,
    also with null or equal ids; without training rows all counts are 0 and N + V + 1 is 1."""
    docs = only(df, id=id_col, text=text_col)
    id_type = docs.schema["id"].dataType.simpleString()
    model, parts, one, low = model_of(only(train, text=text_col), bits, entries)
    shared = df.sparkSession.sparkContext.broadcast(model)
    log_total = math.log10(model.n + model.v + 1)
    n_train = model.n
    del model

    def run(batches):
        m = shared.value
        uid = TaskContext.get().partitionId() << 40
        for ids, rows, row, word, place, key, before in grouped(batches, min(4 * parts.parts, GROUP) * T.CHUNK):
            at = np.searchsorted(m.known, word)
            at[at == len(m.known)] = 0
            hit = m.known[at] == word if len(m.known) else np.zeros(len(word), bool)
            logs = np.where(hit, m.logs[at] if len(m.known) else 0.0, 0.0)
            base = np.bincount(row, logs[place], rows)
            known = np.bincount(row, hit[place], rows).astype(np.int64)
            n = np.bincount(row, minlength=rows)
            miss = ~hit[place]
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(np.bincount(row[miss], minlength=rows)))).astype(np.int32),
                                             pa.array(T.signed(key[miss])))
            ones, twos = m.means
            pairs, pair_place = np.unique(pair_key(before, key), return_inverse=True)
            level = parts.levels(np.concatenate((word, share_key(word), pairs)))
            level_one, share, level_two = np.split(level, [len(word), 2 * len(word)])
            count = ones[np.minimum(level_one, len(ones) - 1)]
            beta = 1 - np.minimum(share, SHARES) / SHARES
            last = np.roll(place, 1)  # the history is the token before; the first one's is the end, like the last token
            pair = twos[np.minimum(level_two, len(twos) - 1)][pair_place]
            seen = np.maximum(pair - DISCOUNT, 0) / np.maximum(count[last], np.maximum(pair, 1))
            p = np.minimum(seen + np.maximum(beta[last], FLOOR) * ((count + 1) / (m.n + m.v + 1))[place], 1.0)
            score = np.bincount(row, np.log10(p), rows)
            yield pa.RecordBatch.from_arrays([ids, pa.array(uid + np.arange(rows)), pa.array(n, pa.int64()), pa.array(known),
                                              pa.array(base), pa.array(score), lists], ["id", "uid", "n_tokens", "known", "logs", "score", "rare"])
            uid += rows

    out = stored(arrow_map(docs, run, f"id {id_type}, uid long, n_tokens long, known long, logs double, score double, rare array<long>", owner="op3"), "scores")
    rare = out.select("uid", F.explode("rare").alias("key")).join(one.where(F.col("n") < low), "key")
    more = rare.groupBy("uid").agg(F.sum(F.log10(F.col("n") + 1)).alias("more"), F.count("*").alias("found"))
    rows = out.drop("rare").join(more, "uid", "left")
    return rows.select("id", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
                       (F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * log_total).alias("base_score"), "score")


def op3_lm_scores(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc32_of_id(F.col("doc_id")) % 7 == 2
    out = score_texts(docs, docs.where(~held))
    return out.select(F.col("id").alias("doc_id"), (crc32_of_id(F.col("id")) % 7 == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
