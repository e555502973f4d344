"""Operator 7 - benchmark decontamination with a distributed positional inverted index.

The documents are indexed once: each segment (two megabytes of text, or one document) keeps its
sorted terms, and for each term the ascending positions of its occurrences; the
segments are written as a table in the shared folder.  Test windows are searched
in every segment, starting from each window's rarest term there: its positions,
less the term's place in the window, are the candidate starts, and the lists of
the other terms, adjusted by their places, are intersected in order of rarity.
Proximity matches come from the same lists: all terms within ``SLOP`` words
beyond the window's length around the rarest one.

Test items go to the workers in blocks of at most about ``BLOCK_WORDS`` words
(one window is 8 bytes a word), one search of the stored index for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, only, stored, table, without_ids

WINDOW, SLOP = 10, 5
SEGMENT_BYTES = 2 << 20
BLOCK_WORDS = 1 << 18


def build_index(docs: DataFrame) -> DataFrame:
    """Segments of the rows of (id, text): ``segment, ids, n_words, terms, counts, deltas``.

    ``terms`` are sorted 64-bit keys; ``counts`` the occurrences of each; ``deltas`` the
    positions of each term in the segment's words, each less the one before it (32 bits).
    """
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        segment = TaskContext.get().partitionId() << 32
        for b in batches:
            at = 0
            for lo, hi, data, offs in T.chunks(b.column(1), SEGMENT_BYTES):
                w = T.scan(data, offs, T.ALNUM, lower=True)
                by = np.argsort(w.key, kind="stable")
                terms, first, counts = np.unique(w.key[by], return_index=True, return_counts=True)
                delta = np.diff(by, prepend=0)
                delta[first] = by[first]
                n = pa.array(w.counts(), pa.int32())
                one = [0, hi - lo]
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment], pa.int64()), pa.ListArray.from_arrays(one, b.column(0).slice(at, hi - lo)), pa.ListArray.from_arrays(one, n),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (terms, counts.astype("<u4"), delta.astype("<u4")))],
                    ["segment", "ids", "n_words", "terms", "counts", "deltas"])
                segment += 1
                at += hi - lo

    return arrow_map(docs, run, f"segment long, ids array<{id_type}>, n_words array<int>, terms binary, counts binary, deltas binary")


def windows_of(items: list, size: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(window keys (windows x length), item number of each)] by window length."""
    by_length: dict[int, list] = {}
    for i, keys in enumerate(T.keys_of([r.text or "" for r in items], T.ALNUM, lower=True)):
        m = min(size, len(keys))
        if m:
            w = np.lib.stride_tricks.sliding_window_view(keys, m)
            by_length.setdefault(m, []).append((w, np.full(len(w), i)))
    out = []
    for parts in by_length.values():
        w, i = (np.concatenate(x) for x in zip(*parts))
        _, first = np.unique(np.column_stack((w, i.astype(np.uint64))), axis=0, return_index=True)
        out.append((w[first], i[first]))
    return out


class Segment:
    """One segment's lists, ready to be asked for offsets of terms."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, deltas: np.ndarray):
        self.terms, self.counts = terms, counts.astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        total = np.cumsum(deltas.astype(np.int64))
        base = total[self.first] - deltas[self.first] if len(terms) else total
        self.position = total - np.repeat(base, self.counts)
        #: ascending over all lists: a term's list is a range of it
        self.key = (np.repeat(np.arange(len(terms)), self.counts) << 32) | self.position

    def find(self, windows: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(window, start) of exact matches and (window, position of its rarest term) of proximity matches."""
        none = np.zeros(0, np.int64)
        if not len(self.terms):
            return none, none, none, none
        size = windows.shape[1]
        term = np.searchsorted(self.terms, windows)
        term[term == len(self.terms)] = 0
        here = np.flatnonzero((self.terms[term] == windows).all(axis=1))
        term = term[here]
        order = np.argsort(self.counts[term], axis=1, kind="stable")  # rarest first
        rare = term[np.arange(len(here)), order[:, 0]]
        n = self.counts[rare]
        which = np.repeat(np.arange(len(here)), n)
        anchor = self.position[np.repeat(self.first[rare], n) + T.spans(n)]
        exact_w, start = which, anchor - order[which, 0]
        near_w, near = which, anchor
        for j in range(1, size):
            place = order[exact_w, j]
            ask = (term[exact_w, place] << 32) | (start + place)
            at = np.minimum(np.searchsorted(self.key, ask), len(self.key) - 1)
            ok = (start >= 0) & (self.key[at] == ask)
            exact_w, start = exact_w[ok], start[ok]
            t = term[near_w, order[near_w, j]]
            low = (t << 32) | np.maximum(near - size - slop + 1, 0)
            at = np.searchsorted(self.key, low)
            ok = at < len(self.key)
            ok[ok] = self.key[at[ok]] <= ((t[ok] << 32) | (near[ok] + size + slop - 1))
            near_w, near = near_w[ok], near[ok]
        if size == 1:
            exact_w, start = exact_w[start >= 0], start[start >= 0]
        return here[exact_w], start, here[near_w], near


def search(index: DataFrame, items: list, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Matches of one block of test items (id, text): ``segment, row, hits, items, near`` of each
    document with any; ``hits`` are word places, ``items`` and ``near`` item ids as text."""
    names = [None if r.id is None else str(r.id) for r in items]
    shared = index.sparkSession.sparkContext.broadcast((windows_of(items, window), names))

    def run(batches):
        queries, names = shared.value
        for b in batches:
            for i in range(b.num_rows):
                raw = [np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in (("terms", "<u8"), ("counts", "<u4"), ("deltas", "<u4"))]
                seg = Segment(*raw)
                first = np.concatenate(([0], np.cumsum(b.column("n_words")[i].values.to_numpy(zero_copy_only=False))))
                hits, found, near = {}, {}, {}
                for win, item in queries:
                    size = win.shape[1]
                    w, start, nw, at = seg.find(win, slop)
                    row = np.searchsorted(first, start, "right") - 1
                    ok = start + size <= first[row + 1]  # not across two documents
                    for r, s, k in zip(row[ok].tolist(), (start - first[row])[ok].tolist(), item[w][ok].tolist()):
                        hits.setdefault(r, set()).update(range(s, s + size))
                        found.setdefault(r, set()).add(k)
                        near.setdefault(r, set()).add(k)
                    for r, k in zip((np.searchsorted(first, at, "right") - 1).tolist(), item[nw].tolist()):
                        near.setdefault(r, set()).add(k)
                rows = sorted(near)
                if rows:
                    text = lambda x: [[names[k] for k in sorted(x.get(r, ())) if names[k] is not None] for r in rows]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.column("segment")[i].as_py()] * len(rows), pa.int64()), pa.array(rows, pa.int32()),
                        pa.array([sorted(hits.get(r, ())) for r in rows], pa.list_(pa.int32())),
                        pa.array(text(found), pa.list_(pa.string())), pa.array(text(near), pa.list_(pa.string()))],
                        ["segment", "row", "hits", "items", "near"])

    return arrow_map(index, run, "segment long, row int, hits array<int>, items array<string>, near array<string>")


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = SLOP,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``id, n_words, n_hit, items, near_items`` of every row; lists are sorted and distinct.

    Rows keep their number, also with equal or null ids.  Null or empty texts have no
    words and no hits; items without words are never found; items that share an id count
    once; an item without an id marks words but is in no list.  Empty tables give no
    rows, or rows without hits.
    """
    docs = only(df, id=id_col, text=text_col)
    index = stored(build_index(docs), "index")
    tests = only(benchmark, id=item_col, text=item_text_col).where("text is not null")
    words = tests.agg(F.sum(F.length("text") / 2)).first()[0] or 0  # at most so many words
    blocks = int(words // block_words) + 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    parts = []
    for k in range(blocks):
        parts.append(search(index, tests.where(block == k).collect(), window, slop))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    merged = found.groupBy("segment", "row").agg(*[
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hits", "items", "near")])
    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "n_words")).alias("row", "d")).select("segment", "row", "d.ids", "d.n_words")
    empty = F.array().cast("array<string>")
    return rows.join(merged, ["segment", "row"], "left").select(
        F.col("ids").alias("id"), F.col("n_words").cast("long").alias("n_words"), F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", empty).alias("items"), F.coalesce("near", empty).alias("near_items"))


def without_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, whole, of documents without a hit; rows that share an id are one document."""
    hit = stored(decontaminate(df, benchmark, id_col, text_col).where("n_hit > 0").select("id"), "hit")
    return without_ids(df, id_col, hit)


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS l, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS g
       FROM b, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS t(i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
hit AS (SELECT r, i, o.l, item_id
        FROM (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS g
              FROM d, (SELECT DISTINCT l FROM bw) AS ls, unnest(range(1, len(w) - l + 2)) AS t(i)) AS o
        JOIN bw ON bw.g = o.g AND bw.l = o.l),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + l)) AS t(p) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
