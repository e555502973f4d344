"""Operator 4 - duplicated passages by seeds, collinear chains and alignment.

1. Each document's minimizers (``K``-word seeds, the smallest key of every
   ``WINDOW`` in a row) are joined with the first occurrence of the same seed: the
   smallest (id, place), in an earlier document or earlier in the same one.  That is
   one row per seed and document, not one per pair; the first occurrences are minima,
   so a seed that a third of all rows hold is pre-aggregated before the shuffle and
   its join partition can be split.
2. Per document and earlier document, runs of seeds on one diagonal become anchors,
   and ordered anchors are chained with a gap cost through a Fenwick tree over the
   places in the earlier document.
3. Chains of two seeds or more, and single seeds beside them, are aligned on the words of both documents: outwards
   from the ends with a drop-off, and by edit distance in the gaps, so a passage keeps
   together over replaced, lost or added words.  What counts is the alignment: a span
   of ``MIN_WORDS`` at the asked identity, or a nearly exact one of ``MIN_SPAN`` words.
4. Aligned spans of a document that touch are merged; merged passages of
   ``MIN_WORDS`` or more are duplicates of earlier text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, asked, gather, only, split_by_ids, stored, table

K, WINDOW = 5, 5
#: Words a chain may skip between two anchors, cost of a skipped word, words a chain must cover (two seeds).
MAX_GAP, GAP_COST, MIN_CHAIN = 40, 0.05, K + 1
MIN_WORDS, IDENTITY = 40, 0.75
#: A span of fewer than ``MIN_WORDS`` words counts towards a passage with so many equal words at such identity.
MIN_SPAN, SPAN_IDENTITY = 12, 0.9
#: Words around a chain that its alignment sees; what lies beyond has seeds of its own.
REACH = 96
#: Spans with at most so many words between them are one passage.
MERGE = 3
#: Documents that one task aligns with one earlier document; more are dealt to several.
HUB_MEMBERS = 256


def minimizers(w: T.Words, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place of the first word in the row, key) of the seeds of every row."""
    roll = T.rolling(w.key, k)
    inside = np.flatnonzero(w.doc[:len(roll)] == w.doc[k - 1:]) if len(roll) else np.zeros(0, np.int64)
    if not len(inside):
        return inside, inside, np.zeros(0, np.uint64)
    row, key = w.doc[inside], roll[inside]
    # in a run of one word every seed is the same: its distance to the run's end tells them apart
    go = (key[1:] == key[:-1]) & (row[1:] == row[:-1])
    stop = np.flatnonzero(np.append(~go, True))
    key = T.mix(key + (stop[np.searchsorted(stop, np.arange(len(key)))] - np.arange(len(key))).astype(np.uint64))
    # rows stand apart by window - 1 largest keys, so a window never mixes two rows
    rank = np.concatenate(([0], np.cumsum(row[1:] != row[:-1])))
    at = np.arange(len(key)) + rank * (window - 1)
    line = np.full(at[-1] + window, np.uint64(0xFFFFFFFFFFFFFFFF))
    line[at] = key
    low = line[:len(line) - window + 1].copy()
    for j in range(1, window):
        np.minimum(low, line[j:len(line) - window + 1 + j], out=low)
    # a place is chosen if some window that covers it has its key as smallest
    take = np.zeros(len(key), bool)
    for j in range(window):
        start = at - j
        ok = start >= 0
        take[ok] |= low[start[ok]] == key[ok]
    take = np.flatnonzero(take)
    return row[take], inside[take] - w.first()[row[take]], key[take]


def seeds(docs: DataFrame) -> DataFrame:
    """``key, id, at`` of every document with an id."""

    def run(batches):
        for b in batches:
            for lo, _, data, offs in T.chunks(b.column(1)):
                row, at, key = minimizers(T.scan(data, offs, T.SPACED, lower=True))
                yield pa.RecordBatch.from_arrays([pa.array(T.signed(key)), b.column(0).take(pa.array(row + lo)), pa.array(at, pa.int32())], ["key", "id", "at"])

    return arrow_map(docs.where("id is not null"), run, f"key long, id {docs.schema['id'].dataType.simpleString()}, at int")


def fenwick_chains(x0, x1, y0, y1, gap_cost: float = GAP_COST, max_gap: int = MAX_GAP, least: int = MIN_CHAIN) -> list[list[int]]:
    """Disjoint chains of anchors (x0..x1 in one text, y0..y1 in the other), best first.

    score(i) = words of i + max(0, max over j that end before i in both texts of
    score(j) - gap_cost * (skipped words in x and y)); the inner maximum is a prefix
    maximum over y ends of score(j) + gap_cost * (x1(j) + y1(j)), kept in a Fenwick tree.
    """
    n = len(x0)
    ends = sorted(set(y1))
    tree = [(-float("inf"), -1)] * (len(ends) + 1)
    score, back = [0.0] * n, [-1] * n
    starts = sorted(range(n), key=lambda i: (x0[i], y0[i]))
    done = sorted(range(n), key=lambda i: x1[i])
    d = 0
    for i in starts:
        while d < n and x1[done[d]] <= x0[i]:  # anchors that end before this one begins
            j = done[d]
            if score[j]:
                value, p = (score[j] + gap_cost * (x1[j] + y1[j]), j), bisect_left(ends, y1[j]) + 1
                while p <= len(ends):
                    tree[p] = max(tree[p], value)
                    p += p & -p
            d += 1
        best, p = (-float("inf"), -1), bisect_left(ends, y0[i] + 1)
        while p:
            best = max(best, tree[p])
            p -= p & -p
        score[i] = float(x1[i] - x0[i])
        j = best[1]
        gain = best[0] - gap_cost * (x0[i] + y0[i])
        if j >= 0 and gain > 0 and x0[i] - x1[j] <= max_gap and y0[i] - y1[j] <= max_gap:
            score[i] += gain
            back[i] = j
    chains, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain and sum(x1[j] - x0[j] for j in chain) >= least:
            chains.append(chain[::-1])
    return chains


def chain_matches(docs: DataFrame, k: int = K) -> DataFrame:
    """``id, hub, chains``: for each document and earlier document with shared seeds (or the document
    itself, further ahead), its chains, each a list of anchors (x0, x1, y0, y1) in words."""
    id_type = docs.schema["id"].dataType.simpleString()
    found = seeds(docs)
    first = found.groupBy("key").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stored(first.select("key", "first"), "first")  # an input of its own, so that the join can split a hot seed's partition
    match = found.join(first, "key").where(f"id <> first.id or at >= first.at + {k}").select("id", F.col("first.id").alias("hub"), F.col("at").alias("x"), F.col("first.at").alias("y"))
    match = match.repartition("id").sortWithinPartitions("id", "hub", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in gather(batches, ["id"]):
            x, y = (b.column(c).to_numpy().astype(np.int64) for c in ("x", "y"))
            new = np.ones(len(x), bool)
            for c in ("id", "hub"):
                v = b.column(c).to_numpy(zero_copy_only=False)
                new[1:] = (v[1:] != v[:-1]) | (new[1:] if c == "hub" else False)
            pair = np.cumsum(new) - 1
            # anchors: seeds on one diagonal without a hole
            brk = new.copy()
            brk[1:] |= (x[1:] - y[1:] != x[:-1] - y[:-1]) | (x[1:] - x[:-1] > k)
            a = np.flatnonzero(brk)
            z = np.append(a[1:], len(x)) - 1
            x0, x1, y0, y1, of = x[a], x[z] + k, y[a], y[z] + k, pair[a]
            edge = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            doc = (np.cumsum(np.append(True, b.column("id").to_numpy(zero_copy_only=False)[1:] != b.column("id").to_numpy(zero_copy_only=False)[:-1])) - 1)[a]
            rows, chains = [], []
            weak: list[tuple[int, int, list[int]]] = []  # chains of one seed: (document, row, chain)
            long: dict[int, list[tuple[int, int]]] = {}  # places of the longer ones
            for lo, hi in zip(edge.tolist(), np.append(edge[1:], len(of)).tolist()):
                anchors = [v[lo:hi].tolist() for v in (x0, x1, y0, y1)]
                got, d = [], int(doc[lo])
                for c in [[0]] if hi - lo == 1 else fenwick_chains(*anchors, least=k):
                    flat = [v[i] for i in c for v in anchors]
                    if sum(anchors[1][i] - anchors[0][i] for i in c) >= MIN_CHAIN:
                        got.append(flat)
                        long.setdefault(d, []).append((flat[0], flat[-3]))
                    else:
                        weak.append((d, int(a[lo]), flat))
                if got:
                    rows.append(int(a[lo]))
                    chains.append(got)
            for d, row, flat in weak:
                if any(p - MIN_WORDS <= flat[0] <= q + MIN_WORDS for p, q in long.get(d, ())):
                    rows.append(row)
                    chains.append([flat])
            if rows:
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([b.column("id").take(take), b.column("hub").take(take), pa.array(chains, pa.list_(pa.list_(pa.int32())))],
                                                 ["id", "hub", "chains"])

    return arrow_map(match, run, f"id {id_type}, hub {id_type}, chains array<array<int>>")


def _gap(a: np.ndarray, b: np.ndarray) -> int:
    """Words of ``a`` that an optimal alignment (edit distance) matches with ``b``."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0
    if n == m:
        same = int((a == b).sum())
        if 2 * same >= n - 1:  # a few replaced words
            return same
    row = [(j, 0) for j in range(m + 1)]  # (edits, -matches)
    for i in range(n):
        prev, row = row, [(i + 1, 0)]
        for j in range(m):
            c, s = prev[j]
            hit = a[i] == b[j]
            row.append(min((c + (not hit), s - hit), (prev[j + 1][0] + 1, prev[j + 1][1]), (row[j][0] + 1, row[j][1])))
    return -row[m][1]


def _outwards(a: np.ndarray, b: np.ndarray, step: int, drop: float = 8.0) -> int:
    """Words by which an end moves: +1 for an equal word, -2 for a replaced one, until ``drop`` below the best."""
    n = min(len(a), len(b))
    if not n:
        return 0
    same = a[:n] == b[:n] if step > 0 else a[::-1][:n] == b[::-1][:n]
    score = np.cumsum(np.where(same, 1.0, -2.0))
    best = np.maximum.accumulate(np.maximum(score, 0))
    stop = np.flatnonzero(score < best - drop)
    if len(stop):
        score = score[:stop[0]]
    at = int(np.argmax(score)) if len(score) else 0
    return at + 1 if len(score) and score[at] > 0 else 0


def align(a: np.ndarray, lo: int, b: np.ndarray, chain: list[int]) -> tuple[int, int, int, int, int]:
    """Aligned (x0, x1, y0, y1, matched words) of a chain; ``a`` are words of the document from place
    ``lo`` on, ``b`` all words of the earlier one.  Anchors are checked on the words, too."""
    c = np.array(chain).reshape(-1, 4)
    matched = 0
    for i, (x0, x1, y0, y1) in enumerate(c.tolist()):
        p, q = a[x0 - lo:x1 - lo], b[y0:y1]
        if len(p) != len(q):
            return 0, 0, 0, 0, 0
        matched += int((p == q).sum())
        if i:
            matched += _gap(a[c[i - 1, 1] - lo:x0 - lo], b[c[i - 1, 3]:y0])
    x0, x1, y0, y1 = int(c[0, 0]), int(c[-1, 1]), int(c[0, 2]), int(c[-1, 3])
    left = _outwards(a[max(0, x0 - lo - REACH):x0 - lo], b[max(0, y0 - REACH):y0], -1)
    right = _outwards(a[x1 - lo:x1 - lo + REACH], b[y1:y1 + REACH], 1)
    if left:
        matched += int((a[x0 - lo - left:x0 - lo] == b[y0 - left:y0]).sum())
    if right:
        matched += int((a[x1 - lo:x1 - lo + right] == b[y1:y1 + right]).sum())
    return x0 - left, x1 + right, y0 - left, y1 + right, matched


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      identity: float = IDENTITY) -> DataFrame:
    """``id, other, x0, x1, y0, y1, identity, p0, p1``: words x0..x1 of a document repeat words y0..y1 of the
    earlier document ``other``, or earlier ones of its own, and are part of its repeated passage p0..p1
    (``min_words`` or more).

    Words are cut at ASCII white space, A-Z lower-cased.  Rows without an id, text or words take no
    part; rows that share an id are one document with several texts: what one of them has in an earlier
    place than another counts, equal places do not; exact copies are one passage each.  An empty table
    gives no rows.
    """
    docs = only(df, id=id_col, text=text_col)
    id_type = docs.schema["id"].dataType.simpleString()
    chains = stored(chain_matches(docs), "chains")
    parts = chains.groupBy("hub").agg(F.ceil(F.count("*") / HUB_MEMBERS).cast("int").alias("parts"))
    ask = chains.join(parts, "hub").withColumn("part", F.expr("cast(pmod(xxhash64(id), parts) as int)"))
    # one row per document with all it is asked for: its own chains by hub, and its parts as a hub
    members = ask.groupBy("id").agg(F.collect_list(F.struct("hub", "part", "chains")).alias("own"))
    wanted = members.join(parts.withColumnRenamed("hub", "id"), "id", "full")
    texts = asked(docs, wanted)
    both = f"hub {id_type}, part int, role int, id {id_type}, lo int, chain array<int>, words binary"

    def cut(batches):
        for b in batches:
            out = []
            ids, own, parts_ = b.column("id").to_pylist(), b.column("own"), b.column("parts").to_pylist()
            for lo, hi, data, offs in T.chunks(b.column("text")):
                w = T.scan(data, offs, T.SPACED, lower=True)
                f, key = w.first(), w.key.astype(np.uint32)
                for i in range(lo, hi):
                    words = key[f[i - lo]:f[i - lo + 1]]
                    for r in own[i].as_py() or ():
                        for c in r["chains"]:
                            a, z = max(0, c[0] - REACH), c[-3] + REACH
                            out.append((r["hub"], r["part"], 1, ids[i], a, c, words[a:z].tobytes()))
                    for p in range(parts_[i] or 0):
                        out.append((ids[i], p, 0, None, None, None, words.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out), (
                        b.column("id").type, pa.int32(), pa.int32(), b.column("id").type, pa.int32(), pa.list_(pa.int32()), pa.binary()))],
                        ["hub", "part", "role", "id", "lo", "chain", "words"])
                    out = []

    rows = arrow_map(texts.select("id", "text", "own", "parts"), cut, both)
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "role")

    def meet(batches):
        now, texts_ = None, []
        for b in batches:
            out = []
            hub, part, role, lo, chain = (b.column(c).to_pylist() for c in ("hub", "part", "role", "lo", "chain"))
            for i in range(b.num_rows):
                if (hub[i], part[i]) != now:
                    now, texts_ = (hub[i], part[i]), []
                words = np.frombuffer(b.column("words")[i].as_buffer(), np.uint32)
                if role[i] == 0:
                    texts_.append(words)
                    continue
                for t in texts_:
                    x0, x1, y0, y1, same = align(words, lo[i], t, chain[i])
                    size = max(x1 - x0, y1 - y0)
                    if size and same >= identity * size and (x1 - x0 >= min_words or same >= max(MIN_SPAN, SPAN_IDENTITY * size)):
                        out.append((i, x0, x1, y0, y1, same / size))
                        break
            if out:
                i, *v = zip(*out)
                take = pa.array(i)
                yield pa.RecordBatch.from_arrays([b.column("id").take(take), b.column("hub").take(take), *(pa.array(list(x), pa.int32()) for x in v[:4]), pa.array(list(v[4]))],
                                                 ["id", "other", "x0", "x1", "y0", "y1", "identity"])

    spans = arrow_map(rows, meet, f"id {id_type}, other {id_type}, x0 int, x1 int, y0 int, y1 int, identity double")
    # spans of a document that touch are one passage
    own = Window.partitionBy("id").orderBy("x0", "x1", "other", "y0")
    reach = F.max("x1").over(own.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("run", F.sum(F.when(F.col("x0") > F.coalesce(reach, F.lit(-MERGE - 1)) + MERGE, 1).otherwise(0)).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("id", "run")
    return (spans.withColumn("p0", F.min("x0").over(run)).withColumn("p1", F.max("x1").over(run)).drop("run")
            .where(F.col("p1") - F.col("p0") >= min_words))


def without_passages(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """``df`` with the passages p0..p1 of ``spans`` cut out of its texts: the words and the white space
    after them go, all other text stays as it is.  Rows whose every word is cut go; rows without spans
    stay untouched.  ``size_col`` names a column that holds the text's code points."""
    passages = stored(spans.select("id", F.struct("p0", "p1").alias("p")).distinct().groupBy("id").agg(F.sort_array(F.collect_list("p")).alias("cuts of the text"))
                      .select(F.col("id").alias("id of the cuts"), "cuts of the text"), "passages")
    maybe, sure = split_by_ids(df, id_col, passages.select(F.col("id of the cuts").alias("id")))
    cut = maybe.hint("merge").join(passages, F.col(f"`{id_col}`") == F.col("id of the cuts"), "left").drop("id of the cuts")
    names = df.columns

    def run(batches):
        for b in batches:
            texts, keep = [], []
            cuts = b.column(len(names)).to_pylist()
            for lo, hi, data, offs in T.chunks(b.column(names.index(text_col))):
                w = T.scan(data, offs)
                f = w.first()
                for i in range(lo, hi):
                    a, z = int(f[i - lo]), int(f[i - lo + 1])
                    begin, end = int(offs[i - lo]), int(offs[i - lo + 1])
                    stay = np.ones(end - begin, bool)
                    gone = np.zeros(z - a, bool)
                    for p in cuts[i] or ():
                        p0, p1 = min(p["p0"], z - a), min(p["p1"], z - a)
                        if p1 > p0:
                            stop = w.start[a + p1] if a + p1 < z else end
                            stay[w.start[a + p0] - begin:stop - begin] = False
                            gone[p0:p1] = True
                    texts.append(data[begin:end][stay].tobytes().decode())
                    keep.append(not gone.all() or not len(gone))
            old = b.column(names.index(text_col))
            texts = [None if not v else t for t, v in zip(texts, old.is_valid().to_pylist())]
            new = {text_col: pa.array(texts, pa.string())}
            if size_col:
                kind = b.column(names.index(size_col)).type
                new[size_col] = pa.array([len(t) if c and t is not None else n for t, c, n in zip(texts, cuts, b.column(names.index(size_col)).to_pylist())], kind)
            if len(texts):
                yield pa.RecordBatch.from_arrays([new.get(n, b.column(i)) for i, n in enumerate(names)], names).filter(pa.array(keep, pa.bool_()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return sure.unionByName(arrow_map(cut, run, schema))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """One row per repeated span: the document, the earlier document that has the words, both places."""
    out = repeated_passages(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("other").alias("other_doc_id"), F.col("x0").alias("first_word"), F.col("x1").alias("end_word"),
                      F.col("y0").alias("other_first_word"), F.col("y1").alias("other_end_word"), "identity",
                      F.col("p0").alias("passage_first"), F.col("p1").alias("passage_end"))
