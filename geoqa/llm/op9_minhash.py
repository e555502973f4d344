"""Operator 9 - near duplicates by one-permutation hashing and star-shaped candidates.

1. One pass makes each document's set of five-word shingles, its size, a 128-bit
   fingerprint of the set and a one-permutation MinHash of ``BANDS * ROWS`` slots.
   Each empty slot borrows from the first filled slot of its own fixed random
   order (optimal densification), so borrowed slots stay independent samples.
2. Documents with equal sets collapse to the one with the smallest id.
3. Bands of ``ROWS`` slots are bucket keys.  A bucket of n documents gives n - 1
   edges to its leader, never all pairs; the leader is the member that meets most
   documents over all its buckets (an original meets all its variants), and each
   document tries the leader that it meets most often.
4. Links are confirmed on the full shingle sets.
5. Exact rest: documents of buckets that still hold several components are joined
   on their rarest shingles.  Two sets at the asked similarity share a shingle among
   the first ``n - ceil(0.75 n) + 1`` of each, in order of rarity, at places that
   leave enough room after them; so no pair of these documents is given up, and the
   shingles that whole groups share bring no pairs.

With 40 bands of 4 rows a pair at similarity 0.75 shares no bucket with
probability 2.5e-7, and less above: such a pair is lost, because the exact rest
reaches only documents that share a bucket with another component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, asked, only, split_by_ids, stored, table, without_ids

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 40, 4
#: Members of one hub that one task compares; larger groups are dealt to several.
HUB_MEMBERS = 512


def shingles(w: T.Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every ``k``-word shingle; a shorter text is one shingle, no words give none."""
    n = w.counts()
    roll = T.rolling(w.key, k)
    inside = w.doc[:len(roll)] == w.doc[k - 1:] if len(roll) else np.zeros(0, bool)
    row, key = w.doc[:len(roll)][inside], roll[inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first = w.first()
        extra = [T.rolling(w.key[first[i]:first[i + 1]], int(n[i]), salt=int(n[i]))[0] for i in short]
        row, key = np.concatenate((row, short)), np.concatenate((key, np.array(extra, np.uint64)))
    return row, key


def distinct(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, key), in no particular order."""
    _, first = np.unique(T.mix(key + T.mix(row.astype(np.uint64) + np.uint64(1))), return_index=True)
    return row[first], key[first]


_orders: dict[int, np.ndarray] = {}


def _borrow_rank(slots: int) -> np.ndarray:
    """rank[i, s]: at which attempt empty slot i asks slot s; a fixed random order per slot."""
    if slots not in _orders:
        rng = np.random.default_rng(slots)
        _orders[slots] = np.argsort(rng.random((slots, slots)), axis=1).argsort(axis=1).astype(np.uint16)
    return _orders[slots]


def one_permutation(row: np.ndarray, key: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """MinHash matrix (rows x slots); rows without shingles stay at the largest value."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full(rows * slots, top)
    slot = ((key >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(sig, row * slots + slot, T.mix(key))
    sig = sig.reshape(rows, slots)
    rank = _borrow_rank(slots)
    filled = sig != top
    for i in np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1)):
        have, lack = np.flatnonzero(filled[i]), np.flatnonzero(~filled[i])
        sig[i, lack] = sig[i, have[np.argmin(rank[np.ix_(lack, have)], axis=1)]]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    s = sig.reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2]).copy()
    for j in range(rows):
        h = T.mix(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, j])
    return h


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, n, fp1, fp2, bands`` of every row of (id, text); ``bands`` is null for an empty set."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            at = 0
            for lo, hi, data, offs in T.chunks(b.column(1)):
                m = hi - lo
                row, key = distinct(*shingles(T.scan(data, offs, T.SPACED, lower=True)))
                n = np.bincount(row, minlength=m)
                fp = [np.zeros(m, np.uint64), np.zeros(m, np.uint64)]
                np.add.at(fp[0], row, T.mix(key ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
                np.add.at(fp[1], row, T.mix(key + np.uint64(0x0123456789ABCDEF)))
                keys = band_keys(one_permutation(row, key, m, bands * rows), bands, rows)
                offsets = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0))))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(T.signed(keys[n > 0].ravel())))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, m), pa.array(n, pa.int64()), pa.array(T.signed(fp[0])), pa.array(T.signed(fp[1])), lists],
                    ["id", "n", "fp1", "fp2", "bands"])
                at += m

    return arrow_map(docs, run, f"id {id_type}, n long, fp1 long, fp2 long, bands array<long>")


def confirm(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those ``pairs`` (a, hub) whose full shingle sets have 100 * |A and B| >= percent * |A or B|.

    A hub's text goes once to each of its parts of at most about ``HUB_MEMBERS``
    members, and the members meet it there in a sorted stream.
    """
    id_type = docs.schema["id"].dataType.simpleString()
    pairs = stored(pairs.select("a", "hub"), "pairs")
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_MEMBERS).cast("int").alias("parts"))
    members = pairs.join(parts, "hub").select(
        F.col("a").alias("id"), "hub", F.expr("cast(pmod(xxhash64(a), parts) as int)").alias("part"), F.lit(1).alias("role"))
    hubs = parts.select(F.col("hub").alias("id"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    rows = asked(docs, members.union(hubs)).select("hub", "part", "role", "id", "text")
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]):
        now, sets = None, []
        for b in batches:
            hub, part, role = (b.column(i).to_pylist() for i in range(3))
            found = []
            for lo, hi, data, offs in T.chunks(b.column(4)):
                row, key = distinct(*shingles(T.scan(data, offs, T.SPACED, lower=True)))
                by = np.argsort(row, kind="stable")
                each = np.split(key[by], np.cumsum(np.bincount(row, minlength=hi - lo))[:-1])
                for i, keys in zip(range(lo, hi), each):
                    if (hub[i], part[i]) != now:
                        now, sets = (hub[i], part[i]), []
                    if role[i] == 0:
                        sets.append(np.sort(keys))
                        continue
                    for s in sets:
                        if not len(s) or not len(keys):
                            continue
                        at = np.searchsorted(s, keys)
                        at[at == len(s)] = 0
                        both = int((s[at] == keys).sum())
                        if 100 * both >= percent * (len(s) + len(keys) - both):
                            found.append(i)
                            break
            if found:
                yield pa.RecordBatch.from_arrays([b.column(3).take(pa.array(found)), b.column(0).take(pa.array(found))], ["a", "hub"])

    return arrow_map(rows, run, f"a {id_type}, hub {id_type}").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, comp`` of the ids on links (a, hub): the smallest id that each one reaches.

    Each round takes the smallest label among neighbours and then follows labels
    one step, so chains halve; the labels are written out every round.
    """
    edges = stored(links.select("a", "hub").union(links.select("hub", "a")).distinct().toDF("id", "to"), "edges")
    labels = stored(edges.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("comp")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("id").alias("to"), "comp"), "to").groupBy("id").agg(F.min("comp").alias("near"))
                .join(labels, "id").select("id", "comp", F.least("comp", "near").alias("next")))
        jump = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        new = stored(near.join(jump, "next").select("id", F.least("next", "far").alias("comp"), (F.least("next", "far") < F.col("comp")).alias("moved")), "labels")
        labels = new.select("id", "comp")
        if new.where("moved").isEmpty():
            return labels


def rare_pairs(docs: DataFrame, among: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, hub) of documents of ``among`` (id, comp) in different components that may be similar
    enough, by the shingles that are rarest among them (prefix and position filters; no pair is lost)."""
    id_type = docs.schema["id"].dataType.simpleString()
    rows = asked(docs, among).select("id", "text")

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in T.chunks(b.column(1)):
                row, key = distinct(*shingles(T.scan(data, offs, T.SPACED, lower=True)))
                n = np.bincount(row, minlength=hi - lo)
                fp = np.zeros(hi - lo, np.uint64)
                np.add.at(fp, row, T.mix(key))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(row + lo)), pa.array(T.signed(fp[row])), pa.array(n[row], pa.int32()), pa.array(T.signed(key))],
                    ["id", "fp", "n", "key"])

    keys = arrow_map(rows, run, f"id {id_type}, fp long, n int, key long").distinct()
    several = keys.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("id", "fp")
    # a shingle nobody shares needs no row: it only moves the others back
    placed = (keys.join(several, "key").withColumn("at", F.row_number().over(own.orderBy("df", "key"))).withColumn("m", F.count("*").over(own))
              .select("id", "n", "key", (F.col("n") - F.col("m") + F.col("at") - 1).alias("at"))
              .where(f"at <= n - ceil({percent} * n / 100)").join(among, "id"))
    placed = stored(placed, "prefixes")
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("m")).groupBy("key").agg(F.max(F.struct("m", "comp")).alias("big"), F.count("*").alias("c"))
    open_ = stored(placed.join(sizes.where("c > 1"), "key").select("key", "id", "n", "at", "comp", (F.col("comp") != F.col("big.comp")).alias("asks")), "open-prefixes")
    # whether two places of a shingle can link depends on (n, at) alone: rows meet only where their kinds can, so
    # a shingle that a whole template shares at hopeless places brings no row of it to another
    kinds = open_.select("key", "n", "at").distinct()
    other = kinds.toDF("key", "n_2", "at_2")
    fits = kinds.join(other, "key").where(f"{100 + percent} * least(n - at, n_2 - at_2) >= {percent} * (n + n_2)").where(_alike("n", "n_2", percent))
    ask = open_.where("asks").select("key", *[F.col(c).alias(f"{c}_2") for c in ("id", "n", "at", "comp")])
    met = ask.join(fits, ["key", "n_2", "at_2"]).select("key", "n", "at", "id_2", "comp_2")
    pairs = open_.join(met, ["key", "n", "at"]).where("comp <> comp_2 and id <> id_2")
    return pairs.select(F.greatest("id", "id_2").alias("a"), F.least("id", "id_2").alias("hub")).distinct()


def _alike(a: str, b: str, percent: int) -> F.Column:
    """Sizes that leave the similarity possible."""
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row.

    A document is an id: rows that share one share its component, linked by any of
    their texts.  No words, or null text: an empty set, linked with nothing.  A row
    without an id is its own component (null) and kept.  Empty table: no rows.
    """
    docs = only(df, id=id_col, text=text_col)
    sig = stored(signatures(docs, bands, rows), "signatures")
    sets = sig.where("id is not null and n > 0")
    classes = stored(sets.groupBy("fp1", "fp2", "n").agg(F.min(F.struct("id", "bands")).alias("m"))
                     .select("fp1", "fp2", "n", F.col("m.id").alias("id"), F.col("m.bands").alias("bands")), "classes")
    band = classes.select(F.explode("bands").alias("key"), "id", "n")
    # (aggregates are stored before they are joined back, so that the joins can split a hot bucket's partition)
    sizes = stored(band.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    shared = stored(band.join(sizes, "key"), "buckets")
    # star edges: every member of a bucket to its leader
    meets = shared.groupBy("id").agg(F.sum("m").alias("meets"))
    leaders = stored(shared.join(meets, "id").groupBy("key").agg(F.max(F.struct("meets", "n", "id")).alias("head")), "leaders")
    stars = (shared.join(leaders, "key").where("id <> head.id").where(_alike("n", "head.n", percent))
             .groupBy("id", F.col("head.id").alias("hub")).agg(F.count("*").alias("times"), F.max("head.meets").alias("meets")))
    best = stars.groupBy("id").agg(F.max(F.struct("times", "meets", "hub")).alias("best")).select(F.col("id").alias("a"), F.col("best.hub").alias("hub"))
    links = stored(confirm(docs, best, percent), "links")
    comps = components(links)
    # buckets that still hold several components
    member = stored(shared.select("key", "id").join(comps, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp")), "members")
    still = member.groupBy("key").agg((F.min("comp") < F.max("comp")).alias("open")).where("open")
    among = stored(member.join(still, "key").select("id", "comp").distinct(), "open")
    more = stored(confirm(docs, rare_pairs(docs, among, percent), percent), "links")
    if not more.isEmpty():
        comps = components(links.union(more))
    # all rows: set -> class -> component; ids with several sets belong to all of them
    of_class = classes.select("fp1", "fp2", "n", F.col("id").alias("rep"))
    node = sets.select("id", "fp1", "fp2", "n").join(of_class, ["fp1", "fp2", "n"]).join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    node = node.select("id", F.coalesce("comp", "rep").alias("comp"))
    node = stored(node.groupBy("id").agg(F.min("comp").alias("comp"), F.max("comp").alias("other")), "nodes")
    several = node.where("comp <> other")
    if not several.isEmpty():  # an id whose texts lie in different components joins these
        more = components(several.select(F.col("other").alias("a"), F.col("comp").alias("hub")))
        node = node.join(more.toDF("comp", "root"), "comp", "left").select("id", F.coalesce("root", "comp").alias("comp"))
    out = sig.select("id", "n").join(node.select("id", "comp"), "id", "left")
    comp = F.coalesce("comp", "id")
    return out.select("id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each group of near duplicates the document with the smallest id,
    and of rows that share that id the one with the smallest text.  Rows without an id all stay."""
    found = stored(near_duplicates(df, id_col, text_col).select("id", "kept"), "kept")
    gone = found.where("not kept").select("id").distinct()
    several = found.where("kept and id is not null").groupBy("id").agg(F.count("*").alias("m")).where("m > 1").select("id")
    rest = without_ids(df, id_col, gone)
    if several.isEmpty():
        return rest
    again, single = split_by_ids(rest, id_col, several)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    one = again.where(f"`{id_col}` is not null").groupBy(F.col(f"`{id_col}`").alias("id of the group")).agg(
        F.min_by(row, F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("row that stays"))
    one = one.select([F.col(f"`row that stays`.`{c}`").alias(c) for c in df.columns])
    return single.unionByName(one).unionByName(again.where(f"`{id_col}` is null"))


def op9_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: DuckDB SQL: all shared shingles, all links, all that each document reaches.
ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT r, doc_id, array_to_string(w[i:i + {SHINGLE} - 1], ' ') AS g
      FROM d, unnest(range(1, greatest(len(w) - {SHINGLE}, 0) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
link AS (
  SELECT DISTINCT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, x.r AS ra, y.r AS rb, count(*) AS m
    FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) AS c
  JOIN n AS p ON p.r = c.ra JOIN n AS q ON q.r = c.rb WHERE 100 * m >= {PERCENT} * (p.n + q.n - m)),
reach AS (SELECT DISTINCT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n ON n.r = d.r JOIN c ON c.a = d.doc_id
"""
