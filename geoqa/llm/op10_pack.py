"""Operator 10 - vector best-fit packing of token sequences.

Bins have three capacities: tokens, documents and attention cost (the sum of
squared piece lengths).  Pieces of one length need the same of each, so packing
is planned on the histogram of lengths - at most ``tokens`` rows, whatever the
corpus - and groups of bins with equal residuals move together.  Longest first,
each group of pieces goes to the feasible bins with the smallest weighted norm
of the residual left over, or the largest weighted dot product of demand and
residual.  The plan lists, for each length, which ranks go to which sequences
and at which place; ranks are prefix sums of counts per partition, so no key,
not even a length that a third of all pieces share, meets in one task.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, only, stored, table, worker_cache
from geoqa.llm.token_ids import TokenIds, ids_of_rows

END_ID = 0

@dataclass(frozen=True)
class Capacity:
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048  # of one full-length piece: binds only if set lower


@dataclass(frozen=True)
class Rule:
    """How a bin is chosen: ``norm`` of the residual or ``dot`` product, with weights."""

    kind: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)


def pieces_of(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              tokens: int = 2048, with_ids: bool = False) -> DataFrame:
    """Each document's ids, then the end id, cut into pieces of at most ``tokens``.

    ``id, piece, start, length, ids_crc32``, ``part`` (Spark partition), ``rank``
    (among its part's pieces of that length), and with ``with_ids`` the ids themselves (``ids array<int>``).  Only documents
    longer than ``tokens`` are cut; the first piece takes the remainder.  Null
    text is empty: one piece that is the end id.
    """
    docs = only(df, id=id_col, text=text_col)
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        arenas, part = worker_cache("op10"), TaskContext.get().partitionId()
        if tokenizer_path not in arenas:
            arenas[tokenizer_path] = TokenIds(tokenizer_path)
        known = arenas[tokenizer_path]
        seen = np.zeros(tokens + 1, np.int64)
        for b in batches:
            row0 = 0
            for ids, n in ids_of_rows(known, b.column(1), END_ID):
                count = (n - 1) // tokens + 1
                row = np.repeat(np.arange(len(n)), count)
                piece = T.spans(count)
                head = n - (count - 1) * tokens
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * tokens)
                length = np.where(piece == 0, head[row], tokens)
                at = (np.cumsum(n) - n)[row] + start
                by = np.argsort(length, kind="stable")
                many = np.bincount(length, minlength=tokens + 1)
                rank = np.empty(len(length), np.int64)
                rank[by] = T.spans(many) + np.repeat(seen, many)
                seen += many
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + m)]) for a, m in zip(at.tolist(), length.tolist())]
                cols = [b.column(0).take(pa.array(row + row0)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part), pa.int64()),
                        pa.array(rank)]
                names = ["id", "piece", "start", "length", "ids_crc32", "part", "rank"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(np.concatenate((at, [len(ids)])).astype(np.int32), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
                row0 += len(n)

    return arrow_map(docs, run, f"id {id_type}, piece int, start long, length long, ids_crc32 long, part long, rank long"
                     + (", ids array<int>" if with_ids else ""), owner="op10")


def plan_bins(histogram: dict[int, int], cap: Capacity = Capacity(), rule: Rule = Rule()) -> np.ndarray:
    """Rows ``length, first rank, ranks, first sequence, offset``: rank r of a length goes to
    sequence ``first sequence + r - first rank`` at ``offset``.

    Works on the histogram, not on pieces: every step ends a length or moves a
    whole group of equal bins, so its cost depends on the capacities alone.
    """
    total = np.array([cap.tokens, cap.documents, cap.attention], float)
    weight = np.array(rule.weights, float)
    left = np.zeros((0, 3))          # residuals of each group of equal bins
    lo = np.zeros(0, np.int64)       # their sequences are lo <= s < hi
    hi = np.zeros(0, np.int64)
    out, n_seq = [], 0
    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], float)
        if (need > total).any():
            raise ValueError(f"a piece of {length} tokens fits no bin of {cap}")
        rank, todo = 0, histogram[length]
        while todo:
            fits = np.flatnonzero((left >= need).all(axis=1))
            if len(fits):
                rest = (left[fits] - need) / total
                score = (weight * rest * rest).sum(axis=1) if rule.kind == "norm" else -(weight * need * left[fits] / total / total).sum(axis=1)
                g = fits[int(np.argmin(score))]
                n = int(min(todo, hi[g] - lo[g]))
                out.append((length, rank, n, int(lo[g]), int(total[0] - left[g, 0])))
                if n < hi[g] - lo[g]:  # the group splits
                    left, lo, hi = np.vstack((left, left[g])), np.append(lo, lo[g] + n), np.append(hi, hi[g])
                    hi[g] = lo[g] + n
                left[g] -= need
            else:
                each = int(min(total // need))  # what a new bin takes of this length
                n = max(1, todo // each)
                each = min(each, todo)
                for j in range(each):
                    out.append((length, rank + j * n, n, n_seq, j * length))
                left, lo, hi = np.vstack((left, total - each * need)), np.append(lo, n_seq), np.append(hi, n_seq + n)
                n_seq += n
                n *= each
            rank, todo = rank + n, todo - n
            full = left[:, 0] < 1
            if full.any():
                left, lo, hi = left[~full], lo[~full], hi[~full]
    return np.array(out, np.int64).reshape(-1, 5)


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         cap: Capacity = Capacity(), rule: Rule = Rule(), with_ids: bool = False) -> DataFrame:
    """``pieces_of`` each document plus ``sequence_id`` and ``offset``.

    Every piece of every row is in exactly one sequence, gapless from 0, within
    all capacities.  An empty table gives no pieces.  Repeated and null ids are
    packed row by row.
    """
    spark = df.sparkSession
    pieces = stored(pieces_of(df, tokenizer_path, id_col, text_col, cap.tokens, with_ids), "pieces")
    counts = pieces.groupBy("length", "part").count()
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # <= cap.tokens rows
    plan = plan_bins(histogram, cap, rule)
    key = (plan[:, 0] << 44) + plan[:, 1]
    order = np.argsort(key)
    shared = spark.sparkContext.broadcast((key[order], plan[order]))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    names = [c for c in pieces.columns if c not in ("part", "rank")]
    ranked = pieces.join(base, ["length", "part"]).select(*names, (F.col("base") + F.col("rank")).alias("rank"))

    def place(batches):
        run_key, run = shared.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = run[np.searchsorted(run_key, (length << 44) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in names)
    return arrow_map(ranked, place, schema + ", sequence_id long, offset long")


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumnRenamed("id", "doc_id")
