"""Operator 12 - alignment of two tokenizers by external spill counting.

Both tokenizers cut the same bytes (a space and the text).  Places where tokens of both
end cut a text into groups; an A token and a B token whose bytes overlap are linked.  How
often a pair of ids is linked in all documents takes a count over (pair, document) records:

1. Spilling.  A task aligns its texts and collects records (A id, B id, document, links).
   When ``SPILL`` of them are there they are sorted by B id, A id and document, split by
   B id modulo ``RADICES`` and spilled as zstd-packed runs.
2. Counting.  Each task merges the runs it reads radix by radix through a heap of their
   next chunks and adds up each pair; Spark adds the sums of the tasks.  A pair that
   stands in a third of all documents is one number a task by then.
3. Side-major order.  The counts of a radix, sorted by B id, are streamed: all pairs of a
   B id follow one another, so their maximum is known when the next one begins.
4. Streaming back.  The runs are merged once more, dealt by radix and, where a radix has
   much (a frequent B id), in slices of ``SLICE`` bytes, beside the counts of their radix:
   every record turns into what it adds to its document, summed per document and task.

Links are elementary byte ranges between neighbouring ends of either side, so there are
never more of them than tokens.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, gather, only, stored, table, worker_cache
from geoqa.llm.token_ids import PieceIds, TokenIds

#: Records that a task holds before it spills, parts of a spill, records of a chunk, packed bytes of a slice.
SPILL, RADICES, CHUNK, SLICE = 1 << 20, 16, 1 << 14, 24 << 20
#: Records that a merge sorts at a time, and packed bytes of runs that one merge takes.
MERGE, MERGE_BYTES = 1 << 19, 32 << 20
#: Bits of an id in a pair.
_A_BITS = 20


# ---------------------------------------------------------------- runs


def pack(columns: list[np.ndarray]) -> bytes:
    """Whole numbers of sorted records: the first column as steps, all by byte planes, zstd."""
    step = np.diff(columns[0], prepend=columns[0][:1])
    planes = b""
    for c in [step, *columns[1:]]:
        width = next(k for k in (1, 2, 4, 8) if not len(c) or int(c.max()) < 1 << 8 * k or k == 8)
        raw = c.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
        planes += bytes([width]) + raw.T.tobytes()
    first = int(columns[0][0]) if len(columns[0]) else 0
    return first.to_bytes(8, "little") + len(step).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(planes)


def first_of(raw) -> int:
    return int.from_bytes(raw[:8], "little")


def unpack(raw) -> list[np.ndarray]:
    n = int.from_bytes(raw[8:12], "little")
    planes = zstandard.ZstdDecompressor().decompress(bytes(raw[12:]))
    out, at = [], 0
    while at < len(planes):
        width = planes[at]
        block = np.frombuffer(planes, np.uint8, n * width, at + 1).reshape(width, n)
        out.append(np.ascontiguousarray(block.T).view(f"<u{width}").reshape(n).astype(np.int64))
        at += 1 + n * width
    out[0] = np.cumsum(out[0]) + first_of(raw) if n else out[0]
    return out


def merged(runs: list[list[tuple[bytes, int]]], target: int = MERGE) -> Iterator[list[np.ndarray]]:
    """Records of sorted runs in order of the first column, a block at a time; a run is a list of
    (packed chunk, number that its second column counts from).

    The heap holds the first key of each run's next chunk; what is not above the smallest of them is
    complete but for records with that very key, so a later block may go on with a block's last key.
    """
    heap = [(first_of(chunks[0][0]), r, 0) for r, chunks in enumerate(runs) if chunks]
    heapq.heapify(heap)
    held: list[list[np.ndarray]] = []
    n = 0
    while heap or held:
        want = max(target, n + 1) if heap else n  # one more chunk at least
        while heap and n < want:
            _, r, i = heapq.heappop(heap)
            raw, base = runs[r][i]
            columns = unpack(raw)
            columns[1] = columns[1] + base
            held.append(columns)
            n += len(columns[0])
            if i + 1 < len(runs[r]):
                heapq.heappush(heap, (first_of(runs[r][i + 1][0]), r, i + 1))
        columns = [np.concatenate(c) for c in zip(*held)]
        by = np.argsort(columns[0], kind="stable")
        columns = [c[by] for c in columns]
        cut = int(np.searchsorted(columns[0], heap[0][0], "right")) if heap else n
        if cut:
            yield [c[:cut] for c in columns]
        held, n = ([[c[cut:] for c in columns]], n - cut) if cut < n else ([], 0)


def sums_by_key(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys and the sum of each value column."""
    if not len(key):
        return [key, *values]
    by = np.argsort(key, kind="stable")
    key = key[by]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return [key[first], *(np.add.reduceat(v[by], first) for v in values)]


# ---------------------------------------------------------------- alignment of texts


def spaced_rows(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a space in front of each that is not empty."""
    full = np.diff(offs) > 0
    return np.insert(data, offs[:-1][full], 0x20), offs + np.concatenate(([0], np.cumsum(full)))


class Aligned:
    """Tokens of both sides of the rows of a buffer, their groups and links."""

    def __init__(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], a_bytes: np.ndarray, b_bytes: np.ndarray, offs: np.ndarray):
        rows, size = len(offs) - 1, np.diff(offs)
        sides = []
        whole = size > 0
        for (ids, n), n_bytes in ((a, a_bytes), (b, b_bytes)):
            row = np.repeat(np.arange(rows), n)
            whole &= np.bincount(row, n_bytes[ids], rows).astype(np.int64) == size
            sides.append((ids.astype(np.int64), row, n_bytes))
        self.offs, self.rows, ends = offs, rows, []
        for ids, row, n_bytes in sides:
            stay = whole[row]
            ids, row = ids[stay], row[stay]
            n = np.bincount(row, minlength=rows)
            each = n_bytes[ids]
            done = np.cumsum(each)
            before = np.concatenate(([0], done))[(np.cumsum(n) - n)]  # bytes of all rows before
            ends.append((ids, n, offs[row] + done - before[row]))
        (self.a, self.n_a, a_end), (self.b, self.n_b, b_end) = ends
        size = int(offs[-1]) + 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[a_end] = at_b[b_end] = True
        stop = np.flatnonzero(at_a | at_b)
        at_a, at_b = at_a[stop], at_b[stop]
        self.link_a, self.link_b = np.cumsum(at_a) - at_a, np.cumsum(at_b) - at_b  # tokens of the range that ends here
        self.row = np.searchsorted(offs, stop, "left") - 1
        both = at_a & at_b
        self.n_links = np.bincount(self.row, minlength=rows)
        self.n_groups = np.bincount(self.row[both], minlength=rows)
        group = np.cumsum(both) - both
        self.group_a, self.group_b = group[at_a], group[at_b]  # of each token, by its end
        self.last_a, self.last_b = both[at_a], both[at_b]

    def group_texts(self) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each row."""
        groups = int(self.group_a[-1]) + 1 if len(self.a) else 0
        many_a, many_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        place_a = np.arange(len(self.a)) + (np.cumsum(many_b) - many_b)[self.group_a]
        place_b = np.arange(len(self.b)) + np.cumsum(many_a)[self.group_b]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        sign = np.empty(len(ids), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        sign[place_a] = np.where(self.last_a, ord("|"), ord(","))
        sign[place_b] = np.where(self.last_b, ord(";"), ord(","))
        n = self.n_a + self.n_b
        end = np.cumsum(n)
        sign[end[n > 0] - 1] = 0  # nothing after the last one
        width = len(str(int(ids.max()))) if len(ids) else 1
        digits = np.zeros((len(ids), width + 1), np.uint8)
        rest = ids.copy()
        for k in range(width - 1, -1, -1):
            digits[:, k] = np.where((rest > 0) | (k == width - 1), 48 + rest % 10, 0)
            rest //= 10
        digits[:, width] = sign
        size = (digits > 0).sum(1)
        text = digits.ravel()
        text = memoryview(text[text > 0].tobytes())
        stop = np.concatenate(([0], np.cumsum(size)))[end]
        for lo, hi in zip(np.concatenate(([0], stop[:-1])).tolist(), stop.tolist()):
            yield text[lo:hi]

    def records(self) -> list[np.ndarray]:
        """(pair, row, links) of every pair of ids linked in a row."""
        key = np.sort((self.row << 2 * _A_BITS) + (self.b[self.link_b] << _A_BITS) + self.a[self.link_a])
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key, m = key[first], np.diff(np.append(first, len(key)))
        return [key & (1 << 2 * _A_BITS) - 1, key >> 2 * _A_BITS, m]


_SPILLED = "kind int, row long, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, radix int, run binary"


def spill(docs: DataFrame, a_path: str, b_path: str, records: int = SPILL, radices: int = RADICES) -> DataFrame:
    """Rows of (id, text) aligned: ``kind`` 0 is a document with its own figures, ``kind`` 1 a chunk of a
    sorted run of records, whose documents count from ``row``; chunks of a run follow one another."""
    kind = docs.schema["id"].dataType.simpleString()
    names = [c.split()[0] for c in _SPILLED.split(", ")]

    def tools():
        mine = worker_cache("op12")
        if (a_path, b_path) not in mine:
            mine[a_path, b_path] = TokenIds(a_path, plain_specials=True), PieceIds(b_path)
        return mine[a_path, b_path]

    def runs_of(held, base, id_type):
        pair, row, m = (np.concatenate(c) for c in zip(*held))
        radix = (pair >> _A_BITS) % radices
        by = np.argsort((radix << 44) + pair, kind="stable")  # rows ascend already
        pair, row, m, radix = pair[by], row[by], m[by], radix[by]
        edge = np.searchsorted(radix, np.arange(radices + 1))
        out = [(r, pack([c[lo:min(lo + CHUNK, z)] for c in (pair, row, m)]))
               for r, (a, z) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) for lo in range(a, z, CHUNK)]
        n = len(out)
        empty = [pa.nulls(n, t) for t in (id_type, *[pa.int64()] * 4, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.array(np.full(n, base)), *empty,
                                           pa.array([r for r, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names)

    def run(batches):
        a_side, b_side = tools()
        row = base = TaskContext.get().partitionId() << 33
        held, n_held, id_type = [], 0, pa.int64()
        for b in batches:
            at, id_type = 0, b.column(0).type
            for _, _, data, offs in T.chunks(b.column(1)):
                data, offs = spaced_rows(data, offs)
                x = Aligned(a_side.rows(data, offs), b_side.rows(data, offs), a_side.n_bytes, b_side.n_bytes, offs)
                sha = [hashlib.sha256(t).hexdigest() if len(t) else "" for t in x.group_texts()]
                n = x.rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(np.arange(row, row + n)), b.column(0).slice(at, n),
                     *(pa.array(v.astype(np.int64)) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(sha, pa.string()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
                pair, doc, m = x.records()
                held.append((pair, doc + (row - base), m))
                n_held += len(pair)
                at, row = at + n, row + n
                if n_held >= records:
                    yield runs_of(held, base, id_type)
                    held, n_held = [], 0
                    base = row
        if n_held:
            yield runs_of(held, base, id_type)

    return arrow_map(docs, run, _SPILLED.format(id=kind), owner="op12")


# ---------------------------------------------------------------- counting


def _runs(chunks: list[tuple[bytes, int]]) -> list[list[tuple[bytes, int]]]:
    """Runs out of chunks as they were read: a chunk that begins below the one before begins a run."""
    out: list[list[tuple[bytes, int]]] = []
    last = None
    for c in chunks:
        if last is None or first_of(c[0]) < last:
            out.append([])
        out[-1].append(c)
        last = first_of(c[0])
    return out


def pair_counts(spilled: DataFrame) -> DataFrame:
    """``pair, n``: links of every pair of ids in all documents."""

    def counted(by_radix):
        for chunks in by_radix.values():
            for pair, _, m in merged(_runs(chunks)):
                key, n = sums_by_key(pair, m)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["pair", "n"])

    def run(batches):
        held, size = {}, 0
        for b in batches:
            for r, raw in zip(b.column("radix").to_pylist(), b.column("run").to_pylist()):
                held.setdefault(r, []).append((raw, 0))
                size += len(raw)
            if size > MERGE_BYTES:
                yield from counted(held)
                held, size = {}, 0
        yield from counted(held)

    runs = spilled.where("kind = 1").select("radix", "run")
    return arrow_map(runs, run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def count_chunks(counts: DataFrame, radices: int) -> DataFrame:
    """``radix, run``: the counts of each radix in order of (B id, A id), packed as (pair, count, 1 if no
    pair of the B id has a higher count)."""
    b_id = F.shiftright("pair", _A_BITS)
    rows = counts.select(F.pmod(b_id, F.lit(radices)).cast("int").alias("radix"), b_id.alias("b"), "pair", "n")
    rows = rows.repartition("radix").sortWithinPartitions("radix", "pair")

    def run(batches):
        for g in gather(batches, ["b"]):  # at most as many pairs as A has ids, for each B id
            radix, b, pair, n = (g.column(c).to_numpy() for c in ("radix", "b", "pair", "n"))
            first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(b))))
            best = (n == most).astype(np.int64)
            edge = np.flatnonzero(np.append(True, radix[1:] != radix[:-1])).tolist()
            out = [(int(radix[a]), pack([c[lo:min(lo + CHUNK, z)] for c in (pair, n, best)]))
                   for a, z in zip(edge, [*edge[1:], len(b)]) for lo in range(a, z, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["radix", "run"])

    return arrow_map(rows, run, "radix int, run binary")


class _Counts:
    """Counts of a radix as a stream beside the merged records."""

    def __init__(self, chunks: list[bytes]):
        self.left = sorted(chunks, key=first_of, reverse=True)
        self.held = [np.zeros(0, np.int64)] * 3

    def of(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, best) of sorted pairs; they ascend from call to call."""
        parts = [[c[np.searchsorted(self.held[0], pair[0]):] for c in self.held]]
        while self.left and first_of(self.left[-1]) <= pair[-1]:
            parts.append(unpack(self.left.pop()))
        self.held = [np.concatenate(c) for c in zip(*parts)]
        at = np.searchsorted(self.held[0], pair)
        if (at >= len(self.held[0])).any() or (self.held[0][at] != pair).any():
            raise ValueError("a pair without a count")
        return self.held[1][at], self.held[2][at]


def contributions(spilled: DataFrame, chunks: DataFrame, slice_bytes: int = SLICE) -> DataFrame:
    """``row, n_best, count_sum``: what the records of a radix (or a slice of one) add to each document."""
    runs = spilled.where("kind = 1").select("radix", "row", "run")
    sizes = {r.radix: r.size for r in runs.groupBy("radix").agg(F.sum(F.length("run")).alias("size")).collect()}  # <= RADICES rows
    slices = {r: max(1, -(-s // slice_bytes)) for r, s in sizes.items()}
    spark = spilled.sparkSession
    cut = F.broadcast(spark.createDataFrame(list(slices.items()), "radix int, slices int"))
    # chunks of one spill stay together; slices of a radix have different spills
    mine = runs.join(cut, "radix").select("radix", F.expr("cast(pmod(xxhash64(row), slices) as int)").alias("slice"), F.lit(1).alias("kind"), "row", "run")
    theirs = chunks.join(cut, "radix").select("radix", F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("row"), "run")
    dealt = theirs.union(mine).repartition(max(1, sum(slices.values())), "radix", "slice").sortWithinPartitions("radix", "slice", "kind", "row")

    def added(counts, held):
        total, size, stream = [], 0, _Counts(counts)
        for pair, doc, m in merged(_runs(held)):
            n, best = stream.of(pair)
            total.append(sums_by_key(doc, m * best, m * n))
            size += len(total[-1][0])
            if size > 4 * MERGE:
                total = [sums_by_key(*(np.concatenate(c) for c in zip(*total)))]
                size = len(total[0][0])
        if total:
            row, n_best, count_sum = sums_by_key(*(np.concatenate(c) for c in zip(*total)))
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(n_best), pa.array(count_sum)], ["row", "n_best", "count_sum"])

    def run(batches):
        now, counts, held = None, [], []
        for b in batches:
            for r, s, kind, base, raw in zip(*(b.column(c).to_pylist() for c in ("radix", "slice", "kind", "row", "run"))):
                if (r, s) != now:
                    yield from added(counts, held)
                    now, counts, held = (r, s), [], []
                if kind == 0:
                    counts.append(raw)
                else:
                    held.append((raw, base))
        yield from added(counts, held)

    return arrow_map(dealt, run, "row long, n_best long, count_sum long")


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", records: int = SPILL,
          radices: int = RADICES, slice_bytes: int = SLICE) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens:
    zeros and ''.  Rows keep their number, also with repeated or null ids; an empty table gives no rows.
    """
    spilled = stored(spill(only(df, id=id_col, text=text_col), a_path, b_path, records, radices), "spilled")
    chunks = stored(count_chunks(pair_counts(spilled), radices), "pair-counts")
    added = contributions(spilled, chunks, slice_bytes).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    docs = spilled.where("kind = 0").select("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return docs.join(added, "row", "left").select("id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                                                  F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return align(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")
