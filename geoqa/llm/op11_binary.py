"""Operator 11 - token ids as binary files: static rANS in independent blocks.

1. The ids of every text, with an end id, are made once and stored; their counts over
   all documents make one frequency table, which all files share (``table.bin``).
2. Documents are dealt by ranges of their id, and each range becomes a shard file: blocks
   of ``BLOCK`` ids, each coded by ``rans`` on its own.  A block says which documents it
   holds (a document that is cut says where), has checkpoints from which a decoder can
   start, a checksum of its index and one of the ids after each checkpoint.
3. The index (a Parquet table: file, place and size of every block, ids of all shards
   before) is written when all shards are; files of lost task attempts are removed then.
4. Reading deals (block, checkpoint) pairs over the cluster; each is decoded alone from a
   range of its file and checked.  A document's checksum is put together from those of
   its parts: CRC-32 is linear, so each part's value is moved on by the zeros after it and
   the parts are added by exclusive or, in any order and anywhere.

Shard file: ``MAGIC``, blocks, their places, ``TAIL``.  All numbers are little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow.fs import FileSelector
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.llm import rans
from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, only, stored, table, worker_cache
from geoqa.llm.files import opened, shared_folder
from geoqa.llm.token_ids import TokenIds, ids_of_rows

END_ID = 0
#: Ids of a block, and steps of all its lanes between two checkpoints.
BLOCK, EVERY = 1 << 21, 256
#: (block, checkpoint) pairs that one task decodes.
UNITS = 8
MAGIC, TAIL, TABLE_MAGIC = b"TOKRANS1", b"TOKREND1", b"TOKRTAB1"
#: n ids, lanes, steps between checkpoints, checkpoints, words, documents, ids of the shard before, ids of the
#: first document before, checksum of the table, checksum of the index; then a checksum of these.
_HEAD = struct.Struct("<IIIIIIQQII")


# ---------------------------------------------------------------- one block


def pack_block(ids: np.ndarray, docs: list[tuple[int | None, int]], first: int, offset: int, tab: rans.Table, tab_crc: int,
               every: int = EVERY) -> tuple[bytes, int, int]:
    """(bytes, of these head and index, checkpoints) of a block: ``docs`` are the (id, ids in all) of its documents."""
    c = rans.encode(ids, tab, rans.lanes_for(len(ids)), every)
    span = c.lanes * every
    plain = ids.astype("<u4")
    crc = [zlib.crc32(plain[a:a + span].tobytes()) for a in range(0, len(ids), span)]
    index = b"".join((np.array([i or 0 for i, _ in docs], "<i8").tobytes(), np.array([n for _, n in docs], "<u8").tobytes(),
                      np.array([i is None for i, _ in docs], "<u1").tobytes(), np.append(c.at, len(c.words)).astype("<u4").tobytes(),
                      np.array(crc, "<u4").tobytes()))
    head = _HEAD.pack(len(ids), c.lanes, every, len(c.at), len(c.words), len(docs), first, offset, tab_crc, zlib.crc32(index))
    head += struct.pack("<I", zlib.crc32(head))
    return head + index + c.states.astype("<u8").tobytes() + c.words.astype("<u4").tobytes(), len(head) + len(index), len(c.at)


class Block:
    """Head and index of a block in a file; its parts are decoded one by one."""

    def __init__(self, file, at: int, index_size: int):
        file.seek(at)
        raw = file.read(index_size)
        size = _HEAD.size
        if len(raw) < index_size or zlib.crc32(raw[:size]) != struct.unpack_from("<I", raw, size)[0]:
            raise ValueError("damaged block: its head does not match its checksum")
        (self.n, self.lanes, self.every, self.points, self.n_words, m, self.first, self.offset, self.table_crc, crc) = _HEAD.unpack_from(raw)
        index = raw[size + 4:]
        if zlib.crc32(index) != crc:
            raise ValueError("damaged block: its index does not match its checksum")
        self.id = np.frombuffer(index, "<i8", m)
        self.size = np.frombuffer(index, "<u8", m, 8 * m).astype(np.int64)
        self.null = np.frombuffer(index, "<u1", m, 16 * m).astype(bool)
        self.words_at = np.frombuffer(index, "<u4", self.points + 1, 17 * m)
        self.crc = np.frombuffer(index, "<u4", self.points, 17 * m + 4 * (self.points + 1))
        self.file, self.states_at = file, at + index_size

    def ids(self, part: int, tab: rans.Table, symbols: np.ndarray) -> np.ndarray:
        """The ids after checkpoint ``part``, checked."""
        lo, hi = int(self.words_at[part]), int(self.words_at[part + 1])
        self.file.seek(self.states_at + 8 * self.lanes * part)
        states = np.frombuffer(self.file.read(8 * self.lanes), "<u8")
        self.file.seek(self.states_at + 8 * self.lanes * self.points + 4 * lo)
        words = np.frombuffer(self.file.read(4 * (hi - lo)), "<u4")
        before = part * self.every * self.lanes
        here = rans.Coded(min(self.n - before, self.every * self.lanes), self.lanes, self.every, states.reshape(1, -1), np.zeros(1, np.uint32), words)
        try:
            out = rans.decode(here, tab, symbols, 0)
        except ValueError as e:
            raise ValueError(f"damaged block: {e}") from e
        if zlib.crc32(out.astype("<u4").tobytes()) != int(self.crc[part]):
            raise ValueError("damaged block: decoded ids do not match their checksum")
        return out


# ---------------------------------------------------------------- checksums of parts

_POLY = 0xEDB88320  # CRC-32, lowest power in the highest bit


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), modulo that of CRC-32."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


def moved_crc(crc: int, n_bytes: int) -> int:
    """What ``crc`` of a text adds to the CRC-32 of that text and ``n_bytes`` more after it."""
    power, factor = 1 << 31, 1 << 23  # x^0, x^8
    while n_bytes:
        if n_bytes & 1:
            power = _times(power, factor)
        factor = _times(factor, factor)
        n_bytes >>= 1
    return _times(power, crc)


# ---------------------------------------------------------------- writing


def token_rows(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """``id, row, n, ids`` of every row: ids with the end id, as zstd of 16 or 32 bits each; ``row`` is unique."""
    docs = only(df, id=id_col, text=text_col)
    docs = docs.select(F.col("id").cast("long").alias("id"), "text")

    def run(batches):
        mine = worker_cache("op11")
        if tokenizer_path not in mine:
            mine[tokenizer_path] = TokenIds(tokenizer_path)
        known, row, packer = mine[tokenizer_path], TaskContext.get().partitionId() << 33, zstandard.ZstdCompressor(level=1)
        for b in batches:
            at = 0
            for ids, n in ids_of_rows(known, b.column(1), end_id):
                raw, end = memoryview(ids.tobytes()), np.cumsum(n) * ids.itemsize
                packed = [packer.compress(raw[a:z]) for a, z in zip((end - n * ids.itemsize).tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(n)), pa.array(np.arange(row, row + len(n))), pa.array(n), pa.array(packed, pa.binary())],
                    ["id", "row", "n", "ids"])
                at, row = at + len(n), row + len(n)

    return arrow_map(docs, run, "id long, row long, n long, ids binary", owner="op11")


def _unpacked(b: pa.RecordBatch, kind):
    """The ids of each row of (n, ids)."""
    reader = zstandard.ZstdDecompressor()
    n, raw = b.column("n").to_pylist(), b.column("ids")
    for i, m in enumerate(n):
        yield np.frombuffer(reader.decompress(raw[i].as_buffer(), max_output_size=m * np.dtype(kind).itemsize), kind)


def id_counts(rows: DataFrame, n_ids: int, kind) -> np.ndarray:
    """How often each of ``n_ids`` ids occurs in all rows: an array per task, summed by Spark."""

    def run(batches):
        counts = np.zeros(n_ids, np.int64)
        for b in batches:
            if b.num_rows:
                counts += np.bincount(np.concatenate(list(_unpacked(b, kind))), minlength=n_ids)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["symbol", "n"])

    got = arrow_map(rows.select("n", "ids"), run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toArrow()  # <= n_ids rows
    out = np.zeros(n_ids, np.int64)
    out[got.column("symbol").to_numpy()] = got.column("n").to_numpy()
    return out


def _shard(batches, folder: str, shard: int, tab: rans.Table, tab_crc: int, kind, block: int, every: int):
    """Write the documents of one range, already in order, as a file; yield a row for each block."""
    system, path = opened(f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.bin")
    name = path.rsplit("/", 1)[1]
    held, docs, n_held, offset, first, places, at = [], [], 0, 0, 0, [], len(MAGIC)
    file = None
    rows = []

    def flush():
        nonlocal held, docs, n_held, first, at
        raw, index, points = pack_block(np.concatenate(held), docs, first, offset, tab, tab_crc, every)
        file.write(raw)
        places.append((at, len(raw), n_held))
        rows.append((name, shard, len(rows), at, index, points, n_held, first))
        at, first = at + len(raw), first + n_held
        held, docs, n_held = [], [], 0

    for b in batches:
        for i, n, ids in zip(b.column("id").to_pylist(), b.column("n").to_pylist(), _unpacked(b, kind)):
            file = file or system.open_output_stream(path)
            if not places and not held:
                file.write(MAGIC)
            done = 0
            while done < n:
                if not held:
                    offset = done  # the block begins inside this document
                take = min(n - done, block - n_held)
                docs.append((i, n))
                held.append(ids[done:done + take])
                n_held, done = n_held + take, done + take
                if n_held == block:
                    flush()
    if n_held:
        flush()
    if file:
        body = np.array(places, "<u8").tobytes()
        file.write(body + struct.pack("<II", len(places), zlib.crc32(body)) + TAIL)
        file.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*rows), _INDEX_TYPES)], _INDEX)


_INDEX = ["file", "shard", "block", "at", "index_size", "points", "n", "first"]
_INDEX_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def write_ids(df: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, block: int = BLOCK, every: int = EVERY) -> str:
    """Write the ids of all texts of ``df`` as shard files and return their folder.

    Documents stand in ascending order of the id (a whole number); null ids come first, rows that share
    an id stand by number of ids, then by place in the table.  Null text is empty: the end id alone.
    An empty table gives an index without rows.  ``folder`` (default: a new one in the checkpoint
    folder) must be shared by driver and executors.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    known = TokenIds(tokenizer_path)
    kind, n_ids = known.kind, max(len(known.n_bytes), end_id + 1)
    rows = stored(token_rows(df, tokenizer_path, id_col, text_col, end_id), "token-rows")
    tab = rans.Table.of_counts(id_counts(rows, n_ids, kind))
    freq = tab.freq.astype("<u4").tobytes()
    tab_crc = zlib.crc32(freq)
    system, path = opened(f"{folder}/table.bin")
    with system.open_output_stream(path) as f:
        f.write(TABLE_MAGIC + struct.pack("<III", rans.SCALE, len(tab.freq), tab_crc) + freq)
    shared = spark.sparkContext.broadcast(tab)
    # (the place in the table deals out rows of one id, should they be many)
    order = [F.col("id").asc_nulls_first(), F.col("n"), F.col("row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "n", "ids")

    def run(batches):
        yield from _shard(batches, folder, TaskContext.get().partitionId(), shared.value, tab_crc, kind, block, every)

    index = stored(arrow_map(dealt, run, "file string, shard int, block int, at long, index_size long, points int, n long, first long"), "token-index")
    totals = sorted(tuple(r) for r in index.groupBy("shard", "file").agg(F.sum("n")).collect())  # one row a file
    base = np.cumsum([0, *(t[2] for t in totals)]).tolist()
    before = spark.createDataFrame([(t[0], b) for t, b in zip(totals, base)], "shard int, before long")
    index.join(F.broadcast(before), "shard").write.parquet(f"{folder}/index")
    system, path = opened(folder)
    kept = {t[1] for t in totals}
    for info in system.get_file_info(FileSelector(path)):  # files of attempts that did not count
        if info.base_name.startswith("shard-") and info.base_name not in kept:
            system.delete_file(info.path)
    return folder


# ---------------------------------------------------------------- reading


def read_table(folder: str) -> tuple[rans.Table, int]:
    system, path = opened(f"{folder}/table.bin")
    with system.open_input_file(path) as f:
        raw = f.read()
    scale, n, crc = struct.unpack_from("<III", raw, len(TABLE_MAGIC))
    freq = raw[len(TABLE_MAGIC) + 12:]
    if raw[:len(TABLE_MAGIC)] != TABLE_MAGIC or scale != rans.SCALE or zlib.crc32(freq) != crc:
        raise ValueError("damaged table of frequencies")
    return rans.Table(np.frombuffer(freq, "<u4", n)), crc


def read_parts(spark: SparkSession, folder: str, with_ids: bool = False, units: int = UNITS) -> DataFrame:
    """``shard, id, start, n_tokens, offset, n, crc`` (and ``ids``): the part of each document that follows a
    checkpoint.  Every (block, checkpoint) is decoded on its own."""
    tab, tab_crc = read_table(folder)
    shared = spark.sparkContext.broadcast((tab, tab.symbols()))
    index = spark.read.parquet(f"{folder}/index")
    todo = index.select("file", "shard", "block", "at", "index_size", "before", F.explode(F.sequence(F.lit(0), F.col("points") - 1)).alias("part"))
    parts = max(1, -(-todo.count() // units))
    todo = todo.repartition(parts)

    def run(batches):
        tab, symbols = shared.value
        name = file = None
        for b in batches:
            for r in b.to_pylist():
                if r["file"] != name:
                    if file:
                        file.close()
                    system, path = opened(f"{folder}/{r['file']}")
                    name, file = r["file"], system.open_input_file(path)
                k = Block(file, r["at"], r["index_size"])
                if k.table_crc != tab_crc:
                    raise ValueError("a block that was coded by another table")
                ids = k.ids(r["part"], tab, symbols)
                lo = r["part"] * k.every * k.lanes  # of the block
                start = np.cumsum(k.size) - k.size - k.offset  # of each document, in ids of the block
                a, z = np.maximum(start, lo), np.minimum(start + k.size, lo + len(ids))
                here = np.flatnonzero(z > a)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (p - lo):4 * (q - lo)]) for p, q in zip(a[here].tolist(), z[here].tolist())]
                cols = [pa.array(np.full(len(here), r["shard"], np.int32)), pa.array(k.id[here], mask=k.null[here]),
                        pa.array(r["before"] + k.first + start[here]), pa.array(k.size[here]), pa.array((a - start)[here]),
                        pa.array((z - a)[here]), pa.array(crc, pa.int64())]
                names = ["shard", "id", "start", "n_tokens", "offset", "n", "crc"]
                if with_ids:
                    edge = np.append(a[here], z[here][-1:]) - lo
                    cols.append(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
        if file:
            file.close()

    return arrow_map(todo, run, "shard int, id long, start long, n_tokens long, offset long, n long, crc long" + (", ids array<int>" if with_ids else ""))


def read_documents(spark: SparkSession, folder: str, units: int = UNITS) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, from the files."""
    parts = read_parts(spark, folder, units=units)

    def run(batches):
        for b in batches:
            size, offset, n, crc = (b.column(c).to_numpy() for c in ("n_tokens", "offset", "n", "crc"))
            after = 4 * (size - offset - n)
            crc = crc.copy()
            for i in np.flatnonzero(after).tolist():
                crc[i] = moved_crc(int(crc[i]), int(after[i]))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("start"), b.column("n_tokens"), b.column("n"), pa.array(crc)],
                                             ["id", "start", "n_tokens", "n", "crc"])

    added = arrow_map(parts, run, "id long, start long, n_tokens long, n long, crc long")
    whole = added.groupBy("id", "start", "n_tokens").agg(F.sum("n").alias("n"), F.expr("bit_xor(crc)").alias("ids_crc32"))
    found = F.when(F.col("n") == F.col("n_tokens"), F.col("ids_crc32")).otherwise(F.raise_error(F.lit("ids of a document are missing in the files")))
    return whole.select("id", "start", "n_tokens", found.cast("long").alias("ids_crc32"))


def op11_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, folder).withColumnRenamed("id", "doc_id")
