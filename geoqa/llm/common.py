"""Helpers shared by the operators: tables, shared scratch, column hygiene, Arrow plumbing."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.session import ensure_checkpoint_dir, ship_package

#: Bits of the filter that keeps texts nobody asks for out of a shuffle (1 MB, whatever the data).
FILTER_BITS = 1 << 23
BATCH_ROWS = 1000
#: Bytes of batches after which a worker gives freed memory back.
TRIM_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (any path its readers know)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor costs a reread and not the work before
    it, and keeps results that must not change between two reads (ids, ranks).
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named input columns under the operator's own names.

    Every operator starts with this, so extra columns, whatever their names,
    never meet the ones it makes: ``only(df, id="doc_id", text="text")``.
    """
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in columns.items()])


#: What operators keep in a Python worker from task to task, by operator.
worker_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """The operator's cache in this worker."""
    return worker_caches.setdefault(owner, {})


def drop_caches(owner: str | None) -> None:
    """Forget what other operators keep in this worker."""
    for name in [n for n in worker_caches if n != owner]:
        del worker_caches[name]


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
              owner: str | None = None, rows: int = 0) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers, which give memory back now and then and after
    each task: an executor keeps idle workers, and what they hold on to adds up.  Rows hold whole texts,
    so batches have ``BATCH_ROWS`` rows where the session keeps Spark's default of 10,000; ``rows`` puts
    batches of short rows together to about so many.  Worker caches of operators other than ``owner`` are
    dropped."""
    ship_package(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def fed(batches):
        done, held, n = 0, [], 0
        for b in batches:
            done += b.nbytes
            if n + b.num_rows < rows:
                held.append(b)
                n += b.num_rows
                continue
            b = joined([*held, b])
            held, n = [], 0
            yield b
            del b
            if done > TRIM_BYTES:
                give_back()
                done = 0
        if held:
            yield joined(held)

    def run(batches):
        drop_caches(owner)
        try:
            yield from fn(fed(batches))
        finally:
            give_back()

    return df.mapInArrow(run, schema)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs (not: is planned) inside hands Python stages up to ``rows`` rows a batch: for rows of a few numbers,
    of which batches of ``BATCH_ROWS`` are so many that handing them over costs more than the work on them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def crc32_of_id(col) -> F.Column:
    """crc32 of the id as text; a null id counts as the empty string."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def gather(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Regroup a stream sorted by ``keys`` so that no group crosses two batches.

    Holds one group plus one batch at a time; groups must be bounded by design.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = np.ones(b.num_rows, bool)
        k[1:] = False
        for c in keys:
            v = b.column(c).to_numpy(zero_copy_only=False)
            k[1:] |= v[1:] != v[:-1]
        last = int(np.flatnonzero(k)[-1])
        same = bool(held) and all(held[-1].column(c)[-1] == b.column(c)[0] for c in keys)
        if held and (last or not same):
            head = b.slice(0, 0)
            if same:
                first = np.flatnonzero(k)
                stop = int(first[1]) if len(first) > 1 else b.num_rows
                head, b = b.slice(0, stop), b.slice(stop)
                last -= stop
            yield joined([*held, head])
            held = []
            if last > 0:
                yield b.slice(0, last)
                b = b.slice(last)
            if b.num_rows:
                held = [b]
        elif held:
            held.append(b)
        else:
            if last:
                yield b.slice(0, last)
            held = [b.slice(last)]
    if held:
        yield joined(held)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bit array over xxhash64(id): has every id of ``ids``; its size is fixed."""
    h = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = (ids.select(F.shiftright(h, 6).alias("word"), (h % 64).cast("int").alias("bit")).distinct()
             .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")))
    got = words.toArrow()  # <= FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out


def split_by_ids(df: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be among ``ids``, rows whose id is not): the first part is small when ``ids`` is,
    so that only it need be shuffled to the ids.  A null id is an id like any other here."""
    shared = df.sparkSession.sparkContext.broadcast(_id_filter(ids))
    names = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    probe = df.select(F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(FILTER_BITS)).alias("probe of the id"), "*")

    def part(wanted: int):
        def run(batches):
            for b in batches:
                h = b.column(0).to_numpy()
                yield b.filter(pa.array((shared.value[h >> 6] >> (h & 63)) & 1 == wanted)).select(range(1, len(names) + 1))

        return arrow_map(probe, run, schema)

    return part(1), part(0)


def asked(docs: DataFrame, asks: DataFrame, how: str = "inner") -> DataFrame:
    """(id, text) of ``docs`` joined with ``asks`` on id, by a shuffle of only the texts that may be asked for
    (also so that the Python stages before and after do not share a task)."""
    texts, _ = split_by_ids(docs.where("id is not null").select("id", "text"), "id", asks)
    return texts.hint("merge").join(asks, "id", how)


def without_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is not among ``ids`` (id); null ids match each other."""
    maybe, sure = split_by_ids(df, id_col, ids)
    gone = ids.select(F.col("id").alias("id that goes")).distinct()
    return sure.unionByName(maybe.hint("merge").join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col("id that goes")), "left_anti"))


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    parts = [p for p in parts if p.num_rows] or parts[:1]
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
