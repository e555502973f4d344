"""Operator 1 - token counts with a two-tier lookup, no shuffle of pre-tokens.

A text is cut at ASCII white space; the tokenizer never joins pieces across it,
so a text's count is the sum over its pieces.  The counts of a piece come from

1. a broadcast table (sorted 64-bit keys, 16-bit lengths) of the pieces that are
   most frequent in a bounded sample - at most ``TABLE`` entries of 10 bytes;
2. a cache in each Python worker; what it lacks is encoded by the tokenizer.

The sample and both tiers decide only how fast a count is found, never which.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, only, table, worker_cache

#: Entries of the broadcast table (10 bytes each), rows sampled to choose them,
#: entries a worker caches before it starts anew.
TABLE, SAMPLE_ROWS, CACHE = 1 << 17, 4000, 1 << 20
OVER_LIMIT = 2048

def _tokenizer(path: str):
    """The worker's tokenizer; no truncation or padding, special strings as the library treats them."""
    loaded = worker_cache("op1")
    if path not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        loaded[path] = (t, {})
    return loaded[path]


def _encode_lengths(tok, pieces: list[str]) -> list[int]:
    return [len(e.ids) for e in tok.encode_batch(pieces, add_special_tokens=False)]


def frequent_pieces(df: DataFrame, text: str, entries: int = TABLE, sample_rows: int = SAMPLE_ROWS) -> pa.Table:
    """``key, piece`` of the most frequent pieces of a bounded sample of rows."""
    docs = only(df, text=text)
    rows = docs.count()
    if rows > sample_rows:
        docs = docs.sample(fraction=sample_rows / rows, seed=1)

    def pieces(batches):
        for b in batches:
            for _, _, data, offs in T.chunks(b.column(0)):
                w = T.scan(data, offs)
                key, first, n = np.unique(w.key, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(T.signed(key)), pa.array([w.text(i).decode() for i in first], pa.string()), pa.array(n, pa.int64())],
                    ["key", "piece", "n"])

    got = (arrow_map(docs, pieces, "key long, piece string, n long").where(F.length("piece") < 64)
           .groupBy("key").agg(F.first("piece").alias("piece"), F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "key").limit(entries))
    return got.select("key", "piece").toArrow()


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 entries: int = TABLE, sample_rows: int = SAMPLE_ROWS, cache: int = CACHE) -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row.

    Null text counts as empty (0 bytes, 0 tokens); rows keep their number, also
    with repeated or null ids; an empty table gives an empty result; other
    columns are ignored.
    """
    docs = only(df, id=id_col, text=text_col)
    common = frequent_pieces(docs, "text", entries, sample_rows)
    tok, _ = _tokenizer(tokenizer_path)
    keys = common.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    lengths = np.array(_encode_lengths(tok, common.column("piece").to_pylist()), np.int64)
    small = lengths < 1 << 16
    order = order[small[order]] if len(order) else order
    shared = df.sparkSession.sparkContext.broadcast((keys[order], lengths[order].astype(np.uint16)))
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        tok, seen = _tokenizer(tokenizer_path)
        known, length = shared.value
        for b in batches:
            n_bytes, n_tokens = [], []
            for _, _, data, offs in T.chunks(b.column(1)):
                w = T.scan(data, offs)
                key, first, place = np.unique(w.key, return_index=True, return_inverse=True)
                at = np.searchsorted(known, key)
                at[at == len(known)] = 0
                hit = known[at] == key if len(known) else np.zeros(len(key), bool)
                n = np.zeros(len(key), np.int64)
                n[hit] = length[at[hit]]
                miss = np.flatnonzero(~hit)
                if len(seen) > cache:
                    seen.clear()
                ks = key[miss].tolist()
                new = [i for i, k in enumerate(ks) if k not in seen]
                got = _encode_lengths(tok, [w.text(first[miss[i]]).decode() for i in new])
                seen.update(zip([ks[i] for i in new], got))
                n[miss] = [seen[k] for k in ks]
                n_bytes.append(np.diff(offs))
                n_tokens.append(np.bincount(w.doc, n[place], len(offs) - 1).astype(np.int64))
            if n_bytes:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.concatenate(n_bytes)), pa.array(np.concatenate(n_tokens))], ["id", "n_bytes", "n_tokens"])

    return arrow_map(docs, run, f"id {id_type}, n_bytes long, n_tokens long", owner="op1")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    out = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"))
