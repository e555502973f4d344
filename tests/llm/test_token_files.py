import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from geoqa.llm import op11_binary as B
from geoqa.llm import rans
from tests.llm.cases import EDGE, documents, prose

PATH = P.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.sampled_from([1, 2, 16, 64]), st.integers(1, 9))
def test_codec_round_trip_from_every_checkpoint(ids, lanes, every):
    ids = np.array(ids, np.int64)
    tab = rans.Table.of_counts(np.bincount(ids, minlength=45))
    c = rans.encode(ids, tab, lanes, every)
    parts = [rans.decode(c, tab, tab.symbols(), i) for i in range(len(c.at))]
    assert np.concatenate([*parts, np.zeros(0, np.uint32)]).tolist() == ids.tolist()


def test_table_of_counts():
    r = np.random.default_rng(2)
    for counts in (np.ones(50257, np.int64), r.integers(0, 3, 1000), np.array([10 ** 15, 1, 0, 1]), (1e9 / np.arange(1, 60000)).astype(np.int64), np.zeros(4, np.int64)):
        tab = rans.Table.of_counts(counts)
        assert tab.freq.sum() == 1 << rans.SCALE and (tab.freq[counts > 0] > 0).all()
    ids = np.minimum(r.geometric(0.02, 200_000), 5000)
    counts = np.bincount(ids, minlength=5001)
    tab = rans.Table.of_counts(counts)
    c = rans.encode(ids, tab, 256, 300)
    p = counts[counts > 0] / counts.sum()
    assert 32 * len(c.words) / len(ids) <= 1.01 * -(p * np.log2(p)).sum()  # within 1 % of the entropy
    with pytest.raises(ValueError):
        rans.encode(np.array([0]), tab, 1, 1)  # an id that never occurred


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=70), min_size=1, max_size=6))
def test_checksum_of_parts(parts):
    whole, rest, got = b"".join(parts), sum(map(len, parts)), 0
    for p in parts:
        rest -= len(p)
        got ^= B.moved_crc(zlib.crc32(p), rest)
    assert got == zlib.crc32(whole)


def wanted(rows):
    tok = Tokenizer.from_file(PATH)
    rows = [(i, tok.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    out, start = [], 0
    for i, ids in rows:
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, [i for r in rows for i in r[1]]


@pytest.mark.parametrize("block, every", [(B.BLOCK, B.EVERY), (300, 2)])
def test_files_round_trip(spark, block, every):
    rows = EDGE + [(100 + i, prose(i, 300)) for i in range(40)]
    folder = B.write_ids(documents(spark, rows).repartition(7), PATH, block=block, every=every)
    want, ids = wanted(rows)
    got = sorted(map(tuple, B.read_documents(spark, folder, units=3).collect()), key=lambda r: r[1])
    assert got == want
    pieces = B.read_parts(spark, folder, with_ids=True).collect()
    flat = np.zeros(len(ids), np.int64)
    for r in pieces:
        assert len(r.ids) == r.n
        flat[r.start + r.offset:r.start + r.offset + r.n] = r.ids
    assert flat.tolist() == ids
    if block == 300:
        assert len(pieces) > len(rows) + 50  # documents were cut


def test_empty_table_and_one_id_for_all_rows(spark):
    assert B.read_documents(spark, B.write_ids(documents(spark, []), PATH)).count() == 0
    rows = [(7, "same text here")] * 500 + [(7, "another one of another length " * 9)]
    got = sorted(tuple(r) for r in B.read_documents(spark, B.write_ids(documents(spark, rows), PATH)).select("id", "start", "n_tokens", "ids_crc32").collect())
    assert got == wanted(rows)[0]


def test_damage_is_found(spark):
    folder = B.write_ids(documents(spark, [(i, prose(i, 400)) for i in range(5)]), PATH)
    r = spark.read.parquet(f"{folder}/index").first()
    system, path = B.opened(f"{folder}/{r.file}")
    raw = bytearray(open(path, "rb").read())
    for at in (r.at + 5, r.at + r.index_size - 3, r.at + r.index_size + 40):  # head, index, states
        bad = bytearray(raw)
        bad[at] ^= 1
        open(path, "wb").write(bad)
        with pytest.raises(Exception, match="damaged block"):
            B.read_documents(spark, folder).collect()
    open(path, "wb").write(raw)
    assert B.read_documents(spark, folder).count() == 5
