import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from geoqa.llm import op1_tokens, op10_pack
from tests.llm.cases import EDGE, documents


def test_token_counts(spark):
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for entries, cache in ((op1_tokens.TABLE, 1 << 20), (5, 3), (1, 1)):  # tiers decide speed only
        got = op1_tokens.count_tokens(documents(spark), path, entries=entries, cache=cache).collect()
        want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in EDGE]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert op1_tokens.count_tokens(documents(spark, []), path).count() == 0


def test_packing_round_trip(spark):
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = op10_pack.pack(documents(spark), path, with_ids=True).collect()
    texts = dict(EDGE)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = tok.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        pieces.sort(key=lambda r: (r.piece, r.sequence_id))
        copies = sum(1 for j, _ in EDGE if j == i)
        assert [x for r in pieces for x in r.ids] == ids * copies
        if copies == 1:
            assert [r.piece for r in pieces] == list(range((len(ids) - 1) // 2048 + 1))
            assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
            assert all(r.length == 2048 for r in pieces[1:])
    for s in by_seq.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == list(np.cumsum([0] + [r.length for r in s])[:-1]) and sum(r.length for r in s) <= 2048
    total = sum(r.length for r in got)
    assert len(by_seq) <= -(-total // 2048) + 1
    assert op10_pack.pack(documents(spark, []), path).count() == 0


def test_plan_respects_every_capacity():
    r = np.random.default_rng(3)
    for cap in (op10_pack.Capacity(), op10_pack.Capacity(2048, 3, 1 << 22), op10_pack.Capacity(2048, 50, 600_000)):
        for rule in (op10_pack.Rule(), op10_pack.Rule("dot", (1.0, 0.3, 0.3)), op10_pack.Rule("norm", (1.0, 0.5, 0.5))):
            hist = {int(n): int(c) for n, c in zip(r.integers(1, 700, 60), r.integers(1, 40, 60))}
            plan = op10_pack.plan_bins(hist, cap, rule)
            used, done = {}, {}
            for length, rank, n, seq, offset in plan.tolist():
                assert rank == done.get(length, 0)
                done[length] = rank + n
                for s in range(seq, seq + n):
                    used.setdefault(s, []).append((offset, length))
            assert done == hist
            for items in used.values():
                items.sort()
                assert [o for o, _ in items] == list(np.cumsum([0] + [n for _, n in items])[:-1])
                assert sum(n for _, n in items) <= cap.tokens and len(items) <= cap.documents and sum(n * n for _, n in items) <= cap.attention


def test_words_that_only_a_sound_key_tells_apart(spark):
    """Doubling words (ab ba -> abba baab ...) have equal polynomial sums modulo 2^64 from 1,024 bytes on."""
    a, b = "ab", "ba"
    while len(a) < 2048:
        a, b = a + b, b + a
    rows = [(1, a), (2, b), (3, "x " + a), (4, "x " + b)]
    count = {r.id: r.n_tokens for r in op1_tokens.count_tokens(documents(spark, rows), P.path("word_bpe_49k.json")).collect()}
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert count == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in rows}
    ids = {r.id: r.ids for r in op10_pack.pack(documents(spark, rows), P.path("byte_bpe_50k.json"), with_ids=True).collect()}
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert ids == {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
