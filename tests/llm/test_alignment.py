import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from geoqa.llm import op12_alignment as A
from geoqa.llm import textscan as T
from geoqa.llm import token_ids
from tests.llm.cases import EDGE, documents, prose

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TOK = Tokenizer.from_file(A_PATH)
TOK.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
CHARS = {}
for b in range(256):  # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    plain = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
    CHARS[chr(b) if plain else chr(256 + sum(1 for x in range(b) if not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255)))] = b


def tokens(text):
    """(A ids with bytes, B ids with bytes) as the libraries give them, or none."""
    if not text:
        return [], []
    a = [(i, bytes(CHARS[c] for c in TOK.id_to_token(i))) for i in TOK.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in SP.encode(text):
        p = SP.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if SP.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute(texts):
    docs, count = [], Counter()
    for t in texts:
        a, b = tokens(t)
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = [(i, j) for i, p, q in spans[0] for j, r, s in spans[1] if p < s and r < q]
        ends = sorted({q for _, _, q in spans[0]} & {q for _, _, q in spans[1]})
        text, lo = [], 0
        for e in ends:
            text.append("|".join(",".join(str(i) for i, p, q in side if lo <= p and q <= e) for side in spans))
            lo = e
        docs.append((len(a), len(b), len(ends), links, hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""))
        count.update(links)
    top = {}
    for (_, j), n in count.items():
        top[j] = max(top.get(j, 0), n)
    return [(n_a, n_b, n_g, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), sha) for n_a, n_b, n_g, links, sha in docs]


ODD = ["▁ literal mark", "a▁b", " lead and trail  ", "\n\n  x\t\ty \n", "\x00 nul", "tab\ttab", "<unk> <s> <0x41> <|endoftext|>", " ", "   ", "　wide space",
       "é and é", "한국어 日本語 中文", "\U0001f600\U0001f468‍\U0001f469‍\U0001f467", "don't I'm we'll"]


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in EDGE if t is None or len(t) < 4000] + [(50 + i, t) for i, t in enumerate(ODD)] + [(100 + i, prose(i % 7, 60 + i % 3)) for i in range(30)]
    want = sorted(zip([str(i) for i, _ in rows], brute([t for _, t in rows])))
    for records, radices, slices in ((A.SPILL, A.RADICES, A.SLICE), (500, 3, 300)):  # many spills and slices
        got = A.align(documents(spark, rows).repartition(3), A_PATH, B_PATH, records=records, radices=radices, slice_bytes=slices).collect()
        assert sorted((str(r[0]), tuple(r[1:])) for r in got) == want
    assert A.align(documents(spark, []), A_PATH, B_PATH).count() == 0
    assert A.align(documents(spark, [(1, None), (2, "")]), A_PATH, B_PATH).select("n_links", "count_sum", "groups_sha256").distinct().collect() == [(0, 0, "")]


def test_long_texts(spark):
    rows = [(1, "x" * 5000), (2, prose(3, 9000)), (3, "word " * 3000), (4, "é漢" * 4000)]
    for r in A.align(documents(spark, rows), A_PATH, B_PATH).collect():
        a, b = tokens(dict(rows)[r.id])
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), len(ends[0] & ends[1]), len(ends[0] | ends[1]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'é \n\t▁.1漢\U0001f600", max_size=25), min_size=1, max_size=5))
def test_units_give_what_the_library_gives(texts):
    data, offs = A.spaced_rows(*T.buffer_of(pa.array(texts, pa.string())))
    for side, known in ((0, token_ids.TokenIds(A_PATH, plain_specials=True) if not KNOWN else KNOWN[0]), (1, token_ids.PieceIds(B_PATH) if not KNOWN else KNOWN[1])):
        if len(KNOWN) == side:
            KNOWN.append(known)
        ids, n = known.rows(data, offs)
        each = np.split(ids, np.cumsum(n)[:-1])
        for t, got in zip(texts, each):
            want = tokens(t)[side]
            if want or not t:
                assert got.tolist() == [i for i, _ in want]


KNOWN = []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 9), st.integers(1, 300)), max_size=40), max_size=5), st.integers(1, 7), st.integers(1, 20))
def test_merge_of_runs(runs, chunk, target):
    packed = []
    for r in runs:
        c = [np.array(v, np.int64) for v in zip(*sorted(r))] if r else []
        packed.append([(A.pack([v[i:i + chunk] for v in c]), 100) for i in range(0, len(r), chunk)])
    got, last = [], -1
    for key, doc, m in A.merged(packed, target):
        assert key[0] >= last and (np.diff(key) >= 0).all()
        last = key[-1]
        got += zip(key.tolist(), (doc - 100).tolist(), m.tolist())
    assert sorted(got) == sorted(x for r in runs for x in r)
