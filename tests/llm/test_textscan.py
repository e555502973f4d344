import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from geoqa.llm import textscan as T
from tests.llm.cases import EDGE, alnum, spaced

TEXTS = [t for _, t in EDGE]


def words(texts, cls, lower, block):
    data, offs = T.buffer_of(pa.array(texts, pa.string()))
    w = T.scan(data, offs, cls, lower, block=block)
    return w, [[w.text(i).decode() for i in np.flatnonzero(w.doc == d)] for d in range(len(texts))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\tÉ0.-", max_size=30)), max_size=6), st.integers(1, 40))
def test_words_and_blocks(texts, block):
    w, got = words(texts, T.SPACED, False, block)
    assert got == [spaced(t) for t in texts]
    whole, _ = words(texts, T.SPACED, False, 1 << 20)
    assert (w.key == whole.key).all()
    data, offs = T.buffer_of(pa.array(texts, pa.string()))
    u = T.scan(data, offs, with_gap=True, block=block)
    assert [b"".join(u.text(i) for i in np.flatnonzero(u.doc == d)).decode() for d in range(len(texts))] == [t or "" for t in texts]


def test_classes_and_keys():
    w, got = words(TEXTS, T.ALNUM, True, 64)
    assert [[x.translate({c: c + 32 for c in range(65, 91)}) for x in r] for r in got] == [alnum(t) for t in TEXTS]
    by = {}
    for i in range(len(w)):
        by.setdefault(w.text(i).decode().lower() if w.text(i).isascii() else w.text(i), set()).add(int(w.key[i]))
    assert all(len(v) == 1 for v in by.values()) and len({k for v in by.values() for k in v}) == len(by)


def test_key_map():
    m, r = T.KeyMap(), np.random.default_rng(1)
    m.RUN = 50
    seen = {}
    for _ in range(20):
        k = np.setdiff1d(r.integers(0, 5000, 40).astype(np.uint64), np.array(list(seen), np.uint64))
        m.add(k, np.arange(len(seen), len(seen) + len(k)))
        seen.update(zip(k.tolist(), range(len(seen), len(seen) + len(k))))
    ask = np.arange(5000, dtype=np.uint64)
    assert m.get(ask).tolist() == [seen.get(int(k), -1) for k in ask]


def test_keys_of_doubling_words_and_lanes():
    a, b = "ab", "ba"
    while len(a) < 4096:
        a, b = a + b, b + a
    pad = "x" * 7
    texts = [a[:n] for n in (7, 8, 9, 63, 64, 65, 1024, 2048, 4096)] + [b[:n] for n in (7, 8, 9, 63, 64, 65, 1024, 2048, 4096)]
    keys = [int(k[0]) for k in T.keys_of(texts)]
    assert len(set(keys)) == len(texts)
    again = [int(k[-1]) for k in T.keys_of([pad + " " + t for t in texts])]  # the same wherever the word stands
    assert again == keys
    upper = [int(k[0]) for k in T.keys_of([t.upper() for t in texts], lower=True)]
    assert upper == keys
    every = bytes(range(1, 128)).decode() + "ÀÉÿ漢"
    low = every.translate({c: c + 32 for c in range(65, 91)})
    assert [k.tolist() for k in T.keys_of([every], T.ALNUM, lower=True)] == [k.tolist() for k in T.keys_of([low], T.ALNUM)]


def test_long_unbroken_text_stays_small():
    import subprocess
    import sys
    code = ("import resource, numpy as np, pyarrow as pa\n"
            "from geoqa.llm import textscan as T\n"
            "base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "data = np.full(64 << 20, 97, np.uint8); offs = np.array([0, len(data)])\n"
            "w = T.scan(data, offs, lower=True)\n"
            "assert len(w) == 1\n"
            "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) >> 10)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 150, out.stdout  # MB, the text's own 64 included
