import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geoqa.llm import op9_minhash as M
from tests.llm.cases import EDGE, LOWER, copy_of, documents, prose, spaced


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = spaced((t or "").translate(LOWER))
        out.setdefault(i, []).append({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute(rows):
    sets = sets_of(rows)
    ids = sorted(i for i in sets if i is not None)
    comp = {i: i for i in ids}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((root(a), root(b)))
                comp[q] = p
    return {i: root(i) for i in ids}


def check(spark, rows):
    want = brute(rows)
    got = M.near_duplicates(documents(spark, rows)).collect()
    sizes = sorted((str(i), len(s)) for i, ss in sets_of(rows).items() for s in ss)
    assert sorted((str(r.id), r.n_shingles) for r in got) == sizes
    for r in got:
        assert r.component_id == want.get(r.id) and r.kept == (r.id is None or r.component_id == r.id)


def test_edge_cases(spark):
    check(spark, EDGE)
    assert M.near_duplicates(documents(spark, [])).count() == 0
    kept = M.one_of_each(documents(spark))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(map(str, ids)) == sorted(["None"] + [str(i) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 15, 16, 17, 18)])
    assert kept.columns == documents(spark).columns


def test_groups_around_the_threshold(spark):
    # a hub with variants of growing distance, chains of copies of copies, a passage that many share
    rows, base = [], prose(5, 150)
    for i in range(40):
        rows.append((100 + i, copy_of(base, i, 1 + i // 4)))
    chain = prose(6, 100)
    for i in range(15):
        rows.append((200 + i, chain))
        chain = copy_of(chain, 50 + i, 2)
    hot = prose(7, 60)
    for i in range(40):
        rows.append((300 + i, hot + " " + prose(1000 + i, 2 + 2 * i)))
    rows += [(400 + i, t) for i, (_, t) in enumerate(rows[::7])] + [(101, "another text with the id of a variant"), (990, prose(5, 150))]
    check(spark, rows)


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10 ** 6))
def test_one_permutation_estimates_similarity(n, seed):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 2 ** 63, n).astype(np.uint64))
    b = np.concatenate((a[: max(1, int(len(a) * 0.8))], r.integers(0, 2 ** 63, max(0, len(a) - int(len(a) * 0.8))).astype(np.uint64)))
    row = np.repeat([0, 1, 2], [len(a), len(b), len(a)])
    sig = M.one_permutation(row, M.T.mix(np.concatenate((a, b, a))), 4, 640)
    assert (sig[0] == sig[2]).all() and (sig[3] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    j = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
    assert abs((sig[0] == sig[1]).mean() - j) < 0.2
