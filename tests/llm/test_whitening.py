import math
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geoqa.llm import charpoly as C
from geoqa.llm import op13_whitening as W


def poly(m):
    """Characteristic polynomial by traces of powers (Faddeev-LeVerrier), in fractions."""
    d = len(m)
    m = [[Fraction(x) for x in r] for r in m]
    eye = [[Fraction(i == j) for j in range(d)] for i in range(d)]
    mul = lambda a, b: [[sum(a[i][k] * b[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    out, acc = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        acc = mul(m, [[acc[i][j] + out[-1] * eye[i][j] for j in range(d)] for i in range(d)])
        out.append(-sum(acc[i][i] for i in range(d)) / k)
    return [int(x) for x in out]


def exact(m):
    bound = C.coefficient_bound(len(m), sum(m[i][i] for i in range(len(m))))
    primes = C.primes_for(bound)
    return C.charpoly([C.charpoly_mod(np.array([[v % p for v in r] for r in m]), p).tolist() for p in primes], primes, bound)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6).flatmap(lambda d: st.lists(st.lists(st.integers(-50, 50), min_size=d, max_size=d), min_size=0, max_size=7).map(lambda r: (d, r))))
def test_polynomial_and_roots(case):
    d, rows = case
    b = np.array(rows, object).reshape(-1, d)
    m = (b.T @ b).tolist() if len(b) else [[0] * d for _ in range(d)]
    p = exact(m)
    assert p == poly(m)
    roots = C.top_eigenvalues(p, d)
    got = [r.number()[0] / 2 ** r.number()[1] for r in roots for _ in range(r.multiplicity)]
    want = np.linalg.eigvalsh(np.array(m, float))[::-1] if d else []
    top = max([1.0, *want])
    assert len(got) == d - next(i for i, c in enumerate(reversed(p)) if c)  # all roots but the zeros
    assert all(abs(g - w) <= 1e-9 * top for g, w in zip(got, want))


def test_multiple_and_close_roots():
    p = [1]
    for r in (7, 7, 7, 5, 5, 3, 10 ** 12, 10 ** 12 + 1):
        p = [a - r * b for a, b in zip(p + [0], [0] + p)]
    assert sorted((m, len(f) - 1) for m, f in C.square_free(p)) == [(1, 3), (2, 1), (3, 1)]
    roots = C.top_eigenvalues(p, 8)
    assert [(r.multiplicity, round(Fraction(r.hi, 1 << r.shift))) for r in roots] == [(1, 10 ** 12 + 1), (1, 10 ** 12), (3, 7), (2, 5), (1, 3)]


def brute(rows, k=16):
    """The contract in numpy doubles (moderate condition only)."""
    keep = [(i, [math.floor(64 * float(c)) + W.SHIFT for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in keep})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    f = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(d)] for x in fit])
    cov = f.T @ f / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    rank = int((e > 1e-9 * e[0]).sum()) if e[0] > 0 else 0
    k = min(k, rank)
    z = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(d)] for _, x in keep]) @ (v[:, :k] / np.sqrt(e[:k]))
    dev = [sum((n * x[j] - sums[j]) ** 2 for j in range(d)) for _, x in keep]
    return n, k, z, dev, e[:k] / e.sum(), [i for i, _ in keep], e[:k], v[:, :k]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def compare(spark, rows, **kw):
    n, k, z, dev, explained, ids, _, _ = brute([(r[0], r[1]) for r in rows])
    got = W.whiten(frame(spark, rows), **kw).collect()
    assert len(got) == len(ids) * k
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
    for i, dv, zi in zip(ids, dev, z):
        mine = sorted(by[i], key=lambda r: r.component)
        assert [r.component for r in mine][:k] == list(range(1, k + 1)) or len(mine) > k
        for c in range(k):
            r = [x for x in mine if x.component == c + 1][0]
            assert r.deviation == dv and abs(r.explained - explained[c]) < 1e-9
            assert abs(abs(r.whitened) - abs(zi[c])) < 1e-6
    return got


def test_whitening(spark):
    r = np.random.default_rng(5)
    base = r.normal(0, 0.3, (120, 20)) * np.linspace(0.2, 2, 20)
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(base)]
    rows += [(200 + i, rows[0][1], 1) for i in range(60)]  # one vector in many rows
    rows += [(300, None, 1), (301, [float("nan")] * 20, 1), (302, [None] + [0.0] * 19, 1), (303, [float("inf")] + [0.0] * 19, 1), (304, [], 1)]
    got = compare(spark, rows)
    assert not {x.id for x in got} & {300, 301, 302, 303, 304}
    # a null id and another length
    df = frame(spark, rows).unionByName(frame(spark, [(None, rows[1][1], None), (400, [0.5] * 3, 2)]))
    out = W.whiten(df.selectExpr("*", "1 as id", "2 as v", "3 as n"))
    assert out.where("id is null").count() == 16 and out.where("id = 400").count() == 0
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, [0.1, 0.2], 0), (2, [0.1, 0.2], 0)])).count() == 0  # no variance


def test_lower_rank_and_repeated_eigenvalues(spark):
    r = np.random.default_rng(6)
    rows = [(i, [float(x) for x in (a, b, a + b, 0.0)], 0) for i, (a, b) in enumerate(r.integers(-9, 9, (50, 2)))]
    got = W.whiten(frame(spark, rows)).collect()
    assert {x.component for x in got} == {1, 2} and all(x.identity_error < 1e-9 for x in got)
    signs = [(s, t, u) for s in (-1, 1) for t in (-1, 1) for u in (-1, 1)]  # covariance = multiple of the identity
    got = W.whiten(frame(spark, [(i, [float(x) for x in v], 0) for i, v in enumerate(signs)])).collect()
    z = np.zeros((8, 3))
    for x in got:
        z[x.id, x.component - 1] = x.whitened
        assert abs(x.explained - 1 / 3) < 1e-12
    assert np.allclose(z.T @ z / 8, np.eye(3), atol=1e-12)


def test_large_entries_are_exact(spark):
    r = np.random.default_rng(7)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(r.integers(-2 ** 40, 2 ** 40, (40, 3)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = W.whiten(df).collect()
    fit = [[64 * int(c) for c in v] for _, v, _ in rows]
    n, s = len(fit), [sum(x[j] for x in fit) for j in range(3)]
    dev = {i: sum((n * x[j] - s[j]) ** 2 for j in range(3)) for (i, _, _), x in zip(rows, fit)}
    assert all(x.deviation == (dev[x.id] if dev[x.id] < 2 ** 63 else None) and x.identity_error < 1e-9 for x in got) and len(got) == 120


def test_close_eigenvalues_give_exact_vectors():
    """Two eigenvalues of 10^12 that differ by 10^-7 of their size and less: vectors against a rational rotation."""
    q = [[3, 4, 0], [-4, 3, 0], [0, 0, 5]]  # orthogonal times 5
    lam = [10 ** 12 + 1, 10 ** 12, 17]
    m = [[sum(q[k][i] * lam[k] * q[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    roots = C.top_eigenvalues(exact(m), 3)
    for k, r in enumerate(roots):
        r.refine(400)
        v = W.null_vectors(m, r.number(), 1, 150)[0]
        assert max(abs(abs(a) - abs(b) / 5) for a, b in zip(v, q[k])) < 1e-15
