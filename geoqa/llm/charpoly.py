"""Exact eigenvalues of symmetric integer matrices: characteristic polynomial and its real roots.

* modulo a prime: reduction to Hessenberg form by similarity, then the recurrence over
  leading minors (``charpoly_mod``);
* the integer coefficients follow from enough primes by Chinese remaindering (``lifted``);
  for a positive semidefinite matrix the k-th one is the sum of all k-by-k principal
  minors, at most C(d, k) (trace / d)^k;
* zero roots are factors x; multiple roots are told apart by square-free factors;
* all roots are real, so the sign changes of f(x + c) count the roots above c exactly
  (Descartes' rule is an equality then): bisection with that count isolates the largest
  roots, and the sign of f refines them to any number of bits.
"""

from __future__ import annotations

from math import comb

import numpy as np


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (at most 2^31, so that products fit 62 bits)."""
    out, n = [], top - 1 | 1
    while len(out) < count:
        n -= 2
        if all(n % p for p in (3, 5, 7, 11, 13, 17, 19, 23, 29, 31)) and _is_prime(n):
            out.append(n)
    return out


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that are exact below 3.2 * 10^9."""
    s = (n - 1 & 1 - n).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, n - 1 >> s, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def charpoly_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - m) modulo p, highest power first."""
    h, d = m.astype(np.int64) % p, len(m)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        j = k + int(below[0])
        if j != k:
            h[[k, j]] = h[[j, k]]
            h[:, [k, j]] = h[:, [j, k]]
        u = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - u[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * u % p).sum(1)) % p
    # polys[k]: of the leading k-by-k block, lowest power first
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.roll(polys[k], 1)
        new[0] = 0
        new = (new - int(h[k, k]) * polys[k] % p) % p
        weight = 1
        for i in range(k - 1, -1, -1):
            weight = weight * int(h[i + 1, i]) % p
            if not weight:
                break
            new = (new - weight * int(h[i, k]) % p * polys[i] % p) % p
        polys[k + 1] = new
    return polys[d][::-1].copy()


def coefficient_bound(d: int, trace: int) -> int:
    """Above every coefficient (in size) of the characteristic polynomial of a positive semidefinite matrix."""
    mean = -(-trace // d)
    return max(comb(d, k) * mean ** k for k in range(d + 1)) + 1


def primes_for(bound: int) -> list[int]:
    """Primes whose product is above ``bound``, and one more as a check."""
    return primes_below(1 << 31, bound.bit_length() // 30 + 2)


def lifted(residues: list[list[int]], primes: list[int]) -> list[int]:
    """Whole numbers 0 <= x < product of the primes with these residues (a row for each prime)."""
    out, product = [0] * len(residues[0]), 1
    for row, p in zip(residues, primes):
        inverse = pow(product, -1, p)
        out = [x + product * ((r - x) * inverse % p) for x, r in zip(out, row)]
        product *= p
    return out


def charpoly(residues: list[list[int]], primes: list[int], bound: int) -> list[int]:
    """The integer polynomial, highest power first, from its residues; the signs of a positive semidefinite
    matrix alternate.  The product of the primes must be above ``bound`` without the last one, which checks."""
    signed = [[r if k % 2 == 0 else -r for k, r in enumerate(row)] for row in residues]
    out = lifted(signed[:-1], primes[:-1])
    if any(x > bound or (x - r) % primes[-1] for x, r in zip(out, signed[-1])):
        raise ArithmeticError("residues that do not belong to one positive semidefinite matrix")
    return [x if k % 2 == 0 else -x for k, x in enumerate(out)]


# ---------------------------------------------------------------- square-free factors


def _gcd_mod(a: list[int], b: list[int], p: int) -> list[int]:
    a, b = [x % p for x in a], [x % p for x in b]
    while b and not b[0]:
        b = b[1:]
    while b:
        inverse = pow(b[0], -1, p)
        while len(a) >= len(b):
            f = a[0] * inverse % p
            a = [(x - f * y) % p for x, y in zip(a, b + [0] * (len(a) - len(b)))][1:]
        while a and not a[0]:
            a = a[1:]
        a, b = b, a
    inverse = pow(a[0], -1, p)
    return [x * inverse % p for x in a]


def _derivative(f: list[int]) -> list[int]:
    n = len(f) - 1
    return [c * (n - i) for i, c in enumerate(f[:-1])]


def _divided(f: list[int], g: list[int]) -> list[int] | None:
    """f / g for a monic g, or None if that leaves a rest."""
    f, out = list(f), []
    while len(f) >= len(g):
        c = f[0]
        out.append(c)
        f = [x - c * y for x, y in zip(f, g + [0] * (len(f) - len(g)))][1:]
    return None if any(f) else out


def _gcd(f: list[int], g: list[int]) -> list[int]:
    """Greatest common divisor, monic, of a monic integer polynomial and another one."""
    top, least, rows, used = 1 << 31, None, [], []
    done = 0
    for p in primes_below(top, 4 * (max(abs(c) for c in f).bit_length() + len(f)) // 30 + 20):
        got = _gcd_mod(f, g, p)
        if len(got) == 1:
            return [1]
        if least is None or len(got) < least:
            least, rows, used = len(got), [], []
        if len(got) == least:
            rows.append(got)
            used.append(p)
        done += 1
        if done % 8 == 0 and rows:
            product = 1
            for q in used:
                product *= q
            h = [x - product if 2 * x > product else x for x in lifted(rows, used)]
            if _divided(f, h) is not None and _divides(h, g):
                return h
    raise ArithmeticError("no common divisor found")


def _divides(h: list[int], g: list[int]) -> bool:
    return _divided(g, h) is not None


def square_free(f: list[int]) -> list[tuple[int, list[int]]]:
    """(multiplicity, square-free factor) of a monic integer polynomial; roots of one factor share a multiplicity."""
    out, k = [], 1
    if len(f) == 1:
        return out
    g = _gcd(f, _derivative(f))
    rest = _divided(f, g)  # every root once
    while len(rest) > 1:
        if len(g) == 1:
            out.append((k, rest))
            break
        both = _common(g, rest)  # the roots that occur once more
        only = _divided(rest, both)
        if len(only) > 1:
            out.append((k, only))
        g, rest, k = _divided(g, both), both, k + 1
    return out


def _common(f: list[int], g: list[int]) -> list[int]:
    return [1] if len(f) == 1 or len(g) == 1 else _gcd(f, g)


# ---------------------------------------------------------------- real roots


def _above(f: list[int], c: int) -> int:
    """Roots above ``c`` of a polynomial whose roots are all real: sign changes of f(x + c)."""
    a = list(f)
    n = len(a)
    for i in range(1, n):  # synthetic division, again and again
        for j in range(1, n - i + 1):
            a[j] += c * a[j - 1]
    signs = [x > 0 for x in a if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(f: list[int], c: int) -> int:
    v = 0
    for x in f:
        v = v * c + x
    return v


class Root:
    """A root of a square-free factor: lo < root <= hi in units of 2^-shift."""

    def __init__(self, factor: list[int], multiplicity: int, lo: int, hi: int, shift: int):
        self.factor, self.multiplicity, self.lo, self.hi, self.shift = factor, multiplicity, lo, hi, shift

    def refine(self, bits: int) -> None:
        """Narrow the interval down until its lower end has ``bits`` significant bits."""
        f = [c << self.shift * k for k, c in enumerate(self.factor)]  # roots times 2^shift
        above = _value(f, self.hi)
        while above and (self.hi - self.lo > 1 or self.lo.bit_length() < bits):
            if self.hi - self.lo == 1:  # finer units
                step = max(32, bits - self.lo.bit_length() + 1)
                f = [c << step * k for k, c in enumerate(f)]
                self.lo, self.hi, self.shift = self.lo << step, self.hi << step, self.shift + step
            mid = self.lo + self.hi >> 1
            v = _value(f, mid)
            if v == 0 or (v > 0) == (above > 0):
                self.hi, above = mid, v
            else:
                self.lo = mid
        if not above:  # the upper end is the root
            step = max(0, bits - self.hi.bit_length() + 1)
            self.hi, self.shift = self.hi << step, self.shift + step
            self.lo = self.hi - 1

    def number(self) -> tuple[int, int]:
        """(numerator, shift): the root is numerator / 2^shift, but for less than a unit once it is refined."""
        return self.hi, self.shift


def largest_roots(f: list[int], multiplicity: int, count: int) -> list[Root]:
    """The ``count`` largest roots, largest first, of a square-free f with only positive real roots; isolated."""
    total = len(f) - 1
    top = 1 << (max(abs(c) for c in f[1:]).bit_length() if total else 0)  # above all roots (monic)
    top = min(top, 1 << (sum(abs(c) for c in f[1:2]).bit_length() + 1)) if total else top  # and above their sum
    out: list[Root] = []
    shift = 0
    g = list(f)
    todo = [(0, top, total, 0)]  # intervals (lo, hi], roots in them, roots above hi; rightmost last
    while todo and len(out) < count:
        lo, hi, n, over = todo.pop()
        if n == 1:
            out.append(Root(f, multiplicity, lo, hi, shift))
            continue
        if hi - lo == 1:  # finer units
            step = 64
            g = [c << step * k for k, c in enumerate(g)]
            shift += step
            todo = [(a << step, b << step, m, o) for a, b, m, o in todo]
            lo, hi = lo << step, hi << step
        mid = lo + hi >> 1
        right = _above(g, mid) - over
        if right < n:
            todo.append((lo, mid, n - right, over + right))
        if right:
            todo.append((mid, hi, right, over))
    return out


def top_eigenvalues(poly: list[int], count: int) -> list[Root]:
    """The positive roots of a characteristic polynomial, largest first, until their multiplicities add up to ``count``
    (and the next one, for the gap below)."""
    while poly and poly[-1] == 0:
        poly = poly[:-1]
    roots = [r for m, f in square_free(poly) for r in largest_roots(f, m, count + 1)]
    for r in roots:
        r.refine(64)
    bits = 64
    while True:  # roots of different factors, or close ones, must be told apart
        roots.sort(key=lambda r: r.lo << 4096 >> r.shift, reverse=True)
        close = [(a, b) for a, b in zip(roots, roots[1:]) if (a.lo << b.shift) <= (b.hi << a.shift)]
        if not close:
            break
        bits *= 2
        for r in {id(x): x for pair in close for x in pair}.values():
            r.refine(bits)
    out, have = [], 0
    for r in roots:
        out.append(r)
        if have >= count:
            break
        have += r.multiplicity
    return out
