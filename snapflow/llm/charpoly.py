"""Exact spectra of symmetric integer matrices: characteristic polynomial, certified roots, eigenvectors.

Everything here works on one small matrix (its size is a vector dimension, never a row count). The polynomial comes from
images modulo 31-bit primes put together by Chinese remainders; a real-rooted polynomial has exactly as many roots above
``a`` as the coefficients of p(x + a) change sign, so bisection on that count isolates roots with their multiplicities.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb, isqrt, prod
from random import Random

import numpy as np


def primes(bits: int) -> list[int]:
    """Primes below 2**31, largest first, whose product has more than ``bits`` bits."""
    sieve = np.ones(46342, bool)
    for i in range(2, isqrt(len(sieve)) + 1):
        sieve[i * i::i] = False
    small = np.flatnonzero(sieve)[2:]
    found, have, n = [], 0, 2**31 - 1
    while have <= bits:
        if (n % small).all():
            found.append(n)
            have += n.bit_length() - 1
        n -= 2
    return found


def coefficient_bits(trace: int, d: int) -> int:
    """Bits that hold every coefficient of a positive semidefinite matrix's polynomial, and its sign (Maclaurin)."""
    return max((comb(d, k) * trace**k // d**k + 1).bit_length() for k in range(d + 1)) + 2


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` that is zero below the first subdiagonal."""
    h = a.copy()
    for m in range(1, len(h) - 1):
        rows = np.flatnonzero(h[m:, m - 1])
        if not len(rows):
            continue
        i = m + int(rows[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] + (p - u)[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(1)) % p
    return h


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - a) modulo ``p``, constant first; entries of ``a`` are residues."""
    h, d = hessenberg(a, p), len(a)
    q = [np.zeros(d + 1, np.int64) for _ in range(d + 1)]
    q[0][0] = 1
    for k in range(1, d + 1):
        now = np.roll(q[k - 1], 1)
        now = (now + (p - h[k - 1, k - 1]) * q[k - 1]) % p
        down = 1
        for i in range(1, k):
            down = down * int(h[k - i, k - i - 1]) % p
            if not down:
                break
            now = (now + (p - int(h[k - i - 1, k - 1]) * down % p) * q[k - i - 1]) % p
        q[k] = now
    return q[d]


def remainders(images: list[tuple[int, list[int]]]) -> list[int]:
    """Integers of least absolute value with the given residues: (prime, residues) for every prime."""
    whole = prod(p for p, _ in images)
    out = [0] * len(images[0][1])
    for p, residues in images:
        rest = whole // p
        unit = rest * pow(rest, -1, p)
        out = [x + r * unit for x, r in zip(out, residues, strict=True)]
    return [x - whole if 2 * x > whole else x for x in (x % whole for x in out)]


def distinct_roots(poly: list[int]) -> int:
    """Number of distinct roots: degree less that of gcd(p, p'), whose degree modulo a large prime is seldom larger."""
    best = 0
    for p in primes(90):
        a = [c % p for c in poly]
        b = [k * c % p for k, c in enumerate(poly)][1:]
        while b and not b[-1]:
            b.pop()
        while b:
            inv = pow(b[-1], -1, p)
            while len(a) >= len(b):
                f, at = a[-1] * inv % p, len(a) - len(b)
                a = [(x - f * b[i - at]) % p if i >= at else x for i, x in enumerate(a)][:-1]
            while a and not a[-1]:
                a.pop()
            a, b = b, a
        best = max(best, len(poly) - len(a))
    return best


class _Counter:
    """Roots above dyadic points of a real-rooted integer polynomial (coefficients constant first)."""

    def __init__(self, poly: list[int]):
        self.poly = poly

    def _scaled(self, bits: int) -> list[int]:
        d = len(self.poly) - 1
        return [c << bits * (d - k) for k, c in enumerate(self.poly)]

    def above(self, a: int, bits: int) -> int:
        """Roots greater than a / 2**bits, with multiplicity: sign changes of the shifted polynomial."""
        c = self._scaled(bits)
        for i in range(len(c) - 1):
            for k in range(len(c) - 2, i - 1, -1):
                c[k] += a * c[k + 1]
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def sign(self, a: int, bits: int) -> int:
        value = 0
        for c in reversed(self._scaled(bits)):
            value = value * a + c
        return (value > 0) - (value < 0)


@dataclass(frozen=True)
class Root:
    """One distinct root within (low, high] / 2**bits, and how often it occurs."""
    low: int
    high: int
    bits: int
    times: int

    def middle(self) -> Fraction:
        return Fraction(self.low + self.high, 2 << self.bits)


def roots(poly: list[int], digits: int = 96) -> list[Root]:
    """The positive roots of a real-rooted polynomial without negative ones, largest first, isolated from each other,
    each to ``digits`` significant bits and to 2**-48 of the distance to its neighbours."""
    zeros = next(k for k, c in enumerate(poly) if c)
    poly = poly[zeros:]
    if len(poly) == 1:
        return []
    count, d = _Counter(poly), len(poly) - 1
    distinct = distinct_roots(poly)
    top = 1 << (-poly[-2]).bit_length()                                # no root exceeds the sum of all
    open_ = [(0, top, 0, d)]
    while len(open_) < distinct:
        halves = []                                                    # of every interval that may hold several roots
        for low, high, bits, n in open_:
            if n == 1:
                halves.append((low, high, bits, n))
                continue
            low, mid, high, bits = _halves(low, high, bits)
            upper = count.above(mid, bits) - count.above(high, bits)
            halves += [(mid, high, bits, upper)] * (upper > 0) + [(low, mid, bits, n - upper)] * (upper < n)
        open_ = halves
    found = [_refine(count, Root(*o), digits) for o in open_]
    found.sort(key=Root.middle, reverse=True)
    gaps = [float(a.middle() / (a.middle() - b.middle())) for a, b in zip(found, found[1:], strict=False)]
    need = max([digits] + [int(np.log2(g)) + 50 for g in gaps])
    return found if need == digits else [_refine(count, r, need) for r in found]


def _halves(low: int, high: int, bits: int) -> tuple[int, int, int, int]:
    """(low, middle, high, bits) of an interval, scaled up where its ends are next to each other."""
    if high - low == 1:
        low, high, bits = 2 * low, 2 * high, bits + 1
    return low, (low + high) // 2, high, bits


def _refine(count: _Counter, r: Root, digits: int) -> Root:
    """Halve the interval of an isolated root until it has ``digits`` significant bits."""
    low, high, bits = r.low, r.high, r.bits
    at_high = count.sign(high, bits) if r.times % 2 else 0
    if r.times % 2 and at_high == 0:
        return _exact(high, bits, r.times, digits)
    above_high = None if r.times % 2 else count.above(high, bits)
    while (high - low) << digits > max(low, 1):
        low, mid, high, bits = _halves(low, high, bits)
        if r.times % 2:
            s = count.sign(mid, bits)
            if s == 0:
                return _exact(mid, bits, r.times, digits)
            low, high = (low, mid) if s == at_high else (mid, high)
        else:
            low, high = (mid, high) if count.above(mid, bits) > above_high else (low, mid)
    return Root(low, high, bits, r.times)


def _exact(at: int, bits: int, times: int, digits: int) -> Root:
    """A root that is this dyadic number: an interval around it of the asked width."""
    more = max(0, digits + 1 - at.bit_length()) + 2
    return Root((at << more) - 1, (at << more) + 1, bits + more, times)


def eigenvectors(matrix: list[list[int]], root: Root, digits: int) -> list[list[float]]:
    """Orthonormal eigenvectors of a distinct root, as many as it occurs, by inverse iteration on the nearly singular
    matrix - root * I in decimals of ``digits`` places; the largest entry of each is positive."""
    d = len(matrix)
    with localcontext() as ctx:
        ctx.prec = digits
        mid = root.middle()
        mu = Decimal(mid.numerator) / Decimal(mid.denominator)
        a = np.array([[Decimal(x) for x in row] for row in matrix], object)
        a[np.arange(d), np.arange(d)] -= mu
        tiny = Decimal(10) ** -digits * max(mu, Decimal(1))
        order = np.arange(d)
        for k in range(d):                                             # LU with row pivots, in place
            i = k + int(np.argmax(np.abs(a[k:, k])))
            if i != k:
                a[[i, k]], order[[i, k]] = a[[k, i]], order[[k, i]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1:, k] /= a[k, k]
            a[k + 1:, k + 1:] -= a[k + 1:, k][:, None] * a[k, k + 1:]
        found: list[np.ndarray] = []
        for start in range(root.times):
            draw = Random(start)
            v = np.array([Decimal(draw.randint(1, 1000)) for _ in range(d)], object)
            for _ in range(4):
                for w in found:
                    v = v - (v * w).sum() * w
                y = v[order]
                for k in range(d):
                    y[k + 1:] -= a[k + 1:, k] * y[k]
                for k in range(d - 1, -1, -1):
                    y[k] = y[k] / a[k, k]
                    y[:k] -= a[:k, k] * y[k]
                for w in found:
                    y = y - (y * w).sum() * w
                v = y / (y * y).sum().sqrt()
            big = max(range(d), key=lambda i: (abs(v[i]), -i))
            found.append(v if v[big] > 0 else -v)
        return [[float(x) for x in v] for v in found]
