"""Exact characteristic polynomials of integer matrices, their largest roots, and null spaces there.

The polynomial is found modulo many primes below 2**31, by reduction to
Hessenberg form, and put together by the Chinese remainder theorem; a bound on
the coefficients says how many primes are enough. Real roots are isolated by
halving: a polynomial whose roots are all real has as many of them above ``a``
as the coefficients of ``p(x + a)`` have changes of sign, which integers count
without error.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np

#: bits to which roots are found, and decimal digits that solve for components
ROOT_BITS, DIGITS = 128, 100


def primes_below(limit: int, count: int) -> list[int]:
    """The largest ``count`` primes below ``limit``, falling."""
    root = math.isqrt(limit) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for i in range(2, math.isqrt(root) + 1):
        sieve[i * i :: i] = False
    small, found, at = np.flatnonzero(sieve), [], limit - 1
    while len(found) < count and at > 1:
        if (at % small[small < at] != 0).all():
            found.append(at)
        at -= 1
    return found


def coefficient_bits(trace: int, size: int) -> int:
    """Bits of the largest coefficient of a matrix without negative eigenvalues:
    the k-th is a sum of products of k of them, largest when all are equal."""
    return max((math.comb(size, k) * trace**k // size**k + 1).bit_length() for k in range(size + 1))


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """``det(xI - matrix)`` modulo a prime below 2**31, the constant first."""
    size = len(matrix)
    h = np.array(matrix % p, np.int64)
    for m in range(1, size - 1):
        some = np.flatnonzero(h[m:, m - 1])
        if not len(some):
            continue
        i = m + int(some[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    #: polynomials of the leading parts
    lead = np.zeros((size + 1, size + 1), np.int64)
    lead[0, 0] = 1
    for k in range(size):
        weight, product = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            product = product * int(h[i + 1, i]) % p
            weight[i] = product * int(h[i, k]) % p
        new = -int(h[k, k]) * lead[k] % p
        new[1:] += lead[k, :-1]
        lead[k + 1] = (new - (weight[:, None] * lead[:k] % p).sum(axis=0)) % p
    return lead[size].tolist()


def combine(residues: dict[int, list[int]]) -> list[int]:
    """The numbers, of either sign, that leave these remainders by prime."""
    total, value = 1, None
    for p, rest in residues.items():
        if value is None:
            total, value = p, list(rest)
            continue
        inverse = pow(total, -1, p)
        value = [v + total * ((r - v) * inverse % p) for v, r in zip(value, rest)]
        total *= p
    return [v - total if 2 * v > total else v for v in value]


class Roots:
    """The roots of a polynomial that has real roots from 0 on only."""

    def __init__(self, coefficients: list[int]):
        self.coefficients = coefficients
        self.degree = len(coefficients) - 1
        self.positive = self.degree - next(i for i, c in enumerate(coefficients) if c)
        self._known: dict[Fraction, int] = {}

    def above(self, t: int, scale: int) -> int:
        """How many roots, each as often as it occurs, lie above ``t / 2**scale``."""
        at = Fraction(t) / Fraction(2) ** scale
        if at not in self._known:
            n, up = self.degree, max(scale, 0)
            b = [c << up * (n - i) for i, c in enumerate(self.coefficients)]
            t = t if scale >= 0 else t << -scale
            for i in range(n):
                carry = b[n]
                for j in range(n - 1, i - 1, -1):
                    carry = b[j] = b[j] + t * carry
            signs = [c > 0 for c in b if c]
            self._known[at] = sum(x != y for x, y in zip(signs, signs[1:]))
        return self._known[at]

    def largest(self, k: int, bits: int = ROOT_BITS) -> tuple[Fraction, Fraction]:
        """Bounds of the ``k``-th largest root (a positive one), apart by less than 2**-bits of it.
        Roots closer than that get the same bounds."""
        # the power of two below the root: 2**low < root <= 2**high
        high = (-self.coefficients[-2]).bit_length() + 1
        step, low = 1, high - 1
        while self.above(1, -low) < k:
            high, low, step = low, low - step, 2 * step
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.above(1, -mid) >= k else (low, mid)
        scale = bits - low
        a, b = 1 << bits, 2 << bits
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if self.above(mid, scale) >= k else (a, mid)
        unit = Fraction(2) ** -scale
        return a * unit, b * unit


def _decimal(x: Fraction) -> Decimal:
    return Decimal(x.numerator) / Decimal(x.denominator)


def null_vectors(matrix: np.ndarray, root: Fraction, count: int) -> np.ndarray:
    """``count`` orthonormal vectors that ``matrix - root`` all but removes, as doubles, one a row.

    Inverse iteration with 100 digits; the largest component is positive.
    """
    size = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        a = np.array([[Decimal(int(x)) for x in row] for row in matrix], object)
        a[np.arange(size), np.arange(size)] -= _decimal(root)
        tiny = max(abs(x) for x in a.reshape(-1)).scaleb(-DIGITS) or Decimal(1).scaleb(-DIGITS)
        order = np.arange(size)
        for k in range(size):
            pivot = k + max(range(size - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[[k, pivot]] = order[[pivot, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, k + 1 :]

        def unit(v, found):
            for other in found:
                v = v - (v * other).sum() * other
            return v / (v * v).sum().sqrt()

        found: list[np.ndarray] = []
        for c in range(count):
            v = np.array([Decimal(1 + (i * (c + 2) * 7919 + c * 104729) % 1009) for i in range(size)], object)
            for _ in range(4):
                v = v[order]
                for k in range(size):
                    v[k + 1 :] = v[k + 1 :] - a[k + 1 :, k] * v[k]
                for k in range(size - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1 :] * v[k + 1 :]).sum()) / a[k, k]
                v = unit(v / max(abs(x) for x in v), found)
            found.append(unit(v, found))
        out = np.array([[float(x) for x in v] for v in found])
    signs = np.sign(out[np.arange(count), np.abs(out).argmax(axis=1)])
    return out * signs[:, None]
