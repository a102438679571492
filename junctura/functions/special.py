"""Special functions on arrays, as far as the tests of the model need them."""

from __future__ import annotations

import numpy as np


def lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of positive numbers: shifted to 8 and above, then Stirling's series."""
    x = np.asarray(x, float)
    shift, product = x.copy(), np.ones_like(x)
    for _ in range(8):
        low = shift < 8
        product = np.where(low, product * shift, product)
        shift = np.where(low, shift + 1, shift)
    r = 1 / (shift * shift)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / shift
    return (shift - 0.5) * np.log(shift) - shift + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def digamma(x: float) -> float:
    total = 0.0
    while x < 8:
        total, x = total - 1 / x, x + 1
    r = 1 / (x * x)
    return total + np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r / 252))


def trigamma(x: float) -> float:
    total = 0.0
    while x < 8:
        total, x = total + 1 / (x * x), x + 1
    r = 1 / (x * x)
    return total + 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r / 42))


def trigamma_inverse(y: float) -> float:
    """x with trigamma(x) = y, by bisection of its logarithm."""
    low, high = -20.0, 20.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if trigamma(float(np.exp(mid))) > y else (low, mid)
    return float(np.exp((low + high) / 2))


def beta_tail(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b), by its continued fraction."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.clip(np.asarray(x, float), 0, 1))
    turn = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(turn, b, a), np.where(turn, a, b), np.where(turn, 1 - x, x)
    tiny = 1e-300
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(np.maximum(x, tiny)) + b * np.log1p(-np.minimum(x, 1 - 1e-16))) / a
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + k * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + k / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    value = np.where(x <= 0, 0.0, front * h)
    return np.clip(np.where(turn, 1 - value, value), 0, 1)


def f_tail(f: np.ndarray, df1: float, df2: np.ndarray) -> np.ndarray:
    """Upper tail of the F distribution."""
    f = np.maximum(np.asarray(f, float), 0)
    return beta_tail(np.asarray(df2, float) / 2, np.full_like(f, df1 / 2), df2 / (df2 + df1 * f))
