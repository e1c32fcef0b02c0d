"""Distribution functions for test statistics.

They only ever see one row per test, after all aggregation is done in Spark.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to this many values on the smaller side the rank test is exact, up to this many in either
#: sample the Kolmogorov-Smirnov test is.
EXACT_SIDE, EXACT_KS = 8, 10_000


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function (continued fraction, Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * h / a


def t_two_sided(t: float, dof: float) -> float:
    return beta_inc(dof / 2.0, 0.5, dof / (dof + t * t))


def t_quantile(p: float, dof: float) -> float:
    """Upper quantile for p > 0.5, by bisection on the two-sided tail."""
    target, low, high = 2.0 * (1.0 - p), 0.0, 1.0
    while t_two_sided(high, dof) > target:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if t_two_sided(mid, dof) > target:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - front * total
    b = x + 1.0 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = 1.0 / (an * d + b)
        c = b + an / c
        step = c * d
        h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * h


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


@lru_cache(maxsize=EXACT_SIDE)
def _partition_numerator(n: int) -> tuple[int, list[int]]:
    """L and the polynomial N with 1 / ((1 - q) (1 - q)(1 - q^2)...(1 - q^n)) = N(q) / (1 - q^L)^(n + 1)."""
    period, numerator = math.lcm(*range(1, n + 1)), [1]
    for part in (1, *range(1, n + 1)):
        # Times 1 + q^part + q^(2 part) + ... below q^L.
        out = [0] * (len(numerator) + period - part)
        for j in range(len(out)):
            fresh = numerator[j] if j < len(numerator) else 0
            gone = numerator[j - period] if 0 <= j - period < len(numerator) else 0
            out[j] = fresh - gone + (out[j - part] if j >= part else 0)
        numerator = out
    return period, numerator


def mann_whitney_exact(u: float, n: int, m: int) -> float:
    """P(U >= u) without ties, exact for a smaller side of at most ``EXACT_SIDE`` and any larger one.

    The arrangements with U <= k are the partitions of at most k into n parts of at most m. Inclusion and exclusion
    over the parts that are too large leaves 2^n counts of partitions without that limit, each a short sum of
    binomial coefficients, so no table of the size n m is needed.
    """
    n, m = sorted((n, m))
    period, numerator = _partition_numerator(n)

    def at_most(k: int) -> int:
        return sum(
            numerator[r] * math.comb((k - r) // period + n, n)
            for r in range(k % period, min(k + 1, len(numerator)), period)
        ) if k >= 0 else 0

    # The law is symmetric: as many arrangements reach u as stay below n m - u.
    k, ways = n * m - math.ceil(u), 0
    for some in range(1 << n):
        over = [m + i + 1 for i in range(n) if some >> i & 1]
        ways += (-1) ** len(over) * at_most(k - sum(over))
    return ways / math.comb(n + m, n)


def ks_exact(distance: float, n: int, m: int) -> float:
    """P(D >= distance) of the two-sample Kolmogorov-Smirnov statistic for samples of n and m different values.

    The pooled order of both samples is a path from (0, 0) to (n, m), all being equally likely. Diagonal by diagonal
    the recursion holds, for each place, which share of the paths to it has stayed within the distance; only places
    within it are kept.
    """
    # Distances are multiples of 1 / (n m): whole numbers compare exactly.
    gap = round(distance * n * m)
    if gap <= 0:
        return 1.0
    share, low = np.ones(1), 0
    for k in range(1, n + m + 1):
        first = max(0, k - m, (k * n - gap) // (n + m) + 1)
        last = min(n, k, -(-(k * n + gap) // (n + m)) - 1)
        if last < first:
            return 1.0
        i = np.arange(first, last + 1)
        around = np.r_[0.0, share, 0.0]
        share = (around[first - low : last - low + 1] * i + around[first - low + 1 : last - low + 2] * (k - i)) / k
        low = first
    return float(min(max(1.0 - share[0], 0.0), 1.0))


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else t_two_sided(a, b) for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_margin(level: pd.Series, dof: pd.Series) -> pd.Series:
    """Half-width multiplier of a two-sided interval at ``level``."""
    return pd.Series(
        [None if pd.isna(d) or d <= 0 else t_quantile(0.5 + p / 2.0, d) for p, d in zip(level, dof)], dtype="float64"
    )


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else gamma_upper(b / 2.0, a / 2.0) for a, b in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def ks_pvalue_exact(distance: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """The exact two-sided p-value; null for samples above ``EXACT_KS``, where the limiting law is used."""
    rows = zip(distance, n, m)
    return pd.Series(
        [None if pd.isna(d) or max(a, b) > EXACT_KS or not a or not b else ks_exact(d, int(a), int(b)) for d, a, b in rows],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def mann_whitney_pvalue(u: pd.Series, n: pd.Series, m: pd.Series, ties: pd.Series) -> pd.Series:
    """Two-sided. Exact when there are no ties and one side has at most ``EXACT_SIDE`` values, whatever the
    size of the other; else the tie- and continuity-corrected normal law."""

    def one(u1: float, a: float, b: float, tie: float) -> float | None:
        if pd.isna(u1) or a == 0 or b == 0:
            return None
        top = max(u1, a * b - u1)
        if min(a, b) <= EXACT_SIDE and tie == 0:
            return min(1.0, 2.0 * mann_whitney_exact(top, int(a), int(b)))
        total = a + b
        spread = math.sqrt(a * b / 12.0 * (total + 1.0 - tie / (total * (total - 1.0))))
        if spread == 0.0:
            return 1.0
        return min(1.0, 2.0 * 0.5 * math.erfc((top - a * b / 2.0 - 0.5) / spread / math.sqrt(2.0)))

    return pd.Series([one(*row) for row in zip(u, n, m, ties)], dtype="float64")
