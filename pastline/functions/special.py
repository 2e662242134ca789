"""Small numeric helpers that run on the driver over bounded inputs
(a d x d matrix, a quantile of a known distribution, a signed-rank tail).
No scipy is available, so these are written out from the textbook
definitions."""

from __future__ import annotations

import math


def _gammainc_lower_reg(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x) (series / continued fraction)."""
    if x <= 0:
        return 0.0
    gln = math.lgamma(a)
    if x < a + 1:
        term = s = 1.0 / a
        ap = a
        for _ in range(10000):
            ap += 1
            term *= x / ap
            s += term
            if abs(term) < abs(s) * 1e-16:
                break
        return s * math.exp(-x + a * math.log(x) - gln)
    # Lentz continued fraction for Q(a, x)
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-16:
            break
    return 1.0 - math.exp(-x + a * math.log(x) - gln) * h


def chi2_cdf(x: float, df: int) -> float:
    return _gammainc_lower_reg(df / 2.0, x / 2.0)


def chi2_ppf(q: float, df: int) -> float:
    """Quantile of the chi-square distribution by bisection."""
    lo, hi = 0.0, max(1.0, df)
    while chi2_cdf(hi, df) < q:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if chi2_cdf(mid, df) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def signed_rank_upper_tail(w: float, n: int) -> float:
    """Exact P(W+ >= w) for the Wilcoxon signed-rank statistic with n pairs
    and no ties (counts of subsets of 1..n by rank sum)."""
    total = n * (n + 1) // 2
    counts = [0] * (total + 1)
    counts[0] = 1
    for r in range(1, n + 1):
        for s in range(total, r - 1, -1):
            counts[s] += counts[s - r]
    k = math.ceil(w - 1e-9)
    return sum(counts[max(k, 0):]) / float(2 ** n)


def elbow_index(cum: list[float]) -> int:
    """0-based index of the point farthest from the straight line between the
    ends of a curve; the first of equals, 0 for a curve without ends."""
    if len(cum) < 2:
        return 0
    # the distance from a line grows with the height over it, so heights decide
    rise = (cum[-1] - cum[0]) / (len(cum) - 1)
    heights = [abs(y - cum[0] - rise * i) for i, y in enumerate(cum)]
    return heights.index(max(heights))
