"""Tails of the binomial distribution as column functions: the regularised incomplete beta function by its continued fraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos' coefficients for g = 7.
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]
STEPS = 200


def ln_gamma(x: Column) -> Column:
    """The logarithm of the gamma function, x from 0.5 on."""
    y = x - 1
    series = reduce(lambda a, kv: a + F.lit(kv[1]) / (y + kv[0]), list(enumerate(LANCZOS))[1:], F.lit(LANCZOS[0]))
    t = y + 7.5
    return F.lit(0.9189385332046727) + (y + 0.5) * F.ln(t) - t + F.ln(series)  # half the logarithm of two pi


def _fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction by Lentz's rule."""
    tiny = 1e-300
    away = lambda v: F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    def part(s: Column, by: Column) -> Column:
        d = 1 / away(1 + by * s["d"])
        c = away(1 + by / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # each half once: a lambda's argument is worked out before it is used
        return F.get(F.transform(F.array(part(s, even)), lambda t: part(t, odd)), F.lit(0))

    first = 1 / away(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["h"])


def beta_share(a: Column, b: Column, x: Column, steps: int = STEPS) -> Column:
    """The regularised incomplete beta function of a, b > 0 at x in 0..1; null outside. Steps needed grow with the root of the larger of a and b: 200 do to some 10,000."""
    a, b, x = a.cast("double"), b.cast("double"), x.cast("double")
    front = F.exp(ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b) + a * F.ln(x) + b * F.ln(1 - x))
    inside = F.when(x < (a + 1) / (a + b + 2), front * _fraction(a, b, x, steps) / a).otherwise(1 - front * _fraction(b, a, 1 - x, steps) / b)
    return F.when(x == 0, 0.0).when(x == 1, 1.0).when((x > 0) & (x < 1) & (a > 0) & (b > 0), inside)


def binomial_upper(k: Column, n: Column, p: Column) -> Column:
    """The chance of k and more of n, each having chance p."""
    return F.when(k <= 0, 1.0).when(k > n, 0.0).otherwise(beta_share(k, n - k + 1, p))


def binomial_lower(k: Column, n: Column, p: Column) -> Column:
    """The chance of k and fewer of n, each having chance p."""
    return F.when(k < 0, 0.0).when(k >= n, 1.0).otherwise(beta_share(n - k, k + 1, 1 - p))
