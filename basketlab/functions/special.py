"""Special functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SERIES = 500  # terms of the lower series, and steps of the continued fraction
SMALL = 1e-300


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: a shift to x + 8 and Stirling's series (relative error below 1e-14)."""
    y = x + 8
    z = 1 / (y * y)
    shift = sum((F.log(x + k) for k in range(1, 8)), F.log(x))
    tail = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z * (1 / 1188 - z * (691 / 360360 - z / 156)))))) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - shift


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x) for a > 0 and x >= 0.

    Below a + 1 from the series of the lower function, from there on from the
    continued fraction (Lentz's method); ``SERIES`` steps suffice for a up to some ten thousands,
    where the two ranges meet after about sqrt(a) steps.
    """
    steps = F.sequence(F.lit(1), F.lit(SERIES))
    factor = F.exp(a * F.log(F.greatest(x, F.lit(SMALL))) - x - log_gamma(a))
    series = F.aggregate(steps, F.struct((1 / a).alias("term"), (1 / a).alias("sum")),
                         lambda s, k: F.struct((s["term"] * x / (a + k)).alias("term"), (s["sum"] + s["term"] * x / (a + k)).alias("sum")))["sum"]

    def away(v: Column) -> Column:
        return F.when(F.abs(v) < SMALL, SMALL).otherwise(v)

    def step(s: Column, k: Column) -> Column:
        part = -k * (k - a)
        b = x + 1 - a + 2 * k
        d = 1 / away(part * s["d"] + b)
        c = away(b + part / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = 1 / away(x + 1 - a)
    fraction = F.aggregate(steps, F.struct(F.lit(1 / SMALL).alias("c"), first.alias("d"), first.alias("h")), step)["h"]
    return F.when(x <= 0, 1.0).when(x < a + 1, F.greatest(1 - factor * series, F.lit(0.0))).otherwise(factor * fraction)


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """Probability that a chi-square variable with ``dof`` degrees of freedom is at least ``statistic``; 1 without any freedom."""
    return F.when(dof <= 0, 1.0).otherwise(upper_gamma(dof.cast("double") / 2, statistic.cast("double") / 2))
