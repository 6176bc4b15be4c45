"""Exact binomial intervals (W6) as column expressions, without a Python worker.

The lower bound solves P(X >= k; n, p) = alpha / 2 for p, the upper bound is one less the lower bound of n - k. The tail is the
probability of k times a sum of ratios of neighbouring terms, which fall from k on for p < k / n; both the
sum and Newton's steps are ``aggregate`` over short sequences. The probability of k is in saddle-point form
(deviances and Stirling remainders, no difference of large log-gammas), accurate at any n.
"""

from __future__ import annotations

import math
from statistics import NormalDist
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions.stats import DEFAULT_ALPHA, STIRLING

NEWTON_STEPS = 40
EPS = 4e-15
_SMALL = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _horner(coefficients, x: Column) -> Column:
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = F.lit(float(c)) + x * out
    return out


def stirling_rest(n: Column) -> Column:
    """log(n!) - log(sqrt(2 pi n) (n/e)^n) for whole n >= 1."""
    small = F.array(*[F.lit(math.lgamma(v + 1) - (v + 0.5) * math.log(v) + v - 0.5 * math.log(2 * math.pi) if v else 0.0) for v in range(_SMALL)])
    return F.when(n < _SMALL, F.get(small, n.cast("int"))).otherwise(_horner(STIRLING, 1 / (n * n)) / n)


def deviance(x: Column, m: Column) -> Column:
    """x log(x/m) + m - x, without cancellation where x is near m."""
    def at(d):
        near = lambda d2: (x - m) * d + 2 * x * d * d2 * _horner([1 / k for k in range(3, 19, 2)], d2)
        return F.when(F.abs(d) < 0.02, let(d * d, near)).otherwise(x * F.log(x / m) + m - x)
    return let((x - m) / (x + m), at)


def binomial_bounds(df: DataFrame, k: str, n: str, alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """``df`` with ``lower`` and ``upper``, the Clopper-Pearson interval; NULL where n <= 0 or k lies outside [0, n].

    Meant for distinct (k, n).
    """
    z, half = NormalDist().inv_cdf(1 - alpha / 2), alpha / 2
    names = df.columns
    ok = (F.col(n) > 0) & F.col(k).between(0, F.col(n))
    df = df.select(*names, F.when(ok, F.col(n)).cast("double").alias("_m"), F.when(ok, F.col(k)).cast("double").alias("_a")).withColumn("_b", F.col("_m") - F.col("_a"))
    m = F.col("_m")

    def facts(c: str, tag: str):
        """What does not change from step to step, for k in column ``c``: the constant of log P(X = k), a start, the length of the sum."""
        x = F.col(c)
        inside = (x > 0) & (x < m)
        const = stirling_rest(m) - stirling_rest(x) - stirling_rest(m - x) + 0.5 * F.log(m / (2 * math.pi * x * (m - x)))
        near = (x - 0.5 + z * z / 2 - z * F.sqrt((x - 0.5) * (m - x + 0.5) / m + z * z / 4)) / (m + z * z)  # score interval
        length = F.least(m - x, 60 + 10 * F.sqrt(x * (m - x) / m + 1))
        return [F.when(inside, const).alias(f"_const{tag}"), F.when(inside, F.greatest(near, x / m * 0.01)).alias(f"_start{tag}"),
                F.when(inside, F.sequence(F.lit(0), F.floor(length).cast("int"))).alias(f"_terms{tag}")]

    df = df.select("*", *facts("_a", "1"), *facts("_b", "2"))

    def lower(c: str, tag: str) -> Column:
        x, terms = F.col(c), F.col(f"_terms{tag}")

        def ratios(odds):
            """1 + P(k+1)/P(k) + P(k+2)/P(k) + ..."""
            def add(s, i):
                r = s["t"] * (m - x - i) / (x + 1 + i) * odds
                return F.when(s["t"] > 1e-18 * s["s"], F.struct(r.alias("t"), (s["s"] + r).alias("s"))).otherwise(s)
            return F.aggregate(terms, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), add)["s"]

        def step(s, _):
            p = s["p"]
            prob = F.exp(F.col(f"_const{tag}") - deviance(x, m * p) - deviance(m - x, m * (1 - p)))
            # log P(X >= k) is almost straight in log p, with slope k P(X = k) / P(X >= k) = k / sum of ratios
            missed = let(F.struct(prob.alias("q"), ratios(p / (1 - p)).alias("s")), lambda v: F.struct(
                (v["q"] * v["s"] - half).alias("f"), (p * F.exp(-v["s"] / x * F.log(v["q"] * v["s"] / half))).alias("p")))

            def moved(v):
                lo, hi = F.when(v["f"] < 0, p).otherwise(s["lo"]), F.when(v["f"] < 0, s["hi"]).otherwise(p)
                return let(F.struct(lo.alias("lo"), hi.alias("hi"), v["p"].alias("p")), lambda t: let(
                    F.when((F.abs(t["p"] - p) <= EPS * p) | (t["p"] > t["lo"]) & (t["p"] < t["hi"]), t["p"]).otherwise((t["lo"] + t["hi"]) / 2),
                    lambda y: F.struct(t["lo"].alias("lo"), t["hi"].alias("hi"), y.alias("p"), (F.abs(y - p) <= EPS * p).alias("done"))))

            return F.when(s["done"], s).otherwise(let(missed, moved))

        zero = F.struct(F.lit(0.0).alias("lo"), (x / m).alias("hi"), F.col(f"_start{tag}").alias("p"), F.lit(False).alias("done"))
        solved = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), zero, step)["p"]
        return F.when(x == 0, 0.0).when(x == m, F.pow(F.lit(half), 1 / m)).when(x.isNotNull(), solved)

    return df.select(*names, lower("_a", "1").alias("lower"), (1 - lower("_b", "2")).alias("upper"))
