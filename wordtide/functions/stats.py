"""Statistics: exact binomial interval (W6), z-score (W7), OLS inference.

z-score and regression inference are plain column arithmetic over window
aggregates (``regr_*``, ``stddev_samp``).  The Clopper-Pearson interval needs the
inverse regularised incomplete beta function, which Spark lacks: it is a small
vectorised numpy kernel behind an Arrow UDF, applied to *distinct* (k, n) pairs.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values ------------------------------------------------------------
DEFAULT_ALPHA = 0.05
# z-score needs this many history weeks; a sd below the epsilon gives z = 0.
ZSCORE_MIN_HISTORY = 7
ZSCORE_SD_EPSILON = 1e-10
# The stored regression needs exactly this many weekly points (x = 0..7).
REGRESSION_POINTS = 8
# 97.5 % quantile of Student's t with 6 degrees of freedom (8 points - 2).
T_975_DF6 = 2.4469118511449692
# -----------------------------------------------------------------------------

# ---------------------------------------------------------------- z-score


def zscore(current: Column, n_hist: Column, mean_hist: Column, sd_hist: Column) -> Column:
    """z of the current rate against the history: NULL below 7 points, 0 when sd ~ 0."""
    return (F.when(n_hist < ZSCORE_MIN_HISTORY, F.lit(None).cast("double"))
            .when(sd_hist < ZSCORE_SD_EPSILON, F.lit(0.0))
            .otherwise((current - mean_hist) / sd_hist))


# ------------------------------------------------- OLS inference


def _central_weights(df: int) -> list[float]:
    """u_0, u_1, ...: P(|T| <= t) for t = sqrt(df) tan(theta) is, with x = cos(theta)^2,

    for even df  sin(theta) (u_0 + u_1 x + ...)                                 of df / 2 terms, u_j = u_(j-1) (2j - 1) / (2j);
    for odd df   2 / pi (theta + sin(theta) cos(theta) (u_0 + u_1 x + ...))     of (df - 1) / 2 terms, u_j = u_(j-1) (2j) / (2j + 1).
    """
    out = []
    for j in range(df // 2):
        out.append(out[-1] * ((2 * j) / (2 * j + 1) if df % 2 else (2 * j - 1) / (2 * j)) if j else 1.0)
    return out


def t_central(t: float, df: int) -> float:
    """P(|T| <= t) of Student's t with a whole number of degrees of freedom, t >= 0."""
    theta = math.atan2(t, math.sqrt(df))
    x, total = math.cos(theta) ** 2, 0.0
    for u in reversed(_central_weights(df)):
        total = total * x + u
    return 2 / math.pi * (theta + math.sin(theta) * math.cos(theta) * total) if df % 2 else math.sin(theta) * total


def t_quantile(central: float, df: int) -> float:
    """t with P(|T| <= t) = ``central``: Newton from 0, where the concave distribution keeps every step short of the root."""
    if df < 1 or not 0 <= central < 1:
        raise ValueError("needs df >= 1 and a probability below 1")
    front = 2 * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    t = 0.0
    for _ in range(10_000):
        step = (central - t_central(t, df)) / (front * (1 + t * t / df) ** (-(df + 1) / 2))
        if step <= 1e-15 * t:
            break
        t += step
    return t


#: The tail series below this x, with so many terms; the closed form above, where the tail is not small.
TAIL_SERIES_BELOW, TAIL_TERMS = 0.6, 90


def _horner(coefficients: list[float], x: str) -> str:
    out = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({c!r} + {x} * {out})"
    return out


def t_tail_sql(x: str, df: int) -> str:
    """Two-sided p-value of Student's t as a SQL expression of x = df / (df + t^2), for Spark and DuckDB.

    p = I_x(df/2, 1/2). The closed form (a finite sum, see ``_central_weights``) cancels for small x; there the
    series x^a / B(a, 1/2) * sum c_k x^k / (a + k), a = df/2, c_k = C(2k, k) / 4^k, has positive terms only.
    """
    if df < 1:
        raise ValueError("Student's t needs at least one degree of freedom")
    a, c, terms = df / 2, 1.0, []
    front = math.exp(math.lgamma(a + 0.5) - math.lgamma(a)) / math.sqrt(math.pi)
    for k in range(TAIL_TERMS):
        terms.append(front * c / (a + k))
        c *= (2 * k + 1) / (2 * k + 2)
    series = f"(power({x}, {a!r}) * {_horner(terms, x)})"
    weights = _central_weights(df)
    poly = _horner(weights, x) if weights else "0.0"
    if df % 2:
        closed = f"(1.0 - {2 / math.pi!r} * (asin(sqrt(1.0 - {x})) + sqrt({x} * (1.0 - {x})) * {poly}))"
    else:
        closed = f"(1.0 - sqrt(1.0 - {x}) * {poly})"
    return f"(CASE WHEN {x} < {TAIL_SERIES_BELOW} THEN {series} ELSE {closed} END)"


def regression_sql(points: int, slope: str, ybar: str, sxx: str, sxy: str, syy: str, alpha: float = DEFAULT_ALPHA) -> dict[str, str]:
    """OLS on x = 0..points-1 from window aggregates, as SQL expressions (Spark and DuckDB).

    x is regressed in absolute week numbers; slope and the sums of squares do not
    depend on the origin, and the intercept at x = 0 of the frame is
    ybar - slope * (points - 1) / 2.  The t quantile of points - 2 degrees of freedom is a literal; ``t_x`` is the
    argument of the tail (``t_tail_sql``), to be kept as a column of that name.  A zero residual variance
    gives p = 0 for a non-zero slope and NULL (not NaN) for a flat series.
    """
    df = points - 2
    if df < 1:
        raise ValueError("a regression with intervals needs at least 3 points")
    quantile = T_975_DF6 if (df, alpha) == (6, DEFAULT_ALPHA) else t_quantile(1 - alpha, df)
    # what is left of the difference below 1e-14 of the sum of squares is rounding: the points lie on a line
    rest = f"({syy} - {sxy} * {sxy} / {sxx})"
    s2 = f"(CASE WHEN {rest} <= 1e-14 * {syy} THEN 0.0 ELSE {rest} / {df}.0 END)"
    se_b = f"sqrt({s2} / {sxx})"
    xbar = (points - 1) / 2.0
    se_a = f"sqrt({s2} * ({1 / points!r} + {xbar * xbar!r} / {sxx}))"  # no quotient of decimal literals
    intercept = f"({ybar} - {slope} * {xbar!r})"
    return {
        "intercept": intercept,
        "slope": slope,
        "intercept_ci_lower": f"({intercept} - {quantile!r} * {se_a})",
        "intercept_ci_upper": f"({intercept} + {quantile!r} * {se_a})",
        "slope_ci_lower": f"({slope} - {quantile!r} * {se_b})",
        "slope_ci_upper": f"({slope} + {quantile!r} * {se_b})",
        # df / (df + t^2) with t = slope / se_b; 0 where the residuals vanish, NULL for a flat series
        "t_x": f"({df}.0 * {s2} / nullif({df}.0 * {s2} + {slope} * {slope} * {sxx}, 0.0))",
        "p_value": f"(CASE WHEN {sxx} <= 0 OR ({s2} = 0 AND {slope} = 0) THEN NULL ELSE least(greatest({t_tail_sql('t_x', df)}, 0.0), 1.0) END)",
        "r_squared": f"(CASE WHEN {syy} = 0 OR {sxx} = 0 THEN NULL ELSE {sxy} * {sxy} / ({sxx} * {syy}) END)",
    }


# ------------------------------------------- incomplete beta kernel (numpy)
#
# The density is evaluated in saddle-point form: deviances and Stirling remainders, no difference of
# large log-gammas, so it is as accurate at n = 10^10 as at n = 10. Integrals use a continued fraction while the
# smaller parameter is below QUADRATURE_FROM (its length grows with the root of that parameter) and
# Gauss-Legendre panels of one standard deviation beyond. Every loop ends on convergence and drops the elements
# that have converged; an element that does not converge within LOOP_LIMIT becomes NaN (NULL in the table).

QUADRATURE_FROM = 2000.0
LOOP_LIMIT = 100_000
CF_EPS = 4e-15
# Panels beyond this many standard deviations add less than 1e-30.
PANELS = 12
# Newton steps this many standard deviations around a known tail take the integral between, a single panel.
NEAR = 0.25
_GL_X, _GL_W = np.polynomial.legendre.leggauss(20)
# Coefficients of the Stirling series 1/(12 n) - 1/(360 n^3) + 1/(1260 n^5) - ...
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156)
_HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def _stirling_rest(n: np.ndarray) -> np.ndarray:
    """log(n!) - log(sqrt(2 pi n) (n/e)^n) for n > 0."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 16.0)
    series = sum(c / big ** (2 * i + 1) for i, c in enumerate(STIRLING))
    small = np.frompyfunc(lambda v: math.lgamma(v + 1) - (v + 0.5) * math.log(v) + v - _HALF_LOG_2PI, 1, 1)
    out = np.array(series, dtype=float)
    low = n < 16
    if low.any():
        out[low] = small(n[low]).astype(float)
    return out


def _deviance(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """x log(x/m) + m - x, without cancellation where x is near m."""
    x, m = np.broadcast_arrays(np.asarray(x, float), np.asarray(m, float))
    d = (x - m) / (x + m)
    near = np.abs(d) < 0.1
    with np.errstate(divide="ignore", invalid="ignore"):
        plain = x * np.log(x / m) + m - x
    # x = (1+d)/(1-d) m: 2 x (d^3/3 + d^5/5 + ...) + (x - m) d
    d2 = np.where(near, d * d, 0.0)
    s, p = np.zeros_like(d), d2.copy()
    for k in range(3, 31, 2):
        s = s + p / k
        p = p * d2
    return np.where(near, (x - m) * d + 2 * x * d * s, plain)


def beta_log_density(a, b, x) -> np.ndarray:
    """log of the Beta(a, b) density at 0 < x < 1, for a, b > 0."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    # density = C * x^a (1-x)^b with the binomial form at k = a, n = a + b: shifts by x (1 - x) are exact
    n = a + b
    log_binom = (_stirling_rest(n) - _stirling_rest(a) - _stirling_rest(b) - _deviance(a, n * x) - _deviance(b, n * (1 - x))
                 + 0.5 * np.log(n / (2 * math.pi * a * b)))
    return log_binom + np.log(a) + np.log(b) - np.log(n) - np.log(x) - np.log1p(-x)


def _continued_fraction(a, b, x) -> np.ndarray:
    """Continued fraction of I_x(a, b) by the modified Lentz method; NaN where it does not converge."""
    tiny = 1e-300
    out = np.full(x.shape, np.nan)
    idx = np.arange(x.size)
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, LOOP_LIMIT):
        for aa in (m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m)),
                   -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))):
            d = 1.0 + aa * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + aa / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            delta = d * c
            h = h * delta
        done = np.abs(delta - 1.0) < CF_EPS
        if done.any():
            out[idx[done]] = h[done]
            keep = ~done
            if not keep.any():
                break
            idx, a, b, x, c, d, h = (v[keep] for v in (idx, a, b, x, c, d, h))
    return out


def _tail(a, b, x, upper) -> np.ndarray:
    """Integral of the Beta(a, b) density from x outwards: above x where ``upper``, else below."""
    sd = np.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    sign = np.where(upper, 1.0, -1.0)
    total = np.zeros_like(x)
    for k in range(PANELS):
        lo = np.clip(x + sign * k * sd, 0.0, 1.0)
        hi = np.clip(x + sign * (k + 1) * sd, 0.0, 1.0)
        half = (hi - lo) / 2
        t = (lo + hi)[:, None] / 2 + half[:, None] * _GL_X
        t = np.clip(t, 1e-300, 1 - 1e-16)
        total += np.abs(half) * (np.exp(beta_log_density(a[:, None], b[:, None], t)) @ _GL_W)
    return total


def beta_tails(a, b, x) -> tuple[np.ndarray, np.ndarray]:
    """(I_x(a, b), 1 - I_x(a, b)) for a, b > 0 and 0 <= x <= 1; the smaller of the two is computed, not subtracted."""
    a, b, x = (np.array(v, dtype=float) for v in np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float)))
    low, high = np.where(x <= 0, 0.0, 1.0), np.where(x <= 0, 1.0, 0.0)
    shape = x.shape
    a, b, x, low, high = (v.reshape(-1) for v in (a, b, x, low, high))
    mid = (x > 0) & (x < 1)
    upper = x > a / (a + b)
    wide = mid & (np.minimum(a, b) >= QUADRATURE_FROM)
    slim = mid & ~wide
    part = np.zeros_like(x)
    if wide.any():
        part[wide] = _tail(a[wide], b[wide], x[wide], upper[wide])
    if slim.any():
        s, u = slim, upper[slim]
        p, q, z = np.where(u, b[s], a[s]), np.where(u, a[s], b[s]), np.where(u, 1 - x[s], x[s])
        front = np.exp(beta_log_density(a[s], b[s], x[s])) * x[s] * (1 - x[s])
        part[s] = front * _continued_fraction(p, q, z) / p
    low[mid] = np.where(upper, 1 - part, part)[mid]
    high[mid] = np.where(upper, part, 1 - part)[mid]
    return low.reshape(shape), high.reshape(shape)


def betainc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b)."""
    return beta_tails(a, b, x)[0]


def _between(a, b, start, end) -> np.ndarray:
    """Integral of the Beta(a, b) density from start to end, a part of a standard deviation, with its sign."""
    half = (end - start) / 2
    t = (start + end)[:, None] / 2 + half[:, None] * _GL_X
    return half * (np.exp(beta_log_density(a[:, None], b[:, None], t)) @ _GL_W)


def _first_guess(p, a, b) -> np.ndarray:
    """The quantile by the normal distribution corrected for skewness, or the mean where that lies outside (0, 1)."""
    mean, n = a / (a + b), a + b
    sd = np.sqrt(a * b / (n * n * (n + 1)))
    levels, at = np.unique(p, return_inverse=True)
    z = np.array([NormalDist().inv_cdf(v) if 0 < v < 1 else 0.0 for v in levels])[at]
    skew = 2 * (b - a) * np.sqrt(n + 1) / ((n + 2) * np.sqrt(a * b))
    x = mean + sd * (z + skew * (z * z - 1) / 6)
    return np.where((x > 0) & (x < 1), x, mean)


def beta_ppf(p, a, b) -> np.ndarray:
    """Inverse of I_x(a, b) in x: Newton steps on the density inside a shrinking bracket.

    Stops when a step no longer moves x; NaN where LOOP_LIMIT steps did not get there (the bracket at least
    halves whenever Newton leaves it, so this does not happen for finite parameters). Where tails are integrated
    (QUADRATURE_FROM), a step within NEAR standard deviations of the last whole tail adds the integral between the two.
    """
    p, a, b = (np.array(v, dtype=float).reshape(-1) for v in np.broadcast_arrays(np.asarray(p, float), np.asarray(a, float), np.asarray(b, float)))
    lo, hi, x = np.zeros_like(p), np.ones_like(p), _first_guess(p, a, b)
    reach = np.where(np.minimum(a, b) >= QUADRATURE_FROM, NEAR * np.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))), -1.0)
    out, idx = np.full(p.shape, np.nan), np.arange(p.size)
    at, at_low, at_high = np.full(p.shape, np.inf), np.zeros_like(p), np.zeros_like(p)
    for _ in range(1200):
        far = np.abs(x - at) > reach
        if far.any():
            at[far] = x[far]
            at_low[far], at_high[far] = beta_tails(a[far], b[far], x[far])
        low, high = at_low.copy(), at_high.copy()
        moved = x != at
        if moved.any():
            part = _between(a[moved], b[moved], at[moved], x[moved])
            low[moved] += part
            high[moved] -= part
        f = np.where(p < 0.5, low - p, (1 - p) - high)
        lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
        with np.errstate(all="ignore"):
            step = f * np.exp(-beta_log_density(a, b, x))
            new = x - step
        outside = ~np.isfinite(new) | (new <= lo) | (new >= hi)
        new = np.where(outside, 0.5 * (lo + hi), new)
        done = (np.abs(new - x) <= 1e-15 * x) | (hi - lo <= 1e-15 * x) | ~np.isfinite(f)
        x = new
        if done.any():
            out[idx[done]] = np.where(np.isfinite(f[done]), x[done], np.nan)
            keep = ~done
            if not keep.any():
                break
            idx, p, a, b, lo, hi, x, reach, at, at_low, at_high = (v[keep] for v in (idx, p, a, b, lo, hi, x, reach, at, at_low, at_high))
    return out


def clopper_pearson(k, n, alpha: float = DEFAULT_ALPHA):
    """Exact two-sided binomial interval; (nan, nan) where n <= 0 or k outside [0, n]."""
    k = np.asarray(k, float)
    n = np.asarray(n, float)
    lower = np.full(k.shape, np.nan)
    upper = np.full(k.shape, np.nan)
    ok = (n > 0) & (k >= 0) & (k <= n)
    if ok.any():
        kk, nn = k[ok], n[ok]
        lo = np.zeros_like(kk)
        up = np.ones_like(kk)
        has_lo = kk > 0
        if has_lo.any():
            lo[has_lo] = beta_ppf(alpha / 2.0, kk[has_lo], nn[has_lo] - kk[has_lo] + 1.0)
        has_up = kk < nn
        if has_up.any():
            up[has_up] = beta_ppf(1.0 - alpha / 2.0, kk[has_up] + 1.0, nn[has_up] - kk[has_up])
        lower[ok], upper[ok] = lo, up
    return lower, upper


def t_two_sided_p(t, df) -> np.ndarray:
    """Two-sided p-value of Student's t for any df: I_{df/(df+t^2)}(df/2, 1/2)."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    return betainc(df / 2.0, np.full_like(df, 0.5), df / (df + t * t))


CI_TYPE = T.StructType([T.StructField("lower", T.DoubleType()),
                        T.StructField("upper", T.DoubleType())])


def binomial_ci_udf(alpha: float = DEFAULT_ALPHA):
    """Arrow UDF (k, n) -> struct<lower, upper>; NULL fields where n = 0."""

    @F.pandas_udf(CI_TYPE)
    def _ci(k: pd.Series, n: pd.Series) -> pd.DataFrame:
        lo, up = clopper_pearson(k.to_numpy(dtype=float, na_value=np.nan),
                                 n.to_numpy(dtype=float, na_value=np.nan), alpha)
        return pd.DataFrame({"lower": np.where(np.isnan(lo), None, lo),
                             "upper": np.where(np.isnan(up), None, up)})

    return _ci
