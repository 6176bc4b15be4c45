"""W6-W11 numeric goldens (FIXTURES §5) and their window forms."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordtide.functions import stats as S
from wordtide.functions.beta import binomial_bounds
from wordtide.operators import weekly


def tail(k, n, p):
    """P(X >= k) of the binomial by ratios of neighbouring terms, normalised over 45 standard deviations."""
    sd = math.sqrt(n * p * (1 - p)) + 3
    lo, hi = max(0, int(n * p - 45 * sd)), min(n, int(n * p + 45 * sd))
    j = np.arange(lo, hi, dtype=float)
    w = np.concatenate(([0.0], np.cumsum(np.log((n - j) / (j + 1)) + math.log(p) - math.log1p(-p))))
    w = np.exp(w - w.max())
    return w[np.arange(lo, hi + 1) >= k].sum() / w.sum()


@pytest.mark.parametrize("n", [7, 400, 10 ** 5, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9, 10 ** 10])
def test_clopper_pearson_meets_its_definition(n):
    """P(X >= k | lower) = P(X <= k | upper) = alpha / 2, at every size."""
    ks = sorted({k for k in (1, 3, n // 10 ** 6, n // 999, n // 41, n // 9, n // 3, n // 2) if 0 < k < n})
    lower, upper = S.clopper_pearson(ks, [n] * len(ks))
    for k, a, b in zip(ks, lower, upper):
        assert 0 < a < k / n < b < 1
        assert tail(k, n, a) == pytest.approx(0.025, rel=1e-6)
        assert 1 - tail(k + 1, n, b) == pytest.approx(0.025, rel=1e-6)


def test_clopper_pearson_ends():
    lo, hi = S.clopper_pearson([0, 640, 0, 170_092_783], [640, 640, 2 * 10 ** 9, 2 * 10 ** 9])
    assert lo[0] == 0 and hi[1] == 1 and lo[2] == 0
    assert hi[0] == pytest.approx(1 - 0.025 ** (1 / 640), rel=1e-12) and lo[1] == pytest.approx(0.025 ** (1 / 640), rel=1e-12)
    assert hi[2] == pytest.approx(-math.expm1(math.log(0.025) / (2 * 10 ** 9)), rel=1e-9) and lo[3] < 170_092_783 / (2 * 10 ** 9) < hi[3]


def test_clopper_pearson_contains_rate_and_bounds():
    k = np.array([1, 5, 50, 99, 3])
    n = np.array([10, 10, 100, 100, 7])
    lo, hi = S.clopper_pearson(k, n)
    assert np.all(lo <= k / n) and np.all(k / n <= hi) and np.all(lo >= 0) and np.all(hi <= 1)


def test_clopper_pearson_empty_total_is_null(spark):
    df = spark.createDataFrame([(0, 0), (3, 10)], "post_hits int, total_posts int")
    got = {(r.post_hits, r.total_posts): (r.appearance_rate_ci_lower, r.appearance_rate_ci_upper)
           for r in weekly.with_binomial_ci(df).collect()}
    assert got[(0, 0)] == (None, None)
    assert got[(3, 10)][0] < 0.3 < got[(3, 10)][1]


@pytest.mark.parametrize("native", [False, True])
def test_interval_pairs_are_dealt_over_tasks(spark, tmp_path, native):
    # they are small enough for AQE to put all in one partition, which one worker solved alone
    df = spark.createDataFrame([(i, 100_000 + i % 7) for i in range(400)], "post_hits long, total_posts long")

    def keep(ci, name):
        ci.write.parquet(f"{tmp_path}/ci")
        return spark.read.parquet(f"{tmp_path}/ci")

    out = weekly.with_binomial_ci(df, materialize=keep, native=native)
    assert out.count() == 400 and out.where("appearance_rate_ci_lower IS NULL OR appearance_rate_ci_upper IS NULL").count() == 0
    assert len(list(tmp_path.glob("ci/*.parquet"))) >= spark.sparkContext.defaultParallelism


def test_interval_integrates_few_whole_tails(monkeypatch):
    # each is 12 panels; Newton from the mean took one per step, over 8 for a bound
    whole, tails = [], S._tail
    monkeypatch.setattr(S, "_tail", lambda a, *rest: whole.append(len(a)) or tails(a, *rest))
    k, n = np.arange(5_000, 15_000, 100), np.full(100, 150_000)
    lower, upper = S.clopper_pearson(k, n)
    assert sum(whole) <= 2 * 2 * len(k), whole
    assert np.allclose(S.betainc(k, n - k + 1, lower), 0.025, rtol=1e-12) and np.allclose(1 - S.betainc(k + 1, n - k, upper), 0.025, rtol=1e-10)


@pytest.mark.parametrize("df", [1, 2, 3, 4, 6, 11, 30, 101])
def test_t_tail_series_and_closed_form(spark, df):
    ts = [0.0, 1e-9, 0.3, 1.0, S.T_975_DF6, 10.0, 50.0, 1e4]
    rows = spark.createDataFrame([(t, df / (df + t * t)) for t in ts], "t double, x double").select("t", F.expr(S.t_tail_sql("x", df)).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(float(S.t_two_sided_p(r.t, df)), rel=1e-9, abs=1e-15)
    with pytest.raises(ValueError):
        S.t_tail_sql("x", 0)


def test_t_quantiles():
    assert S.t_quantile(0.95, 6) == pytest.approx(S.T_975_DF6, rel=1e-15)
    assert S.t_quantile(0.95, 1) == pytest.approx(math.tan(0.475 * math.pi), rel=1e-13)
    assert S.t_quantile(0.5, 2) == pytest.approx(math.sqrt(2 / 3), rel=1e-14)  # p = t / sqrt(2 + t^2)
    for df in (1, 2, 3, 5, 10, 40, 200):
        for central in (0.0, 0.1, 0.9, 0.99, 0.9999):
            t = S.t_quantile(central, df)
            assert float(S.t_two_sided_p(t, df)) == pytest.approx(1 - central, rel=1e-10)


@pytest.mark.parametrize("points", [3, 4, 5, 13])
def test_regression_of_any_length(spark, points):
    rng = np.random.default_rng(points)
    rates = (0.2 + 0.01 * np.arange(points + 2) + rng.normal(0, 0.02, points + 2)).tolist()
    out = weekly.with_regression(_weeks(spark, rates), points=points).orderBy("i").collect()
    assert [r.has_regression for r in out] == [i >= points - 1 for i in range(points + 2)]
    for r in out[points - 1:]:
        x, y = np.arange(points), np.array(rates[r.i - points + 1:r.i + 1])
        slope, intercept = np.polyfit(x, y, 1)
        rest = y - intercept - slope * x
        se_b = math.sqrt((rest ** 2).sum() / (points - 2) / ((x - x.mean()) ** 2).sum())
        assert r.slope == pytest.approx(slope, rel=1e-8) and r.intercept == pytest.approx(intercept, rel=1e-8)
        assert r.p_value == pytest.approx(float(S.t_two_sided_p(slope / se_b, points - 2)), rel=1e-7)
        assert float(S.t_two_sided_p((r.slope_ci_upper - r.slope) / se_b, points - 2)) == pytest.approx(0.05, rel=1e-7)
        assert str(r.analysis_end_date - r.analysis_start_date).startswith(f"{7 * points - 1} days")
    with pytest.raises(ValueError):
        weekly.with_regression(_weeks(spark, rates), points=2)


def _weeks(spark, rates, board="b", term=1, start="2024-01-01"):
    rows = [(board, term, i, r) for i, r in enumerate(rates)]
    df = spark.createDataFrame(rows, "board_key string, term_id long, i int, appearance_rate double")
    return df.withColumn("week_start_date", F.date_add(F.lit(start).cast("date"), F.col("i") * 7))


def test_zscore_goldens(spark):
    hist = [0.31, 0.28, 0.35, 0.3, 0.29, 0.33, 0.27]
    for cur in (0.41, 0.22):
        z = (cur - statistics.mean(hist)) / statistics.stdev(hist)
        out = weekly.with_zscore(_weeks(spark, hist + [cur])).orderBy("i").collect()
        assert out[-1].zscore == pytest.approx(z, abs=1e-9)
        assert all(r.zscore is None for r in out[:7])


def test_zscore_flat_history_is_zero_and_gap_is_null(spark):
    out = weekly.with_zscore(_weeks(spark, [0.1] * 8)).orderBy("i").collect()
    assert out[-1].zscore == 0.0
    # A missing week leaves only 6 history points in the 49-day frame.
    df = _weeks(spark, [0.31, 0.28, 0.35, 0.3, 0.29, 0.33, 0.27, 0.4, 0.5]).where("i != 3")
    out = weekly.with_zscore(df).orderBy("i").collect()
    assert out[-1].zscore is None


def test_regression_goldens(spark):
    rates = [0.42, 0.37, 0.45, 0.5, 0.44, 0.52, 0.61, 0.55]
    out = weekly.with_regression(_weeks(spark, rates)).orderBy("i").collect()
    r = out[-1]
    assert r.has_regression and not any(x.has_regression for x in out[:-1])
    x = np.arange(8.0)
    slope, intercept = np.polyfit(x, rates, 1)
    rest = np.array(rates) - intercept - slope * x
    s2 = (rest ** 2).sum() / 6
    se_b, se_a = math.sqrt(s2 / 42), math.sqrt(s2 * (1 / 8 + 3.5 ** 2 / 42))
    assert r.slope == pytest.approx(slope, rel=1e-9) and r.intercept == pytest.approx(intercept, rel=1e-9)
    # 97.5 % quantile of t with 6 degrees of freedom, by bisection on the numerically integrated density
    grid = np.linspace(0, 60, 600_001)
    density = math.gamma(3.5) / (math.sqrt(6 * math.pi) * math.gamma(3)) * (1 + grid ** 2 / 6) ** -3.5
    area = np.concatenate(([0], np.cumsum((density[1:] + density[:-1]) / 2 * 1e-4)))
    q = np.interp(0.475, area, grid)
    assert r.slope_ci_lower == pytest.approx(slope - q * se_b, abs=1e-8) and r.slope_ci_upper == pytest.approx(slope + q * se_b, abs=1e-8)
    assert r.intercept_ci_lower == pytest.approx(intercept - q * se_a, abs=1e-8) and r.intercept_ci_upper == pytest.approx(intercept + q * se_a, abs=1e-8)
    assert r.r_squared == pytest.approx(1 - (rest ** 2).sum() / np.var(rates) / 8, rel=1e-9)
    assert r.p_value == pytest.approx(1 - 2 * np.interp(abs(slope) / se_b, grid, area), abs=1e-7)
    assert str(r.analysis_start_date) == "2024-01-01" and str(r.analysis_end_date) == "2024-02-25"


def test_regression_exact_and_flat_lines(spark):
    down = weekly.with_regression(_weeks(spark, [0.18 - 0.01 * i for i in range(8)])).orderBy("i").collect()[-1]
    assert down.slope == pytest.approx(-0.01, abs=1e-12)
    flat = weekly.with_regression(_weeks(spark, [0.1] * 8)).orderBy("i").collect()[-1]
    assert flat.slope == pytest.approx(0.0, abs=1e-15) and flat.p_value is None and flat.r_squared is None


def test_regression_needs_eight_consecutive_weeks(spark):
    df = _weeks(spark, [0.1 + 0.01 * i for i in range(9)]).where("i != 2")
    out = weekly.with_regression(df).orderBy("i").collect()
    assert [r.i for r in out if r.has_regression] == []
    assert math.isfinite(out[-1].appearance_rate)


def test_native_interval_equals_the_kernel(spark):
    pairs = [(k, n) for n in (1, 2, 3, 7, 20, 100) for k in range(n + 1)] + [(0, 1000), (1, 1000), (500, 1000), (999, 1000), (3, 10 ** 5), (50_000, 10 ** 5),
             (12, 10 ** 6), (999_990, 10 ** 6), (500_000, 10 ** 6), (1500, 10 ** 6), (2500, 10 ** 6), (7, 10 ** 10)]
    bad = [(0, 0), (-1, 5), (6, 5), (None, 5), (2, None), (1, -3)]
    for alpha in (0.05, 0.001):
        df = spark.createDataFrame(pairs + bad, "k long, n long").repartition(8)
        out = {(r.k, r.n): r for r in binomial_bounds(df, "k", "n", alpha).collect()}
        lo, hi = S.clopper_pearson([k for k, _ in pairs], [n for _, n in pairs], alpha)
        for p, a, b in zip(pairs, lo, hi):
            assert out[p].lower == pytest.approx(a, rel=1e-11, abs=1e-300) and out[p].upper == pytest.approx(b, rel=1e-11), p
        assert all((out[p].lower, out[p].upper) == (None, None) for p in bad)


def test_interval_has_no_python_node(spark):
    df = spark.createDataFrame([(1, 5)], "post_hits long, total_posts long")
    plan = weekly.with_binomial_ci(df, native=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
