import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arearisk.operators import models as M

COUNTRIES = ["England", "Scotland", "Wales"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    n = 240
    x, u, c = rng.uniform(0, 1, n), rng.uniform(0, 1, n), rng.integers(0, 3, n)
    y = 60 - 5 * x + c + 2 * x * (c == 1) + rng.normal(0, 1.5, n)
    k = rng.negative_binomial(2, 2 / (2 + np.exp(0.5 + 0.8 * x)))
    return x, u, c, y, k


@pytest.fixture(scope="module")
def frame(spark, data):
    x, u, c, y, k = data
    rows = [(COUNTRIES[b], float(a), float(v), float(d), int(e)) for a, v, b, d, e in zip(x, u, c, y, k)]
    return spark.createDataFrame(rows + [("Wales", None, 0.1, 3.0, 1)], "country string, x double, u double, y double, k int")


def design(data, three=False):
    x, u, c, *_ = data
    d1, d2 = (c == 1).astype(float), (c == 2).astype(float)
    if three:
        parts = [x, u, x * u]
        return np.column_stack([np.ones_like(x), *parts, d1, d2, *[p * d for p in parts for d in (d1, d2)]])
    return np.column_stack([np.ones_like(x), x, d1, d2, x * d1, x * d2])


def terms(frame, three=False):
    base = M.crossed(M.numeric_term("x"), M.numeric_term("u")) if three else M.numeric_term("x")
    return M.crossed(base, M.factor_terms("country", M.levels_of(frame, "country")))


@pytest.mark.parametrize("three", [False, True])
def test_least_squares_matches_numpy(spark, frame, data, three):
    X, y = design(data, three), data[3]
    fit = M.fit_linear(frame, "y", terms(frame, three))
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    e = y - X @ b
    s2 = e @ e / (len(y) - X.shape[1])
    se = np.sqrt(np.diag(s2 * np.linalg.inv(X.T @ X)))
    out = fit.coefficients(spark).collect()
    assert [r["estimate"] for r in out] == pytest.approx(list(b), abs=1e-6)
    assert [r["std_error"] for r in out] == pytest.approx(list(se), abs=1e-6)
    assert fit.r2 == pytest.approx(1 - e @ e / ((y - y.mean()) ** 2).sum()) and fit.sigma == pytest.approx(math.sqrt(s2))
    n = len(y)
    assert fit.aic == pytest.approx(n * (math.log(2 * math.pi * (e @ e) / n) + 1) + 2 * (X.shape[1] + 1))
    t = M.t_quantile(0.975, n - X.shape[1])
    assert out[1]["conf_high"] - out[1]["estimate"] == pytest.approx(t * se[1], rel=1e-6)


def test_t_quantiles():
    assert M.t_quantile(0.975, 1) == pytest.approx(12.7062047)
    assert M.t_quantile(0.975, 10) == pytest.approx(2.2281389)
    assert M.t_quantile(0.025, 30) == pytest.approx(-2.0422725)


def test_leave_one_out_without_refitting(spark, frame, data):
    X, y = design(data), data[3]
    want = 0.0
    for i in range(len(y)):
        keep = np.arange(len(y)) != i
        b = np.linalg.lstsq(X[keep], y[keep], rcond=None)[0]
        want += (y[i] - X[i] @ b) ** 2
    t = terms(frame)
    assert M.press(frame, "y", t, M.fit_linear(frame, "y", t)).first()["press"] == pytest.approx(want)
    ranked = M.compare_loo(frame, "y", {"flat": M.numeric_term("u"), "full": t}).collect()
    assert [r["model"] for r in ranked] == ["full", "flat"] and ranked[0]["press_diff"] == 0


def test_posterior_matches_the_closed_form_and_shrinks(frame, data):
    X, y = design(data), data[3]
    xc = X[:, 1:] - X[:, 1:].mean(0)
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    s2 = ((y - X @ b) ** 2).sum() / (len(y) - X.shape[1])
    for sd in (0.2, 5.0):
        cov = np.linalg.inv(xc.T @ xc / s2 + np.eye(xc.shape[1]) / sd**2)
        fit = M.fit_linear(frame, "y", terms(frame), prior_sd=sd)
        assert list(fit.beta) == pytest.approx(list(cov @ (xc.T @ (y - y.mean())) / s2), abs=1e-6)
        assert list(np.diag(fit.beta_cov)) == pytest.approx(list(np.diag(cov)))
    assert abs(M.fit_linear(frame, "y", terms(frame), prior_sd=0.2).beta[0]) < abs(b[1])


def test_prediction_bands(spark, frame, data):
    X, y = design(data), data[3]
    t = terms(frame)
    fit = M.fit_linear(frame, "y", t)
    grid = spark.createDataFrame([("England", 0.3), ("Wales", 1.0)], "country string, x double")
    got = M.predict_band(fit, grid, t).orderBy("country").collect()
    v = np.linalg.inv(X.T @ X) * fit.sigma**2
    for r, p in zip(got, np.array([[1, 0.3, 0, 0, 0, 0], [1, 1, 0, 1, 0, 1.0]])):
        half = 1.959963984540054 * math.sqrt(p @ v @ p)
        assert r["upper"] - r["predicted"] == pytest.approx(half)
        assert r["new_upper"] - r["predicted"] == pytest.approx(1.959963984540054 * math.sqrt(p @ v @ p + fit.sigma**2))


def test_poisson_on_a_factor_gives_ratios_of_means(spark, frame, data):
    c, k = data[2], data[4]
    fit = M.fit_poisson(frame.filter("x is not null"), "k", M.factor_terms("country", COUNTRIES))
    means = [k[c == i].mean() for i in range(3)]
    assert list(fit.coef) == pytest.approx([math.log(means[0]), math.log(means[1] / means[0]), math.log(means[2] / means[0])], abs=1e-6)


def test_negative_binomial_matches_reweighted_least_squares(spark, frame, data):
    x, k = data[0], data[4]
    X, b, it = np.column_stack([np.ones_like(x), x]), np.array([math.log(k.mean()), 0.0]), 0.0
    for _ in range(200):
        mu = np.exp(X @ b)
        w = mu / (1 + mu * it)
        z = X @ b + (k - mu) / mu
        b = np.linalg.solve(X.T @ (X * w[:, None]), X.T @ (w * z))
        it = max((((k - mu) ** 2 - mu).sum()) / (mu**2).sum(), 1e-8)
    fit = M.fit_negative_binomial(frame, "k", M.numeric_term("x"), dispersion="moment")
    assert list(fit.coef) == pytest.approx(list(b), abs=1e-6) and 1 / fit.theta == pytest.approx(it, abs=1e-6)
    z = M.zero_share(frame, "k", M.numeric_term("x"), fit).first()
    mu = np.exp(X @ b)
    assert z["observed"] == pytest.approx((k == 0).mean()) and z["expected"] == pytest.approx(((fit.theta / (fit.theta + mu)) ** fit.theta).mean())
    band = M.count_band(fit, spark.createDataFrame([(0.5,)], "x double"), M.numeric_term("x")).first()
    assert band["predicted"] == pytest.approx(math.exp(b[0] + 0.5 * b[1]), rel=1e-6)
    assert band["lower"] < band["predicted"] < band["upper"]


def log_likelihood(b, theta, X, k):
    mu = np.exp(X @ b)
    return sum(math.lgamma(y + theta) - math.lgamma(theta) - math.lgamma(y + 1) + theta * math.log(theta / (theta + m)) + y * math.log(m / (theta + m))
               for y, m in zip(k, mu))


@pytest.mark.parametrize("wide", [False, True])
def test_dispersion_maximises_the_likelihood(spark, wide):
    """Against a plain search by coordinates, also with so many terms that sums come from batches."""
    rng = np.random.default_rng(8)
    n = 800
    x = rng.normal(size=(n, 6 if wide else 1))
    k = rng.poisson(np.exp(0.4 + 0.3 * x[:, 0]) * rng.gamma(1.5, 1 / 1.5, n))
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, k)], ", ".join(f"x{i} double" for i in range(x.shape[1])) + ", k int")
    fit = M.fit_negative_binomial(df, "k", {f"x{i}": F.col(f"x{i}") for i in range(x.shape[1])})
    X = np.column_stack([np.ones(n), x])
    at = log_likelihood(fit.coef, fit.theta, X, k)
    assert fit.converged and fit.log_likelihood == pytest.approx(at, rel=1e-9)
    for i in range(len(fit.coef)):
        for d in (-1e-3, 1e-3):
            moved = fit.coef.copy()
            moved[i] += d
            assert log_likelihood(moved, fit.theta, X, k) < at
    for f in (0.999, 1.001):
        assert log_likelihood(fit.coef, fit.theta * f, X, k) < at


def test_counts_without_overdispersion_end_at_poisson(spark):
    df = spark.createDataFrame([(float(i % 2), 1 + i % 2) for i in range(100)], "x double, k int")
    fit = M.fit_negative_binomial(df, "k", M.numeric_term("x"))
    assert fit.converged and fit.theta == pytest.approx(M.POISSON_THETA) and math.exp(fit.coef[0]) == pytest.approx(1, rel=1e-6)


def test_a_fit_that_does_not_settle_is_an_error(spark, frame):
    for dispersion in ("likelihood", "moment"):
        with pytest.raises(M.NotConverged):
            M.fit_negative_binomial(frame, "k", M.numeric_term("x"), max_iter=1, dispersion=dispersion)
        fit = M.fit_negative_binomial(frame, "k", M.numeric_term("x"), max_iter=1, dispersion=dispersion, on_failure="return")
        assert not fit.converged and fit.iterations == 1


def test_models_are_compared_on_the_same_rows(spark):
    """Rows that lack a term of any model, or fix a coefficient of any model alone, are in no sum."""
    rng = np.random.default_rng(2)
    rows = [(float(x), None if i % 10 == 0 else float(z), "a" if i else "lone", float(1e9 + 3 * x + z)) for i, (x, z) in enumerate(rng.normal(size=(60, 2)))]
    rows.append((0.5, 0.25, "lone", 1e9 + 7.0))
    df = spark.createDataFrame(rows, "x double, z double, g string, y double")
    models = {"x": M.numeric_term("x"), "xz": {**M.numeric_term("x"), **M.numeric_term("z")},
              "group": {**M.numeric_term("x"), **M.factor_terms("g", ["a", "lone"])}}
    used = [r for r in rows if r[1] is not None]
    own = [r for r in used if r[2] != "lone"]
    want = {}
    for name, cols in (("x", lambda r: [1, r[0]]), ("xz", lambda r: [1, r[0], r[1]]), ("group", lambda r: [1, r[0], float(r[2] == "lone")])):
        X, y = np.array([cols(r) for r in used]), np.array([r[3] - 1e9 for r in used])
        total = 0.0
        for i, r in enumerate(used):
            if r in own:
                keep = np.arange(len(used)) != i
                total += (y[i] - X[i] @ np.linalg.lstsq(X[keep], y[keep], rcond=None)[0]) ** 2
        want[name] = total
    got = {r["model"]: r for r in M.compare_loo(df, "y", models).collect()}
    for name, total in want.items():
        assert got[name]["press"] == pytest.approx(total, rel=1e-5) and got[name]["n"] == len(own)
    assert {m: r["leverage_one"] for m, r in got.items()} == {"x": 0, "xz": 0, "group": 1}


def test_one_matrix_solves_every_model(frame):
    models = {"x": M.numeric_term("x"), "full": terms(frame)}
    fits = M.fit_models(frame, "y", models)
    for name, t in models.items():
        alone = M.fit_linear(frame.filter("x is not null"), "y", t)
        assert list(fits[name].beta) == pytest.approx(list(alone.beta)) and fits[name].rss == pytest.approx(alone.rss)


def test_dependent_terms_do_not_break_the_count_model(spark, frame, data):
    k = data[4]
    twice = {"a": F.when(F.col("x").isNotNull(), 1.0), "x": F.col("x"), "again": F.col("x")}
    fit = M.fit_negative_binomial(frame, "k", twice)
    once = M.fit_negative_binomial(frame, "k", M.numeric_term("x"))
    assert fit.coef[2] == pytest.approx(once.coef[1] / 2, abs=1e-5) and fit.coef[2] == pytest.approx(fit.coef[3], abs=1e-6)
    assert fit.coefficients(spark).count() == 4 and fit.n == len(k)


def test_lines_by_group_equal_the_interaction_model(spark, frame):
    lines = {r["country"]: r for r in M.lines_by_group(frame, "y", "x", ["country"]).collect()}
    co = {r["term"]: r["estimate"] for r in M.fit_linear(frame, "y", terms(frame)).coefficients(spark).collect()}
    assert lines["England"]["slope"] == pytest.approx(co["x"]) and lines["Wales"]["slope"] == pytest.approx(co["x"] + co["x:country[Wales]"])


def test_too_many_levels_and_too_few_rows(spark, frame):
    with pytest.raises(ValueError, match="levels"):
        M.levels_of(spark.range(100).select(F.col("id").cast("string").alias("f")), "f")
    with pytest.raises(ValueError, match="cannot identify"):
        M.fit_linear(frame.limit(2), "y", M.numeric_term("x"))


def test_a_perfect_fit_has_statistics(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 0.0) for i in range(8)], "x double, y double, z double")
    fit = M.fit_linear(df, "z", {"x": df["x"]})
    row = fit.glance(spark).first()
    assert row["n"] == 8 and row["aic"] == float("-inf")
