"""Linear and count models on large row sets with small coefficient sets.

A fit is one or a few aggregations: sums of cross-products over all rows with
partial aggregation, then p x p algebra on the driver. Predictions, residuals
and leverages are column expressions, so they scale with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arearisk.scratch import materialize

Terms = dict[str, Column]
MAX_LEVELS = 64
MAX_SUMS = 30  # sums per generated aggregation; beyond, the method is too long to be compiled


# ---- design ----------------------------------------------------------------

def levels_of(df: DataFrame, factor: str, limit: int = MAX_LEVELS) -> list:
    """Sorted levels of a factor; refuses factors too wide for a coefficient table."""
    found = [r[0] for r in df.select(factor).filter(F.col(factor).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{factor} has more than {limit} levels")
    return sorted(found)


def numeric_term(name: str) -> Terms:
    return {name: F.col(name).cast("double")}


def factor_terms(factor: str, levels: Sequence) -> Terms:
    """Treatment coding: one 0/1 column per level but the first; missing stays missing."""
    c = F.col(factor)
    return {
        f"{factor}[{v}]": F.when(c.isNull(), F.lit(None).cast("double")).when(c == v, 1.0).otherwise(0.0)
        for v in levels[1:]
    }


def crossed(a: Terms, b: Terms) -> Terms:
    """Main effects and all products."""
    return {**a, **b, **{f"{i}:{j}": x * y for i, x in a.items() for j, y in b.items()}}


# ---- t distribution --------------------------------------------------------

def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t by bisection on the integrated density."""
    if df > 1e6:
        return NormalDist().inv_cdf(p)
    if p < 0.5:
        return -t_quantile(1 - p, df)
    logc = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    nodes, weights = np.polynomial.legendre.leggauss(200)

    def upper_half(t: float) -> float:
        # With x = sqrt(df) tan(a) the density becomes cos(a) ** (df - 1).
        top = math.atan(t / math.sqrt(df))
        a = 0.5 * top * (nodes + 1)
        return 0.5 * top * float(np.sum(weights * np.exp((df - 1) * np.log(np.cos(a))))) * math.exp(logc) * math.sqrt(df)

    lo, hi = 0.0, 1.0
    while upper_half(hi) < p - 0.5 and hi < 1e8:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if upper_half(mid) < p - 0.5:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


# ---- linear models ---------------------------------------------------------

@dataclass(frozen=True)
class LinearFit:
    """A fitted linear model around the means of its terms.

    `level` is the fitted value at the means and `beta` the slopes; the two
    are uncorrelated, which keeps the algebra well conditioned.
    """

    names: tuple[str, ...]
    means: np.ndarray
    level: float
    level_var: float
    beta: np.ndarray
    beta_cov: np.ndarray
    sxx_inv: np.ndarray
    n: int
    rss: float
    tss: float
    df: float
    sigma: float
    bayes: bool = False

    @property
    def intercept(self) -> float:
        return float(self.level - self.means @ self.beta)

    @property
    def intercept_se(self) -> float:
        return float(math.sqrt(self.level_var + self.means @ self.beta_cov @ self.means))

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss if self.tss > 0 else float("nan")

    @property
    def aic(self) -> float:
        # Of n rows, df are left over; the rest is the rank with the intercept. A perfect fit has no finite likelihood.
        if self.rss <= 0:
            return -math.inf
        p = self.n - self.df + 1 if not self.bayes else len(self.names) + 2
        return self.n * (math.log(2 * math.pi * self.rss / self.n) + 1) + 2 * p

    def coefficients(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        """term, estimate, std_error, conf_low, conf_high."""
        z = NormalDist().inv_cdf(0.5 + level / 2) if self.bayes else t_quantile(0.5 + level / 2, self.df)
        est = [("(Intercept)", self.intercept, self.intercept_se)]
        est += [(t, float(b), float(s)) for t, b, s in zip(self.names, self.beta, np.sqrt(np.diag(self.beta_cov)))]
        return spark.createDataFrame(
            [(t, b, s, b - z * s, b + z * s) for t, b, s in est],
            "term string, estimate double, std_error double, conf_low double, conf_high double",
        )

    def glance(self, spark: SparkSession) -> DataFrame:
        """n, df_residual, r_squared, sigma, aic."""
        return spark.createDataFrame(
            [(self.n, float(self.df), self.r2, self.sigma, self.aic)],
            "n long, df_residual double, r_squared double, sigma double, aic double",
        )


def _complete(df: DataFrame, y: str, terms: Terms, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    cols = [f"t{i}" for i in range(len(terms))]
    rows = df.select(*keep, F.col(y).cast("double").alias("y"), *[t.alias(c) for c, t in zip(cols, terms.values())])
    return rows.dropna("any", subset=["y", *cols]), cols


def _arrow_sums(rows: DataFrame, cols: list[str], length: int, per_batch: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of `per_batch` over all rows, given as Arrow batches; each task returns one vector."""
    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(length)
        for batch in batches:
            total += per_batch(batch.to_numpy(dtype=float))
        yield pd.DataFrame({"pos": np.arange(length), "v": total})

    parts = rows.select(*cols).mapInPandas(per_task, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v"))
    out = np.zeros(length)
    for r in parts.collect():  # `length` numbers
        out[r["pos"]] = r["v"]
    return out


@dataclass(frozen=True)
class Gram:
    """Number of rows, means and summed cross-products around the means, of the outcome (first) and named terms."""

    names: tuple[str, ...]
    n: int
    means: np.ndarray
    cross: np.ndarray

    def pick(self, names: Sequence[str]) -> Gram:
        """The same for some of the terms: every model of a set is solved from one matrix."""
        at = [0, *(1 + self.names.index(t) for t in names)]
        return Gram(tuple(names), self.n, self.means[at], self.cross[np.ix_(at, at)])


def gram(df: DataFrame, y: str, terms: Terms) -> Gram:
    """One scan over the rows complete in the outcome and all terms.

    Sums are taken around the means of the first thousand rows and moved to the means of all at the end, so that
    large values with little spread lose no digits.
    """
    rows, cols = _complete(df, y, terms)
    cols, p = ["y", *cols], len(terms) + 1
    near = rows.limit(1000).agg(*[F.avg(c) for c in cols]).first()
    shift = np.array([float(v or 0.0) for v in near])
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    if 1 + p + len(pairs) > MAX_SUMS:
        # With many sums the generated method would be too long to be compiled, so batches are multiplied with numpy.
        def products(x: np.ndarray) -> np.ndarray:
            d = x - shift
            return np.concatenate(([len(x)], d.sum(axis=0), (d.T @ d).ravel()))

        r = _arrow_sums(rows, cols, 1 + p + p * p, products)
        n, off, cross = int(r[0]), r[1:1 + p], r[1 + p:].reshape(p, p)
    else:
        d = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, shift)]
        r = rows.agg(F.count(F.lit(1)), *[F.sum(x) for x in d], *[F.sum(d[i] * d[j]) for i, j in pairs]).first()
        n, off, cross = int(r[0]), np.array([float(v or 0.0) for v in r[1:1 + p]]), np.zeros((p, p))
        for (i, j), v in zip(pairs, r[1 + p:]):
            cross[i, j] = cross[j, i] = float(v or 0.0)
    if not n:
        return Gram(tuple(terms), 0, shift, cross)
    return Gram(tuple(terms), n, shift + off / n, cross - np.outer(off, off) / n)


def solve_linear(sums: Gram, prior_sd: float | None = None) -> LinearFit:
    """Least squares, or with `prior_sd` the normal posterior under normal(0, prior_sd) priors.

    Priors are on the slopes and on the level at the means; sigma is the
    least-squares estimate.
    """
    n, p = sums.n, len(sums.names)
    if n <= p + 1:
        raise ValueError(f"{n} complete rows cannot identify {p + 1} coefficients")
    y_mean, means, cross = float(sums.means[0]), sums.means[1:], sums.cross
    tss, sxy, sxx = float(cross[0, 0]), cross[0, 1:], cross[1:, 1:]
    inv = np.linalg.pinv(sxx, hermitian=True) if p else np.zeros((0, 0))
    rank = int(np.linalg.matrix_rank(sxx, hermitian=True)) if p else 0
    beta = inv @ sxy
    rss = max(float(tss - sxy @ beta), 0.0)
    dof = float(n - rank - 1)
    s2 = rss / dof
    level, level_var, cov = y_mean, s2 / n, s2 * inv
    if prior_sd is not None:
        tau = 1.0 / prior_sd**2
        noise = max(s2, 1e-300)
        cov = np.linalg.inv(sxx / noise + tau * np.eye(p))
        beta = cov @ (sxy / noise)
        level_var = 1.0 / (n / noise + tau)
        level = level_var * n * y_mean / noise
        rss = float(tss - 2 * beta @ sxy + beta @ sxx @ beta + n * (y_mean - level) ** 2)
    return LinearFit(sums.names, means, level, float(level_var), beta, cov, inv, n, rss, tss, dof,
                     math.sqrt(s2), prior_sd is not None)


def fit_linear(df: DataFrame, y: str, terms: Terms, prior_sd: float | None = None) -> LinearFit:
    """`solve_linear` on the rows complete in the outcome and the terms."""
    return solve_linear(gram(df, y, terms), prior_sd)


def fit_models(df: DataFrame, y: str, models: dict[str, Terms], prior_sd: float | None = None) -> dict[str, LinearFit]:
    """Several models from one scan, all on the rows that are complete in the terms of every one of them.

    Terms of the same name must be the same.
    """
    sums = gram(df, y, _all_terms(models))
    return {name: solve_linear(sums.pick(list(terms)), prior_sd) for name, terms in models.items()}


def _all_terms(models: dict[str, Terms]) -> Terms:
    return {t: c for terms in models.values() for t, c in terms.items()}


def _plus(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def _quadratic(xs: list[Column], m: np.ndarray) -> Column:
    """x' M x as a column; numpy on Arrow batches where the expression would be too long to compile."""
    p = len(xs)
    if p * (p + 1) // 2 > MAX_SUMS:
        @F.pandas_udf("double")
        def quadratic(*parts: pd.Series) -> pd.Series:
            x = np.column_stack(parts)
            return pd.Series(np.einsum("ij,jk,ik->i", x, m, x))

        known = reduce(lambda a, b: a & b, [x.isNotNull() for x in xs])
        return F.when(known, quadratic(*xs))
    return _plus([xs[i] * _plus([xs[j] * F.lit(float(m[i, j]) * (1 if i == j else 2)) for j in range(i, p)])
                  for i in range(p)])


def _linear(start: float, cols: list[Column], weights: np.ndarray) -> Column:
    return F.lit(float(start)) + _plus([c * F.lit(float(w)) for c, w in zip(cols, weights)])


def _with_terms(df: DataFrame, names: Sequence[str], terms: Terms) -> tuple[DataFrame, list[Column]]:
    """Terms as columns of their own, so that wide quadratic forms stay small in generated code."""
    held = {f"__t{i}": terms[t] for i, t in enumerate(names)}
    return (df.withColumns(held) if held else df), [F.col(c) for c in held]


def _hidden(n: int) -> list[str]:
    return [f"__t{i}" for i in range(n)]


def _around_means(fit: LinearFit, cols: list[Column]) -> list[Column]:
    return [c - F.lit(float(m)) for c, m in zip(cols, fit.means)]


def with_residuals(df: DataFrame, y: str, terms: Terms, fit: LinearFit) -> DataFrame:
    """Adds fitted, residual and leverage; missing where a term is."""
    held, cols = _with_terms(df, fit.names, terms)
    mean = _linear(fit.intercept, cols, fit.beta)
    lever = F.lit(1.0 / fit.n) + _quadratic(_around_means(fit, cols), fit.sxx_inv)
    return held.withColumns({"fitted": mean, "residual": F.col(y) - mean, "leverage": lever}).drop(*_hidden(len(cols)))


def predict_band(fit: LinearFit, grid: DataFrame, terms: Terms, level: float = 0.95) -> DataFrame:
    """Mean, its interval and the interval of a new observation for every grid row."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    held, cols = _with_terms(grid, fit.names, terms)
    mean = _linear(fit.intercept, cols, fit.beta)
    var = F.lit(fit.level_var) + _quadratic(_around_means(fit, cols), fit.beta_cov)
    held = held.withColumns({"predicted": mean, "__var": var})
    half, wide = F.lit(z) * F.sqrt("__var"), F.lit(z) * F.sqrt(F.col("__var") + F.lit(fit.sigma**2))
    p = F.col("predicted")
    return held.withColumns({
        "lower": p - half, "upper": p + half, "new_lower": p - wide, "new_upper": p + wide,
    }).drop("__var", *_hidden(len(cols)))


#: A row whose leverage comes this close to 1 fixes a coefficient alone: without it the model says nothing about it.
FREE = 1e-9


def press_of_models(df: DataFrame, y: str, models: dict[str, Terms], fits: dict[str, LinearFit]) -> dict[str, tuple[float, int, int]]:
    """Leave-one-out squared errors of several models in one scan, without refitting: residuals over one minus leverage.

    Per model: the sum, the rows in it and the rows that have leverage 1 there. All sums are over the same rows: those
    complete in every term that have leverage below 1 in every model.
    """
    union = _all_terms(models)
    rows, cols = _complete(df, y, union)
    places = {name: [list(union).index(t) + 1 for t in terms] for name, terms in models.items()}

    def errors(x: np.ndarray) -> np.ndarray:
        lost, share = [], []
        for name, fit in fits.items():
            d = x[:, places[name]] - fit.means
            share.append(1.0 - 1.0 / fit.n - np.einsum("ij,jk,ik->i", d, fit.sxx_inv, d))
            lost.append(x[:, 0] - fit.level - d @ fit.beta)
        free = np.all([s > FREE for s in share], axis=0)
        return np.concatenate(([free.sum()], *[
            [np.sum((e[free] / s[free]) ** 2), np.sum(s <= FREE)] for e, s in zip(lost, share)]))

    r = _arrow_sums(rows, ["y", *cols], 1 + 2 * len(fits), errors)
    return {name: (float(r[1 + 2 * i]), int(r[0]), int(r[2 + 2 * i])) for i, name in enumerate(fits)}


def press(df: DataFrame, y: str, terms: Terms, fit: LinearFit) -> DataFrame:
    """Leave-one-out squared error of one model: press, n and the rows of leverage 1, which are not in it."""
    return df.sparkSession.createDataFrame(
        [press_of_models(df, y, {"": terms}, {"": fit})[""]], "press double, n long, leverage_one long")


def compare_loo(df: DataFrame, y: str, models: dict[str, Terms]) -> DataFrame:
    """Models ranked by leave-one-out error: place, model, press, n, difference to the best, rows of leverage 1.

    Two scans whatever the number of models, and the same rows for all of them.
    """
    found = press_of_models(df, y, models, fit_models(df, y, models))
    best = min(v for v, _, _ in found.values())
    rows = sorted(((m, *v) for m, v in found.items()), key=lambda r: r[1])
    return df.sparkSession.createDataFrame(
        [(i + 1, m, v, n, v - best, fixed) for i, (m, v, n, fixed) in enumerate(rows)],
        "place int, model string, press double, n long, press_diff double, leverage_one long")


def lines_by_group(df: DataFrame, y: str, x: str, by: Sequence[str]) -> DataFrame:
    """One straight line per group in a single aggregation."""
    both = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r_squared"))


# ---- count models ----------------------------------------------------------

def _exp(v: float) -> float | None:
    """exp, missing where the result leaves the range of doubles."""
    return math.exp(v) if v < 700 else None


class NotConverged(RuntimeError):
    """A fit did not settle within its steps."""


@dataclass(frozen=True)
class CountFit:
    names: tuple[str, ...]  # the intercept first
    coef: np.ndarray
    cov: np.ndarray
    theta: float | None  # None for Poisson
    n: int
    iterations: int = 0
    converged: bool = True
    log_likelihood: float | None = None

    def coefficients(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        """term, estimate, std_error and interval on the log scale, and as rate ratios."""
        z = NormalDist().inv_cdf(0.5 + level / 2)
        se = np.sqrt(np.diag(self.cov))
        return spark.createDataFrame(
            [(t, float(b), float(s), float(b - z * s), float(b + z * s),
              _exp(b), _exp(b - z * s), _exp(b + z * s)) for t, b, s in zip(self.names, self.coef, se)],
            "term string, estimate double, std_error double, conf_low double, conf_high double, "
            "rate_ratio double, rate_low double, rate_high double")


def fit_poisson(df: DataFrame, y: str, terms: Terms) -> CountFit:
    """Poisson counts with log link, by MLlib's distributed solver."""
    rows, cols = _complete(df, y, terms)
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(rows).select("y", "features")
    model = GeneralizedLinearRegression(family="poisson", link="log", labelCol="y", featuresCol="features",
                                        maxIter=50, tol=1e-10).fit(vec)
    se = np.array(model.summary.coefficientStandardErrors)  # slopes first, intercept last
    coef = np.concatenate(([model.intercept], model.coefficients.toArray()))
    se = np.concatenate(([se[-1]], se[:-1]))
    return CountFit(("(Intercept)", *terms), coef, np.diag(se**2), None, int(model.summary.numInstances))


def fit_negative_binomial(df: DataFrame, y: str, terms: Terms, max_iter: int = 50, tol: float = 1e-9,
                          dispersion: str = "likelihood", on_failure: str = "raise") -> CountFit:
    """Negative-binomial counts with log link, by reweighted least squares; each step is one aggregation.

    `likelihood`: the dispersion maximises the profile likelihood. What depends on the counts alone comes from their
    histogram; steps that lower the likelihood are halved. `moment`: its moment estimate, as in quasi-likelihood.
    A fit that does not settle raises `NotConverged`, or with `on_failure="return"` comes back with `converged` false.
    """
    rows, cols = _complete(df, y, terms)
    rows = materialize(rows, "count-model")
    n, mean = (float(v or 0) for v in rows.agg(F.count(F.lit(1)), F.avg("y")).first())
    if n <= len(cols) + 1 or mean <= 0:
        raise ValueError("not enough rows, or no positive counts")
    solver = {"likelihood": _by_likelihood, "moment": _by_moments}[dispersion]
    coef, cov, theta, done, converged, likelihood = solver(rows, cols, n, mean, max_iter, tol)
    if not converged and on_failure == "raise":
        raise NotConverged(f"no convergence in {max_iter} steps")
    return CountFit(("(Intercept)", *terms), coef, cov, theta, int(n), done, converged, likelihood)


def _by_moments(rows: DataFrame, cols: list[str], n: float, mean: float, max_iter: int, tol: float):
    xs = [F.lit(1.0), *[F.col(c) for c in cols]]
    p = len(xs)
    coef = np.zeros(p)
    coef[0] = math.log(mean)
    inv_theta, cov, done = 0.0, np.eye(p), 0
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    moved = math.inf
    for done in range(1, max_iter + 1):
        if len(pairs) > MAX_SUMS:
            b, it = coef, inv_theta

            def step_sums(data: np.ndarray) -> np.ndarray:
                y_, x = data[:, 0], np.column_stack([np.ones(len(data)), data[:, 1:]])
                mu_ = np.exp(x @ b)
                xw = x * (mu_ / (1.0 + mu_ * it))[:, None]
                target = x @ b + (y_ - mu_) / mu_
                return np.concatenate(([np.sum((y_ - mu_) ** 2 - mu_), np.sum(mu_ * mu_)], xw.T @ target, (xw.T @ x).ravel()))

            r = _arrow_sums(rows, ["y", *cols], 2 + p + p * p, step_sums)
            extra, xwz, xwx = r[:2], r[2:2 + p], r[2 + p:].reshape(p, p)
        else:
            step = rows.withColumn("eta", _linear(coef[0], xs[1:], coef[1:])).withColumn("mu", F.exp("eta")).withColumn(
                "w", F.col("mu") / (F.lit(1.0) + F.col("mu") * F.lit(inv_theta))
            ).withColumn("z", F.col("eta") + (F.col("y") - F.col("mu")) / F.col("mu"))
            w, z, m = F.col("w"), F.col("z"), F.col("mu")
            r = step.agg(F.sum((F.col("y") - m) * (F.col("y") - m) - m), F.sum(m * m), *[F.sum(w * x * z) for x in xs],
                         *[F.sum(w * xs[i] * xs[j]) for i, j in pairs]).first()
            extra, xwz, xwx = np.array(r[:2], float), np.array(r[2:2 + p], float), np.zeros((p, p))
            for (i, j), v in zip(pairs, r[2 + p:]):
                xwx[i, j] = xwx[j, i] = float(v)
        cov = np.linalg.pinv(xwx, hermitian=True)  # dependent terms share their effect
        new = cov @ xwz
        new_inv = max(float(extra[0] / extra[1]), 1e-8)
        moved = max(float(np.max(np.abs(new - coef))), abs(new_inv - inv_theta))
        coef, inv_theta = new, new_inv
        if moved < tol:
            break
    return coef, cov, 1.0 / inv_theta, done, moved < tol, None


#: Counts up to this one are tallied on the driver; beyond it a tally is one number for each count that occurs.
MAX_TALLY = 1 << 20
#: A dispersion parameter beyond this is that of Poisson counts.
POISSON_THETA = 1e8


class Tally:
    """Histogram of whole counts, for the parts of the likelihood that depend on them alone.

    The log of gamma(y + t) / gamma(t) is the sum of log(t + j) over j below y; so with the numbers of rows above each
    j it and its derivatives are plain sums.
    """

    def __init__(self, rows: DataFrame):
        found = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
        top = found.agg(F.max("y"), F.min("y"), F.max(F.col("y") - F.floor("y"))).first()
        if top[1] < 0 or top[2] > 0 or top[0] > MAX_TALLY:
            raise ValueError(f"counts must be whole numbers from 0 to {MAX_TALLY}")
        n = np.zeros(int(top[0]) + 1)
        for r in found.collect():  # at most MAX_TALLY numbers
            n[int(r["y"])] = r["n"]
        # Rows with a count above j, for j = 0, 1, ...
        self.above = n[::-1].cumsum()[::-1][1:]
        self.j = np.arange(len(self.above))
        self.constant = float(self.above @ np.log(self.j + 1.0)) if len(self.j) else 0.0

    def sums(self, theta: float) -> tuple[float, float, float]:
        """Value, first and second derivative by theta."""
        t = theta + self.j
        return float(self.above @ np.log(t)), float(self.above @ (1 / t)), -float(self.above @ (1 / t ** 2))


def _by_likelihood(rows: DataFrame, cols: list[str], n: float, mean: float, max_iter: int, tol: float):
    tally, p = Tally(rows), len(cols) + 1

    def sums_at(b: np.ndarray, theta: float) -> np.ndarray:
        def step_sums(data: np.ndarray) -> np.ndarray:
            y_, x = data[:, 0], np.column_stack([np.ones(len(data)), data[:, 1:]])
            eta = x @ b
            mu = np.exp(np.clip(eta, -300, 300))
            xw = x * (mu / (1.0 + mu / theta))[:, None]
            plus, both = theta + mu, theta + y_
            # log(theta / (theta + mu)) without cancellation for large theta.
            ratio = -np.log1p(mu / theta)
            return np.concatenate((
                [np.sum(y_ * (eta - np.log(plus))), np.sum(ratio), np.sum(both / plus), np.sum(1 / plus), np.sum(both / plus ** 2)],
                xw.T @ (eta + (y_ - mu) / mu), (xw.T @ x).ravel()))

        return _arrow_sums(rows, ["y", *cols], 5 + p + p * p, step_sums)

    coef = np.zeros(p)
    coef[0] = math.log(mean)
    variance = rows.agg(F.var_samp("y")).first()[0] or 0.0
    log_theta = math.log(min(max(mean * mean / max(variance - mean, 1e-6 * mean), 1e-3), POISSON_THETA))
    best, step, cov, converged, done = None, None, np.eye(p), False, 0
    for done in range(1, max_iter + 1):
        theta = math.exp(log_theta)
        r = sums_at(coef, theta)
        value, first, second = tally.sums(theta)
        likelihood = value - tally.constant + r[0] + theta * r[1]
        if best is not None and likelihood < best[0] - 1e-10 * abs(best[0]):
            # Too far: half way back.
            step = (step[0] / 2, step[1] / 2)
            coef, log_theta = best[1] + step[0], best[2] + step[1]
            continue
        best = (likelihood, coef, log_theta)
        cov = np.linalg.pinv(r[5 + p:].reshape(p, p), hermitian=True)  # dependent terms share their effect
        new = cov @ r[5:5 + p]
        # Newton's step for log(theta).
        slope = theta * (first + r[1] + n - r[2])
        curve = slope + theta ** 2 * (second + n / theta - 2 * r[3] + r[4])
        move = -slope / curve if curve < 0 else math.copysign(1.0, slope)
        move = max(-2.0, min(2.0, move))
        if log_theta + move > math.log(POISSON_THETA):
            move = math.log(POISSON_THETA) - log_theta
        step = (new - coef, move)
        coef, log_theta = new, log_theta + move
        if max(float(np.max(np.abs(step[0]))), abs(move)) < max(tol, 1e-9):
            converged = True
            break
    return coef, cov, math.exp(log_theta), done, converged, best[0]


def count_band(fit: CountFit, grid: DataFrame, terms: Terms, level: float = 0.95) -> DataFrame:
    """Expected count with its interval for every grid row."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    held, cols = _with_terms(grid, fit.names[1:], terms)
    held = held.withColumns({"__eta": _linear(fit.coef[0], cols, fit.coef[1:]),
                             "__se": F.sqrt(_quadratic([F.lit(1.0), *cols], fit.cov))})
    eta, half = F.col("__eta"), F.lit(z) * F.col("__se")
    return held.withColumns({
        "predicted": F.exp(eta), "lower": F.exp(eta - half), "upper": F.exp(eta + half),
    }).drop("__eta", "__se", *_hidden(len(cols)))


def zero_share(df: DataFrame, y: str, terms: Terms, fit: CountFit) -> DataFrame:
    """Observed share of zeros against the share the model expects."""
    held, cols = _with_terms(df, fit.names[1:], terms)
    mu = F.exp(_linear(fit.coef[0], cols, fit.coef[1:]))
    p0 = F.exp(-mu) if fit.theta is None else F.pow(F.lit(fit.theta) / (F.lit(fit.theta) + mu), F.lit(fit.theta))
    data = held.select(F.col(y).cast("double").alias("y"), p0.alias("p0")).dropna("any")
    return data.agg(F.avg(F.when(F.col("y") == 0, 1.0).otherwise(0.0)).alias("observed"), F.avg("p0").alias("expected"))
