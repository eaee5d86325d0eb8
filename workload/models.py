"""Linear and count models."""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.operators import models as M
from arearisk.operators.joins import grid
from workload.base import big, registry, rnd, sql_rnd, table

QUERIES, SQL, query = registry()


FLAGS = ["A", "N", "R"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", (F.col("l_extendedprice") / 1000).alias("y"), "l_discount", "l_linestatus")


_SLOPES = "regr_slope(l_extendedprice / 1000, l_quantity)"


@query(f"""SELECT l_returnflag, count(*) AS n, {sql_rnd(_SLOPES)} AS slope, {sql_rnd('regr_intercept(l_extendedprice / 1000, l_quantity)')} AS intercept,
       {sql_rnd('regr_r2(l_extendedprice / 1000, l_quantity)')} AS r_squared FROM lineitem GROUP BY 1""")
def ols_by_group(spark, sf):
    out = M.lines_by_group(_lines(spark, sf), "y", "l_quantity", ["l_returnflag"])
    return out.select("l_returnflag", "n", *[rnd(c).alias(c) for c in ("slope", "intercept", "r_squared")])


@query(f"""WITH g AS (SELECT l_returnflag AS f, avg(l_extendedprice / 1000) AS m, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT sum(pow(l_extendedprice / 1000 - m, 2)) / (count(*) - 3) AS s2 FROM lineitem JOIN g ON f = l_returnflag),
a AS (SELECT m, n FROM g WHERE f = 'A')
SELECT '(Intercept)' AS term, {sql_rnd('a.m')} AS estimate, {sql_rnd('sqrt(s2 / a.n)')} AS std_error FROM a, r
UNION ALL SELECT 'l_returnflag[' || f || ']', {sql_rnd('g.m - a.m')}, {sql_rnd('sqrt(s2 / a.n + s2 / g.n)')} FROM g, a, r WHERE f <> 'A'""")
def ols_factor(spark, sf):
    df = _lines(spark, sf)
    fit = M.fit_linear(df, "y", M.factor_terms("l_returnflag", M.levels_of(df, "l_returnflag")))
    return fit.coefficients(spark).select("term", rnd("estimate").alias("estimate"), rnd("std_error").alias("std_error"))


def _interaction(df):
    return M.crossed(M.numeric_term("l_quantity"), M.factor_terms("l_returnflag", M.levels_of(df, "l_returnflag")))


@query(f"""WITH g AS (SELECT l_returnflag AS f, {_SLOPES} AS b, regr_intercept(l_extendedprice / 1000, l_quantity) AS a FROM lineitem GROUP BY 1),
z AS (SELECT a AS a0, b AS b0 FROM g WHERE f = 'A')
SELECT '(Intercept)' AS term, {sql_rnd('a0', 5)} AS estimate FROM z UNION ALL SELECT 'l_quantity', {sql_rnd('b0', 5)} FROM z
UNION ALL SELECT 'l_returnflag[' || f || ']', {sql_rnd('a - a0', 5)} FROM g, z WHERE f <> 'A'
UNION ALL SELECT 'l_quantity:l_returnflag[' || f || ']', {sql_rnd('b - b0', 5)} FROM g, z WHERE f <> 'A'""")
def ols_interaction(spark, sf):
    df = _lines(spark, sf)
    return M.fit_linear(df, "y", _interaction(df)).coefficients(spark).select("term", rnd("estimate", 5).alias("estimate"))


@query(f"""WITH g AS (SELECT l_returnflag AS f, {_SLOPES} AS b, regr_intercept(l_extendedprice / 1000, l_quantity) AS a FROM lineitem GROUP BY 1),
e AS (SELECT l_extendedprice / 1000 AS y, l_extendedprice / 1000 - a - b * l_quantity AS r FROM lineitem JOIN g ON f = l_returnflag),
s AS (SELECT count(*) AS n, sum(r * r) AS rss, var_pop(y) * count(*) AS tss FROM e)
SELECT n, CAST(n - 6 AS DOUBLE) AS df_residual, {sql_rnd('1 - rss / tss', 6)} AS r_squared, {sql_rnd('sqrt(rss / (n - 6))', 6)} AS sigma,
       {sql_rnd('n * (ln(2 * pi() * rss / n) + 1) + 2 * 7', 3)} AS aic FROM s""")
def ols_fit_statistics(spark, sf):
    df = _lines(spark, sf)
    g = M.fit_linear(df, "y", _interaction(df)).glance(spark)
    return g.select("n", "df_residual", rnd("r_squared").alias("r_squared"), rnd("sigma").alias("sigma"), rnd("aic", 3).alias("aic"))


@query(f"""WITH g AS (SELECT l_returnflag AS f, {_SLOPES} AS b, regr_intercept(l_extendedprice / 1000, l_quantity) AS a FROM lineitem GROUP BY 1)
SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS quantity, {sql_rnd('avg(a + b * l_quantity)', 4)} AS fitted, {sql_rnd('avg(l_extendedprice / 1000 - a - b * l_quantity)', 4)} AS residual
FROM lineitem JOIN g ON f = l_returnflag GROUP BY 1, 2""")
def ols_residuals(spark, sf):
    df = _lines(spark, sf)
    terms = _interaction(df)
    out = M.with_residuals(df, "y", terms, M.fit_linear(df, "y", terms))
    return out.groupBy("l_returnflag", big("l_quantity").alias("quantity")).agg(
        rnd(F.avg("fitted"), 4).alias("fitted"), rnd(F.avg("residual"), 4).alias("residual"))


def _loo_sql(x: str, name: str) -> str:
    return f"""SELECT '{name}' AS model, sum(pow((y - (my + sxy / sxx * (x - mx))) / (1 - 1.0 / n - (x - mx) * (x - mx) / sxx), 2)) AS press, count(*) AS n
  FROM (SELECT l_extendedprice / 1000 AS y, {x} AS x FROM lineitem) d,
       (SELECT count(*) AS n, avg({x}) AS mx, avg(l_extendedprice / 1000) AS my, var_pop({x}) * count(*) AS sxx,
               covar_pop(l_extendedprice / 1000, {x}) * count(*) AS sxy FROM lineitem) s"""


@query(f"""WITH m AS ({_loo_sql('l_quantity', 'quantity')} UNION ALL {_loo_sql('l_discount', 'discount')} UNION ALL {_loo_sql('l_quantity * l_quantity', 'squared')})
SELECT CAST(row_number() OVER (ORDER BY press) AS INTEGER) AS place, model, {sql_rnd('press', 1)} AS press, n, {sql_rnd('press - min(press) OVER ()', 1)} AS press_diff FROM m""")
def loo_press(spark, sf):
    df = _lines(spark, sf)
    out = M.compare_loo(df, "y", {"quantity": M.numeric_term("l_quantity"), "discount": M.numeric_term("l_discount"),
                                  "squared": {"squared": F.col("l_quantity") * F.col("l_quantity")}})
    return out.select("place", "model", rnd("press", 1).alias("press"), "n", rnd("press_diff", 1).alias("press_diff"))


_Z = "1.959963984540054"


@query(f"""WITH g AS (SELECT l_returnflag AS f, count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice / 1000) AS my, var_pop(l_quantity) * count(*) AS sxx,
  covar_pop(l_extendedprice / 1000, l_quantity) * count(*) AS sxy, var_pop(l_extendedprice / 1000) * count(*) AS syy FROM lineitem GROUP BY 1),
s AS (SELECT sum(syy - sxy * sxy / sxx) / (sum(n) - 6) AS s2 FROM g),
p AS (SELECT f, q.range / 2.0 AS x, my + sxy / sxx * (q.range / 2.0 - mx) AS m, s2 * (1.0 / n + pow(q.range / 2.0 - mx, 2) / sxx) AS v, s2 FROM g, s, range(0, 101) q)
SELECT f AS l_returnflag, CAST(x AS DOUBLE) AS l_quantity, {sql_rnd('m', 4)} AS predicted, {sql_rnd(f'm - {_Z} * sqrt(v)', 4)} AS lower, {sql_rnd(f'm + {_Z} * sqrt(v)', 4)} AS upper,
  {sql_rnd(f'm - {_Z} * sqrt(v + s2)', 4)} AS new_lower, {sql_rnd(f'm + {_Z} * sqrt(v + s2)', 4)} AS new_upper FROM p""")
def prediction_grid(spark, sf):
    df = _lines(spark, sf)
    terms = _interaction(df)
    g = grid(df.select("l_returnflag"), "l_quantity", steps=100, upper=50.0)
    out = M.predict_band(M.fit_linear(df, "y", terms), g, terms)
    return out.select("l_returnflag", "l_quantity", *[rnd(c, 4).alias(c) for c in ("predicted", "lower", "upper", "new_lower", "new_upper")])


@query(f"""WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice / 1000) AS my, var_pop(l_quantity) * count(*) AS sxx,
  covar_pop(l_extendedprice / 1000, l_quantity) * count(*) AS sxy, var_pop(l_extendedprice / 1000) * count(*) AS syy FROM lineitem),
v AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM s),
b AS (SELECT *, 1 / (sxx / s2 + 1 / 25.0) AS bv, 1 / (n / s2 + 1 / 25.0) AS lv FROM v),
e AS (SELECT bv * sxy / s2 AS b, bv, lv * n * my / s2 AS l, lv, mx FROM b),
c AS (SELECT '(Intercept)' AS term, l - b * mx AS est, sqrt(lv + mx * mx * bv) AS se FROM e UNION ALL SELECT 'l_quantity', b, sqrt(bv) FROM e)
SELECT term, {sql_rnd('est')} AS estimate, {sql_rnd('se')} AS std_error, {sql_rnd(f'est - {_Z} * se')} AS conf_low, {sql_rnd(f'est + {_Z} * se')} AS conf_high FROM c""")
def posterior_linear(spark, sf):
    fit = M.fit_linear(_lines(spark, sf), "y", M.numeric_term("l_quantity"), prior_sd=5.0)
    return fit.coefficients(spark).select("term", *[rnd(c).alias(c) for c in ("estimate", "std_error", "conf_low", "conf_high")])


@query(f"""SELECT l_returnflag, CAST(d AS DOUBLE) AS deprived, CAST(u AS DOUBLE) AS urban, {sql_rnd('avg(y)', 4)} AS predicted,
  CASE u WHEN 1 THEN 'Urban' ELSE 'Rural' END || CASE d WHEN 1 THEN ', full deprivation' ELSE ', no deprivation' END AS label FROM (
  SELECT l_returnflag, l_extendedprice / 1000 AS y, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS d, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS u FROM lineitem) GROUP BY l_returnflag, d, u""")
def three_way_model(spark, sf):
    """Two 0/1 shares and a factor with all interactions: corner predictions equal the cell means."""
    from arearisk.functions.scalars import corner_label

    df = _lines(spark, sf).select("l_returnflag", "y", F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("deprived"),
                                  F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0).alias("urban"))
    terms = M.crossed(M.crossed(M.numeric_term("deprived"), M.numeric_term("urban")),
                      M.factor_terms("l_returnflag", M.levels_of(df, "l_returnflag")))
    corners = grid(grid(df.select("l_returnflag"), "deprived", 1), "urban", 1)
    out = M.predict_band(M.fit_linear(df, "y", terms), corners, terms)
    return out.select("l_returnflag", "deprived", "urban", rnd("predicted", 4).alias("predicted"), corner_label("deprived", "urban").alias("label"))


# ---- counts ----------------------------------------------------------------

def _counts(spark, sf):
    """Urgent orders per customer with the customer's segment."""
    o = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_mktsegment", F.coalesce("k", F.lit(0)).alias("k"))


_COUNT_SQL = """k AS (SELECT c_mktsegment AS seg, coalesce(n, 0) AS k FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey),
g AS (SELECT seg, avg(k) AS m, count(*) AS n, sum(k) AS t FROM k GROUP BY 1), z AS (SELECT * FROM g WHERE seg = 'AUTOMOBILE')"""


def _count_terms(df):
    return M.factor_terms("c_mktsegment", M.levels_of(df, "c_mktsegment"))


@query(f"""WITH {_COUNT_SQL}
SELECT '(Intercept)' AS term, {sql_rnd('ln(z.m)', 5)} AS estimate, {sql_rnd('sqrt(1.0 / z.t)', 5)} AS std_error, {sql_rnd('z.m', 5)} AS rate_ratio FROM z
UNION ALL SELECT 'c_mktsegment[' || g.seg || ']', {sql_rnd('ln(g.m / z.m)', 5)}, {sql_rnd('sqrt(1.0 / z.t + 1.0 / g.t)', 5)}, {sql_rnd('g.m / z.m', 5)} FROM g, z WHERE g.seg <> z.seg""")
def poisson_rate_ratio(spark, sf):
    df = _counts(spark, sf)
    fit = M.fit_poisson(df, "k", _count_terms(df))
    return fit.coefficients(spark).select("term", *[rnd(c, 5).alias(c) for c in ("estimate", "std_error", "rate_ratio")])


@query(f"""WITH {_COUNT_SQL}, th AS (SELECT greatest(sum((k - m) * (k - m) - m) / sum(m * m), 1e-8) AS it FROM k JOIN g USING (seg)),
w AS (SELECT seg, m, n * m / (1 + m * it) AS w FROM g, th), r AS (SELECT * FROM w WHERE seg = 'AUTOMOBILE')
SELECT '(Intercept)' AS term, {sql_rnd('ln(r.m)', 5)} AS estimate, {sql_rnd('sqrt(1 / r.w)', 5)} AS std_error, {sql_rnd('r.m', 5)} AS rate_ratio FROM r
UNION ALL SELECT 'c_mktsegment[' || w.seg || ']', {sql_rnd('ln(w.m / r.m)', 5)}, {sql_rnd('sqrt(1 / r.w + 1 / w.w)', 5)}, {sql_rnd('w.m / r.m', 5)} FROM w, r WHERE w.seg <> r.seg""")
def negative_binomial_model(spark, sf):
    df = _counts(spark, sf)
    fit = M.fit_negative_binomial(df, "k", _count_terms(df), dispersion="moment")
    return fit.coefficients(spark).select("term", *[rnd(c, 5).alias(c) for c in ("estimate", "std_error", "rate_ratio")])


def _bisected(rounds: int) -> str:
    """Dispersion where the score is 0, by bisection on its logarithm; each round follows from the one before.

    The score needs the rows above each count, from the histogram, and the group means.
    """
    out = ["b0 AS (SELECT CAST(-8 AS DOUBLE) AS lo, CAST(16 AS DOUBLE) AS hi)"]
    for i in range(rounds):
        out.append(f"""m{i} AS (SELECT lo, hi, (lo + hi) / 2 AS mid FROM b{i}),
s{i} AS (SELECT lo, hi, mid, (SELECT sum(above / (exp(mid) + j)) FROM h, m{i}) + (SELECT sum(n * (ln(exp(mid) / (exp(mid) + m)) + 1) - (n * exp(mid) + t) / (exp(mid) + m)) FROM g, m{i}) AS s FROM m{i}),
b{i + 1} AS MATERIALIZED (SELECT CASE WHEN s > 0 THEN mid ELSE lo END AS lo, CASE WHEN s > 0 THEN hi ELSE mid END AS hi FROM s{i})""")
    return ", ".join(out) + f", th AS (SELECT exp((lo + hi) / 2) AS theta FROM b{rounds})"


_LINE_COUNT_SQL = _COUNT_SQL.replace(
    "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1",
    "SELECT o_custkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")


def _line_counts(spark, sf):
    """Order lines per customer with the customer's segment; lines come in orders, so their counts are overdispersed."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, sf, "lineitem").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_mktsegment", F.coalesce("k", F.lit(0)).alias("k"))


@query(f"""WITH {_LINE_COUNT_SQL}, top AS (SELECT max(k) AS t FROM k),
h AS (SELECT j, (SELECT count(*) FROM k WHERE k.k > j) AS above FROM (SELECT unnest(range(0, t)) AS j FROM top)), {_bisected(44)},
w AS (SELECT seg, m, n * m / (1 + m / theta) AS w, theta FROM g, th), r AS (SELECT * FROM w WHERE seg = 'AUTOMOBILE')
SELECT '(Intercept)' AS term, {sql_rnd('ln(r.m)', 5)} AS estimate, {sql_rnd('sqrt(1 / r.w)', 5)} AS std_error, {sql_rnd('theta', 4)} AS theta FROM r
UNION ALL SELECT 'c_mktsegment[' || w.seg || ']', {sql_rnd('ln(w.m / r.m)', 5)}, {sql_rnd('sqrt(1 / r.w + 1 / w.w)', 5)}, {sql_rnd('w.theta', 4)} FROM w, r WHERE w.seg <> r.seg""")
def negative_binomial_profile(spark, sf):
    """Dispersion by profile likelihood."""
    df = _line_counts(spark, sf)
    fit = M.fit_negative_binomial(df, "k", _count_terms(df))
    return fit.coefficients(spark).select("term", *[rnd(c, 5).alias(c) for c in ("estimate", "std_error")], rnd(F.lit(fit.theta), 4).alias("theta"))


@query(f"""WITH {_COUNT_SQL}, th AS (SELECT greatest(sum((k - m) * (k - m) - m) / sum(m * m), 1e-8) AS it FROM k JOIN g USING (seg))
SELECT {sql_rnd('avg(CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END)', 5)} AS observed, {sql_rnd('avg(pow((1 / it) / (1 / it + m), 1 / it))', 5)} AS expected FROM k JOIN g USING (seg), th""")
def zero_share_check(spark, sf):
    df = _counts(spark, sf)
    terms = _count_terms(df)
    out = M.zero_share(df, "k", terms, M.fit_negative_binomial(df, "k", terms, dispersion="moment"))
    return out.select(rnd("observed", 5).alias("observed"), rnd("expected", 5).alias("expected"))


@query(f"""WITH {_COUNT_SQL}, th AS (SELECT greatest(sum((k - m) * (k - m) - m) / sum(m * m), 1e-8) AS it FROM k JOIN g USING (seg)),
w AS (SELECT seg, m, n * m / (1 + m * it) AS w FROM g, th)
SELECT seg AS c_mktsegment, {sql_rnd('m', 5)} AS predicted, {sql_rnd(f'm * exp(-{_Z} * sqrt(1 / w))', 5)} AS lower, {sql_rnd(f'm * exp({_Z} * sqrt(1 / w))', 5)} AS upper FROM w""")
def count_prediction(spark, sf):
    df = _counts(spark, sf)
    terms = _count_terms(df)
    out = M.count_band(M.fit_negative_binomial(df, "k", terms, dispersion="moment"), df.select("c_mktsegment").distinct(), terms)
    return out.select("c_mktsegment", *[rnd(c, 5).alias(c) for c in ("predicted", "lower", "upper")])
