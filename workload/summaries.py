"""Inequality summaries and distribution tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.operators import inequality as I
from arearisk.operators import profile as P
from arearisk.operators.quantiles import quantile_columns
from workload.base import big, registry, rnd, sql_rnd, table

QUERIES, SQL, query = registry()


# ---- inequality ------------------------------------------------------------

_INDICATORS = {"Price": ("o_totalprice", "max"), "Balance": ("c_acctbal", "min"), "Fires": ("late", "max")}
_LONG_SQL = """base AS (
  SELECT r_name AS country, o_custkey % 10 + 1 AS dep, o_custkey % 3 + 1 AS urb, o_totalprice, c_acctbal,
         CASE WHEN r_regionkey = 2 THEN NULL ELSE CAST(o_orderkey % 100 AS DOUBLE) END AS late
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
dom AS (SELECT *, 'Deprivation' AS domain, dep AS v FROM base UNION ALL SELECT *, 'Settlement', urb FROM base),
long AS (
  SELECT country, domain, v, 'Price' AS indicator, max(o_totalprice) AS x FROM dom GROUP BY 1, 2, 3
  UNION ALL SELECT country, domain, v, 'Balance', min(c_acctbal) FROM dom GROUP BY 1, 2, 3
  UNION ALL SELECT country, domain, v, 'Fires', max(late) FROM dom GROUP BY 1, 2, 3)"""


def _areas(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select(F.col("r_name").alias("country"), (F.col("o_custkey") % 10 + 1).alias("dep"), (F.col("o_custkey") % 3 + 1).alias("urb"),
                    "o_totalprice", "c_acctbal", F.when(F.col("r_regionkey") != 2, (F.col("o_orderkey") % 100).cast("double")).alias("late"))


def _extremes(spark, sf):
    return I.extremes(_areas(spark, sf), "country", {"Deprivation": "dep", "Settlement": "urb"}, _INDICATORS)


@query(f"WITH {_LONG_SQL} SELECT country, domain, CAST(v AS BIGINT) AS domain_value, indicator, {sql_rnd('x')} AS indicator_value FROM long")
def inequality_extremes(spark, sf):
    return _extremes(spark, sf).select("country", "domain", big("domain_value").alias("domain_value"), "indicator",
                                       rnd("indicator_value").alias("indicator_value"))


@query(f"""WITH {_LONG_SQL} SELECT country, domain, indicator, {sql_rnd('max(x)')} AS "max", {sql_rnd('min(x)')} AS "min",
       {sql_rnd('abs(max(x) - min(x))')} AS diff FROM long GROUP BY 1, 2, 3""")
def inequality_range(spark, sf):
    return I.ranges(_extremes(spark, sf)).select("country", "domain", "indicator", *[rnd(c).alias(c) for c in ("max", "min", "diff")])


@query(f"""WITH {_LONG_SQL} SELECT country, domain, indicator,
       {sql_rnd('abs(avg(x) FILTER (WHERE v = 1) - avg(x) FILTER (WHERE v = 10))')} AS mean_diff
FROM long WHERE domain = 'Deprivation' AND v IN (1, 10) GROUP BY 1, 2, 3""")
def inequality_gap(spark, sf):
    return I.gap(_extremes(spark, sf), "Deprivation", 1, 10).select("country", "domain", "indicator", rnd("mean_diff").alias("mean_diff"))


@query(f"""WITH {_LONG_SQL}, r AS (SELECT country, domain, indicator, max(x) AS hi, min(x) AS lo FROM long GROUP BY 1, 2, 3),
g AS (SELECT country, domain, indicator, abs(avg(x) FILTER (WHERE v = 1) - avg(x) FILTER (WHERE v = CASE domain WHEN 'Deprivation' THEN 10 ELSE 3 END)) AS gap FROM long GROUP BY 1, 2, 3)
SELECT r.country, r.domain, r.indicator, {sql_rnd('hi')} AS "max", {sql_rnd('lo')} AS "min", {sql_rnd('hi - lo')} AS diff, {sql_rnd('gap')} AS mean_diff
FROM r JOIN g USING (country, domain, indicator)""")
def inequality_summary(spark, sf):
    out = I.summary(_extremes(spark, sf), [("Deprivation", 1, 10), ("Settlement", 1, 3)])
    return out.select("country", "domain", "indicator", *[rnd(c).alias(c) for c in ("max", "min", "diff", "mean_diff")])


@query(f"WITH {_LONG_SQL} SELECT DISTINCT indicator FROM long")
def indicator_list(spark, sf):
    return I.indicator_list(_extremes(spark, sf))


# ---- distributions ---------------------------------------------------------

_PRICE_SQL = """p AS (SELECT r_name, o_totalprice AS x FROM orders JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def _prices(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select("r_name", F.col("o_totalprice").alias("x"))


@query(f"""WITH {_PRICE_SQL} SELECT r_name, {sql_rnd('min(x)')} AS minimum, {sql_rnd('quantile_cont(x, 0.25)', 4)} AS q1, {sql_rnd('quantile_cont(x, 0.5)', 4)} AS median,
       {sql_rnd('avg(x)', 3)} AS mean, {sql_rnd('quantile_cont(x, 0.75)', 4)} AS q3, {sql_rnd('max(x)')} AS maximum FROM p GROUP BY r_name""")
def profile_summary(spark, sf):
    out = P.six_numbers(_prices(spark, sf), "x", ["r_name"])
    return out.select("r_name", rnd("minimum").alias("minimum"), rnd("q1", 4).alias("q1"), rnd("median", 4).alias("median"),
                      rnd("mean", 3).alias("mean"), rnd("q3", 4).alias("q3"), rnd("maximum").alias("maximum"))


@query(f"""WITH {_PRICE_SQL} SELECT r_name, CAST(ceil(x / 20000.0 - 0.5) * 20000.0 AS DOUBLE) + 0.0 AS bin, count(*) AS n FROM p GROUP BY 1, 2""")
def profile_histogram(spark, sf):
    return P.histogram(_prices(spark, sf), "x", 20000, ["r_name"])


@query(f"""WITH {_PRICE_SQL}, q AS (SELECT r_name, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS md, quantile_cont(x, 0.75) AS q3 FROM p GROUP BY 1),
b AS (SELECT p.r_name, x, q1, md, q3, x >= q1 - 0.5 * (q3 - q1) AND x <= q3 + 0.5 * (q3 - q1) AS inside FROM p JOIN q USING (r_name))
SELECT r_name, {sql_rnd('min(q1)', 4)} AS q1, {sql_rnd('min(md)', 4)} AS median, {sql_rnd('min(q3)', 4)} AS q3, {sql_rnd('min(x) FILTER (WHERE inside)')} AS whisker_low,
       {sql_rnd('max(x) FILTER (WHERE inside)')} AS whisker_high, count(*) FILTER (WHERE NOT inside) AS n_outliers FROM b GROUP BY r_name""")
def profile_boxplot(spark, sf):
    # A short reach, so that these even prices have outliers at all.
    out = P.box(_prices(spark, sf), "x", ["r_name"], reach=0.5)
    return out.select("r_name", *[rnd(c, 4).alias(c) for c in ("q1", "median", "q3")],
                      rnd("whisker_low").alias("whisker_low"), rnd("whisker_high").alias("whisker_high"), "n_outliers")


def _spread_sql(centre: str) -> str:
    return f"""WITH {_PRICE_SQL}, s AS (SELECT r_name, {centre} AS c, coalesce(stddev_samp(x), 0) AS sd FROM p GROUP BY 1)
SELECT r_name, {sql_rnd('c', 3)} AS centre, {sql_rnd('sd', 3)} AS sd, {sql_rnd('c - sd', 3)} AS low, {sql_rnd('c + sd', 3)} AS high FROM s"""


def _spread(spark, sf, centre):
    return P.spread(_prices(spark, sf), "x", ["r_name"], centre).select("r_name", *[rnd(c, 3).alias(c) for c in ("centre", "sd", "low", "high")])


@query(_spread_sql("quantile_cont(x, 0.5)"))
def profile_spread(spark, sf):
    return _spread(spark, sf, "median")


@query(_spread_sql("avg(x)"))
def profile_spread_mean(spark, sf):
    return _spread(spark, sf, "mean")


@query(f"""WITH {_PRICE_SQL} SELECT r_name, {sql_rnd('sum(x)', 1)} AS total FROM p GROUP BY r_name""")
def totals_by_group(spark, sf):
    return P.totals(_prices(spark, sf), "x", ["r_name"]).select("r_name", rnd("total", 1).alias("total"))


_TAILS = (0.05, 0.5, 0.95)


def _weighted_sql() -> str:
    picks = []
    for p in _TAILS:
        for side, f in (("lo", "floor"), ("hi", "ceil")):
            picks.append(f"min(x) FILTER (up > {f}((n - 1) * CAST({p} AS DOUBLE))) AS {side}{round(p * 100)}")
    out = []
    for p in _TAILS:
        k, r = round(p * 100), f"((n - 1) * CAST({p} AS DOUBLE))"
        out.append(sql_rnd(f"lo{k} + ({r} - floor({r})) * (hi{k} - lo{k})", 4) + f" AS p{k}")
    return f"""WITH c AS (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS x, CAST(sum(l_quantity) AS BIGINT) AS w FROM lineitem GROUP BY 1, 2),
r AS (SELECT l_returnflag, x, sum(w) OVER (PARTITION BY l_returnflag ORDER BY x) AS up, sum(w) OVER (PARTITION BY l_returnflag) AS n FROM c),
v AS (SELECT l_returnflag, n, {", ".join(picks)} FROM r GROUP BY l_returnflag, n)
SELECT l_returnflag, {", ".join(out)} FROM v"""


@query(_weighted_sql())
def quantiles_bracketed(spark, sf):
    """Price per line, each line counted as often as its quantity says."""
    out = quantile_columns(table(spark, sf, "lineitem"), "l_extendedprice", {f"p{round(p * 100)}": p for p in _TAILS},
                           ["l_returnflag"], weight="l_quantity")
    return out.select("l_returnflag", *[rnd(f"p{round(p * 100)}", 4).alias(f"p{round(p * 100)}") for p in _TAILS])
