"""Codes, joins, roll-ups, aggregates, reshapes and windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.functions import nulls as N
from arearisk.functions import scalars as S
from arearisk.operators import hierarchy as H
from arearisk.operators import joins as J
from arearisk.operators import reshape as R
from arearisk.operators.quantiles import exact_quantiles
from arearisk.sources.readers import rename_from_descriptions
from workload.base import LADDER_SQL, LADS_SQL, big, country_sql, ladder, lads, registry, rnd, sql_rnd, strict_sql, table

QUERIES, SQL, query = registry()


# ---- rates and roll-ups ----------------------------------------------------

def area_events(spark, sf, denominator="areas_with_events"):
    """Finished orders per small area over its order lines."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    lad = ladder(spark, sf).select("c_custkey", "lsoa")
    # Lines are counted per order before the join, so the join carries one row per order.
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    people = (
        orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"])
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("n").alias("n_people"))
        .join(lad, "c_custkey").select("lsoa", "n_people")
    )
    events = orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey")).join(lad, "c_custkey").select("lsoa")
    return H.event_rate(events, people, "lsoa", "n_fires", "n_people", "dens_fires", denominator)


def _rate_rollup(spark, sf, denominator):
    small = area_events(spark, sf, denominator)
    return H.roll_up_rate(small, ladder(spark, sf), "lsoa", "area_code", "n_fires", "n_people", "dens_fires").select(
        "area_code", S.country_of("area_code").alias("country"), big("n_fires").alias("n_fires"),
        big("n_people").alias("n_people"), rnd("dens_fires").alias("dens_fires"))


AREA_EVENTS_SQL = """people AS (
  SELECT o_custkey AS c_custkey, count(*) AS n_people FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
fires AS (SELECT o_custkey AS c_custkey, count(*) AS n_fires FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)"""

_RATE_TAIL = f"""
SELECT area_code, {country_sql('area_code')} AS country, CAST({strict_sql('sum', 'n_fires')} AS BIGINT) AS n_fires,
       CAST({strict_sql('sum', 'n_people')} AS BIGINT) AS n_people,
       {sql_rnd(f"({strict_sql('sum', 'n_fires')}) * 1.0 / nullif(({strict_sql('sum', 'n_people')}), 0)")} AS dens_fires
FROM joined GROUP BY area_code"""


@query(f"""WITH {LADDER_SQL}, {AREA_EVENTS_SQL},
joined AS (SELECT l.area_code, f.n_fires, p.n_people FROM fires f JOIN ladder l USING (c_custkey) LEFT JOIN people p USING (c_custkey))
{_RATE_TAIL}""")
def area_rate_rollup(spark, sf):
    return _rate_rollup(spark, sf, "areas_with_events")


@query(f"""WITH {LADDER_SQL}, {AREA_EVENTS_SQL},
joined AS (SELECT l.area_code, coalesce(f.n_fires, 0) AS n_fires, p.n_people FROM people p JOIN ladder l USING (c_custkey) LEFT JOIN fires f USING (c_custkey))
{_RATE_TAIL}""")
def area_rate_all_areas(spark, sf):
    return _rate_rollup(spark, sf, "all_areas")


_VALUES_SQL = """vals AS (
  SELECT c_nationkey, c_mktsegment, CASE WHEN c_custkey % 11 = 0 AND c_nationkey % 2 = 0 THEN NULL
         WHEN c_nationkey = 7 THEN NULL ELSE c_acctbal END AS x, CAST(c_custkey % 10 + 1 AS BIGINT) AS w FROM customer)"""


def _values(spark, sf):
    """Balances with single gaps in even nations and a nation without any."""
    c = table(spark, sf, "customer")
    gap = ((F.col("c_custkey") % 11 == 0) & (F.col("c_nationkey") % 2 == 0)) | (F.col("c_nationkey") == 7)
    return c.select("c_nationkey", "c_mktsegment", F.when(~gap, F.col("c_acctbal")).alias("x"),
                    (F.col("c_custkey") % 10 + 1).alias("w"))


@query(f"""WITH {_VALUES_SQL}
SELECT c_nationkey, count(*) AS n, {sql_rnd(strict_sql('sum', 'x'), 4)} AS strict_sum, {sql_rnd(strict_sql('min', 'x'))} AS strict_min,
       {sql_rnd(strict_sql('max', 'x'))} AS strict_max, {sql_rnd('sum(x)', 4)} AS skip_sum, {sql_rnd('min(x)')} AS skip_min,
       {sql_rnd('max(x)')} AS skip_max, {sql_rnd('avg(x)', 4)} AS mean, {sql_rnd('coalesce(stddev_samp(x), 0)', 4)} AS sd,
       {sql_rnd('(coalesce(sum(x), 0) + coalesce(sum(w), 0)) / nullif(sum(w), 0)')} AS ratio
FROM vals GROUP BY c_nationkey""")
def strict_vs_skip_aggs(spark, sf):
    return _values(spark, sf).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), rnd(N.strict_sum("x"), 4).alias("strict_sum"), rnd(N.strict_min("x")).alias("strict_min"),
        rnd(N.strict_max("x")).alias("strict_max"), rnd(F.sum("x"), 4).alias("skip_sum"), rnd(F.min("x")).alias("skip_min"),
        rnd(F.max("x")).alias("skip_max"), rnd(F.avg("x"), 4).alias("mean"), rnd(N.sd_or_zero("x"), 4).alias("sd"),
        rnd(N.ratio_of_sums(["x", "w"], "w")).alias("ratio"))


@query(f"""WITH {_VALUES_SQL}
SELECT c_nationkey, {sql_rnd('quantile_cont(x, 0.5)')} AS median, {sql_rnd('quantile_cont(x, 0.9)')} AS p90
FROM vals WHERE x IS NOT NULL GROUP BY c_nationkey""")
def median_by_group(spark, sf):
    q = exact_quantiles(_values(spark, sf), "x", [0.5, 0.9], ["c_nationkey"])
    return q.groupBy("c_nationkey").agg(
        rnd(F.max(F.when(F.col("prob") == 0.5, F.col("quantile")))).alias("median"),
        rnd(F.max(F.when(F.col("prob") == 0.9, F.col("quantile")))).alias("p90"))


@query(f"""WITH {_VALUES_SQL}, fanned AS (SELECT c_nationkey, x, unnest(range(w)) AS copy FROM vals WHERE x IS NOT NULL)
SELECT c_nationkey, {sql_rnd('quantile_cont(x, 0.5)')} AS median FROM fanned GROUP BY c_nationkey""")
def median_weighted(spark, sf):
    q = exact_quantiles(_values(spark, sf), "x", [0.5], ["c_nationkey"], weight="w")
    return q.select("c_nationkey", rnd("quantile").alias("median"))


_AREA_VALUES_SQL = """area_vals AS (
  SELECT area_code, min(lad_code) AS lad_code, count(*) AS n_small,
         CASE WHEN n_small_code % 5 = 0 THEN 99 ELSE 1 + n_small_code % 5 END AS fires_q,
         avg(c_acctbal) AS value, sum(c_custkey % 3) AS part_a, sum(c_custkey % 2) AS part_b
  FROM (SELECT *, n_nationkey * 3 + ascii(c_mktsegment) AS n_small_code FROM ladder) GROUP BY area_code, n_small_code)"""


def _area_values(spark, sf):
    rows = ladder(spark, sf).withColumn("code", F.col("n_nationkey") * 3 + F.ascii("c_mktsegment"))
    return rows.groupBy("area_code", "code").agg(
        F.count(F.lit(1)).alias("n_small"), F.avg("c_acctbal").alias("value"),
        F.sum(F.col("c_custkey") % 3).alias("part_a"), F.sum(F.col("c_custkey") % 2).alias("part_b"),
    ).withColumn("fires_q", F.when(F.col("code") % 5 == 0, 99).otherwise(1 + F.col("code") % 5))


_WORST = (H.Measure("fires", "value", "fires_q", "max"), H.Measure("alone", None, None, "ratio", ("part_a", "part_b"), "n_small"))


def _worst(spark, sf, weight):
    out = H.roll_up_worst(_area_values(spark, sf), ladder(spark, sf), "area_code", "lad_code", _WORST, weight)
    return out.select("lad_code", big("worst_fires_q").alias("worst_fires_q"), rnd("worst_fires").alias("worst_fires"),
                      rnd("worst_alone").alias("worst_alone"), rnd("median_fires").alias("median_fires"))


def _worst_sql(fan: str) -> str:
    return f"""WITH {LADDER_SQL}, {_AREA_VALUES_SQL},
fan AS (SELECT a.* FROM area_vals a {fan})
SELECT lad_code, CAST({strict_sql('min', 'fires_q')} AS BIGINT) AS worst_fires_q, {sql_rnd('max(value)')} AS worst_fires,
       {sql_rnd('(sum(part_a) + sum(part_b)) * 1.0 / nullif(sum(n_small), 0)')} AS worst_alone,
       {sql_rnd('quantile_cont(value, 0.5)')} AS median_fires
FROM fan GROUP BY lad_code"""


@query(_worst_sql("JOIN ladder l ON l.area_code = a.area_code"))
def worst_of_rollup(spark, sf):
    return _worst(spark, sf, "children")


@query(_worst_sql(""))
def worst_of_rollup_unweighted(spark, sf):
    return _worst(spark, sf, "none")


# ---- codes, names, dates ---------------------------------------------------

@query(f"""WITH {LADDER_SQL}, codes AS (
  SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'K' || substr(lsoa, 2) ELSE lsoa END AS code FROM ladder)
SELECT {country_sql('code')} AS country, count(*) AS n,
       count(*) FILTER (WHERE code LIKE 'E%' OR code LIKE 'W%') AS n_ew,
       count(*) FILTER (WHERE NOT coalesce(substr(code, 1, 1) IN ('N', '9'), false)) AS n_not_ni,
       count(*) FILTER (WHERE NOT (code LIKE 'E%')) AS n_not_england
FROM codes GROUP BY 1""")
def area_code_country(spark, sf):
    code = F.when(F.col("c_custkey") % 13 == 0, F.lit(None)).when(
        F.col("c_custkey") % 17 == 0, F.concat(F.lit("K"), F.expr("substr(lsoa, 2)"))).otherwise(F.col("lsoa"))
    codes = ladder(spark, sf).select(code.alias("code"))
    return codes.groupBy(S.country_of("code").alias("country")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(S.has_prefix("code", ["E", "W"]), 1)).alias("n_ew"),
        F.count(F.when(N.not_in(F.substring("code", 1, 1), ["N", "9"]), 1)).alias("n_not_ni"),
        F.count(F.when(~S.has_prefix("code", ["E"]), 1)).alias("n_not_england"))


@query("""WITH kinds AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'E10' WHEN 1 THEN 'E11' WHEN 2 THEN 'E12' WHEN 3 THEN 'E06' ELSE 'S92' END
         || CASE WHEN s_suppkey % 5 = 4 THEN '000003' ELSE lpad(CAST(s_suppkey AS VARCHAR), 6, '0') END AS code FROM supplier)
SELECT CASE WHEN substr(code, 1, 3) IN ('E10', 'E11') THEN 'county' WHEN substr(code, 1, 3) = 'E12' THEN 'region'
            WHEN code = 'S92000003' THEN 'country' ELSE 'local authority' END AS kind, count(*) AS n, min(code) AS first_code
FROM kinds GROUP BY 1""")
def area_kind_split(spark, sf):
    s = table(spark, sf, "supplier")
    head = F.element_at(F.array(*[F.lit(x) for x in ("E10", "E11", "E12", "E06", "S92")]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    tail = F.when(F.col("s_suppkey") % 5 == 4, F.lit("000003")).otherwise(F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))
    codes = s.select(F.concat(head, tail).alias("code"))
    return codes.groupBy(S.area_kind("code").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("first_code"))


@query("""SELECT p_partkey,
  CAST(CASE WHEN p_size % 7 = 0 THEN NULL ELSE trunc(TRY_CAST(regexp_replace(substr(p_brand, 6), '^#', '') AS DOUBLE)) END AS BIGINT) AS rating,
  CASE WHEN d IS NULL THEN NULL WHEN regexp_matches(d, 'E[0-9]+') THEN d ELSE 'E' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') END AS code,
  CAST(trunc(TRY_CAST(t AS DOUBLE)) AS BIGINT) AS loose_integer,
  replace(p_name || ' & CCG', '&', 'and') AS name
FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'zone E' || CAST(p_size AS VARCHAR) WHEN 1 THEN p_name ELSE NULL END AS d,
             CASE p_partkey % 3 WHEN 0 THEN '3.7' WHEN 1 THEN CAST(p_size AS VARCHAR) ELSE 'x' END AS t FROM part)""")
def code_repair(spark, sf):
    p = table(spark, sf, "part")
    m = F.col("p_partkey") % 3
    d = F.when(m == 0, F.concat(F.lit("zone E"), F.col("p_size").cast("string"))).when(m == 1, F.col("p_name"))
    t = F.when(m == 0, F.lit("3.7")).when(m == 1, F.col("p_size").cast("string")).otherwise("x")
    style = F.when(F.col("p_size") % 7 != 0, F.expr("substr(p_brand, 6)"))
    return p.withColumns({"d": d, "t": t, "style": style,
                          "own": F.concat(F.lit("E"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))}).select(
        "p_partkey", big(S.rating("style")).alias("rating"), S.repair_code("d", "own").alias("code"),
        big(S.to_integer("t")).alias("loose_integer"), S.harmonise_name("p_name", " & CCG").alias("name"))


@query("""WITH d AS (SELECT o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) + 0.0 AS total, strftime(max(day), '%Y-%m-%d') AS day
FROM d WHERE day = (SELECT max(day) FROM d) GROUP BY o_custkey""")
def latest_period(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice", F.date_format("o_orderdate", "dd MMM yyyy").alias("text"))
    now = J.latest(o.withColumn("day", S.parse_period("text")), "day")
    return now.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"),
                                        F.date_format(F.max("day"), "yyyy-MM-dd").alias("day"))


@query("""SELECT l_returnflag, CASE WHEN l_linestatus = 'O' AND l_returnflag IN ('A', 'R') THEN 'open'
              WHEN l_discount >= 0.05 AND l_quantity < 25 THEN 'small' END AS pick, count(*) AS n
FROM lineitem WHERE (l_linestatus = 'O' AND l_returnflag IN ('A', 'R')) OR (l_discount >= 0.05 AND l_quantity < 25) GROUP BY 1, 2""")
def membership_filters(spark, sf):
    li = table(spark, sf, "lineitem")
    opened = (F.col("l_linestatus") == "O") & F.col("l_returnflag").isin("A", "R")
    small = (F.col("l_discount") >= 0.05) & (F.col("l_quantity") < 25)
    return li.filter(opened | small).groupBy(
        "l_returnflag", F.when(opened, "open").when(small, "small").alias("pick")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_VALUES_SQL}, m AS (SELECT c_nationkey, c_mktsegment, x, w, CASE WHEN w = 5 THEN NULL ELSE w END AS v FROM vals)
SELECT c_mktsegment, count(*) FILTER (WHERE x IS NOT NULL AND v IS NOT NULL) AS n_complete, count(x) AS n_present,
       CAST(sum(coalesce(v, 0)) AS BIGINT) AS v_filled, {sql_rnd('sum((x + v) / 2)', 3)} AS row_mean_sum,
       {sql_rnd('sum(x / nullif(v - 1, 0))', 3)} AS rate_sum, CAST(sum(v * w) AS BIGINT) AS product_sum
FROM m GROUP BY c_mktsegment""")
def missing_values(spark, sf):
    v = _values(spark, sf).withColumn("v", F.when(F.col("w") != 5, F.col("w")))
    kept = v.withColumn("complete", F.when(F.col("x").isNotNull() & F.col("v").isNotNull(), 1))
    return kept.groupBy("c_mktsegment").agg(
        F.count("complete").alias("n_complete"), F.count("x").alias("n_present"),
        big(F.sum(F.coalesce("v", F.lit(0)))).alias("v_filled"), rnd(F.sum(N.row_mean("x", "v")), 3).alias("row_mean_sum"),
        rnd(F.sum(N.ratio("x", F.col("v") - 1)), 3).alias("rate_sum"), big(F.sum(F.col("v") * F.col("w"))).alias("product_sum"))


@query(f"""SELECT p_type, {sql_rnd('exp(avg(p_retailprice) / 1000)')} AS avg_price, {sql_rnd('exp(max(p_size) / 10.0)')} AS size FROM part GROUP BY p_type""")
def map_numeric_columns(spark, sf):
    g = table(spark, sf, "part").groupBy("p_type").agg(
        (F.avg("p_retailprice") / 1000).alias("avg_price"), (F.max("p_size") / 10.0).alias("size"))
    return S.map_numeric(S.map_numeric(g, F.exp), lambda c: rnd(c))


@query("""SELECT CASE p_size % 2 WHEN 0 THEN 10 ELSE 1 END AS dep, p_partkey % 4 AS urb,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE
    (CASE p_size % 2 WHEN 0 THEN 'Least deprived, ' ELSE 'Most deprived, ' END) ||
    (CASE p_partkey % 4 WHEN 3 THEN 'mostly rural' WHEN 2 THEN 'mixed rural/urban' ELSE 'mostly urban' END) END AS label,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE (CASE p_size % 2 WHEN 0 THEN 0 ELSE 3 END) + (4 - p_partkey % 4) END AS label_order,
  count(*) AS n FROM part GROUP BY 1, 2, 3, 4""")
def class_pair_labels(spark, sf):
    p = table(spark, sf, "part").select(
        F.when(F.col("p_size") % 2 == 0, 10).otherwise(1).alias("dep"), (F.col("p_partkey") % 4).alias("urb"))
    label, order = S.class_pair_label("dep", "urb")
    return p.select(big("dep").alias("dep"), big("urb").alias("urb"), label.alias("label"), big(order).alias("label_order")).groupBy(
        "dep", "urb", "label", "label_order").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT p_type, p_brand FROM part""")
def distinct_sorted(spark, sf):
    p = table(spark, sf, "part")
    keep = S.columns_starting(p.select("p_type", "p_brand", "p_size"), "P_T", "p_b")
    return p.select(*keep).distinct().orderBy(*keep)


# ---- joins -----------------------------------------------------------------

_OLD_SQL = "old_codes AS (SELECT s_suppkey, 'Z' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS old_cd, s_name AS old_nm FROM supplier)"
_NEW_SQL = """new_codes AS (SELECT 'Y' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS new_cd, CASE WHEN s_suppkey % 7 = 3 THEN s_name || ' (new)' ELSE s_name END AS new_nm FROM supplier)"""


def _code_lists(spark, sf):
    s = table(spark, sf, "supplier")
    key = F.lpad(F.col("s_suppkey").cast("string"), 6, "0")
    old = s.select("s_suppkey", F.concat(F.lit("Z"), key).alias("old_cd"), F.col("s_name").alias("old_nm"))
    # Some new codes have another name, so the old ones of that name have no successor.
    named = F.when(F.col("s_suppkey") % 7 == 3, F.concat("s_name", F.lit(" (new)"))).otherwise(F.col("s_name"))
    new = s.select(F.concat(F.lit("Y"), key).alias("new_cd"), named.alias("new_nm"))
    gone = J.without_successor(old, new, "old_nm", "new_nm")
    # Merged areas: every code without a namesake goes to a neighbour that is already the successor of another.
    merged = gone.select("old_cd", F.concat(F.lit("Y"), F.lpad((F.col("s_suppkey") - F.col("s_suppkey") % 7).cast("string"), 6, "0")).alias("new_cd"))
    return old, new, gone, merged


_SUCC_SQL = f"""{_OLD_SQL}, {_NEW_SQL},
gone AS (SELECT * FROM old_codes o WHERE NOT EXISTS (SELECT 1 FROM new_codes n WHERE n.new_nm = o.old_nm)),
succ AS (SELECT o.old_cd, n.new_cd FROM old_codes o JOIN new_codes n ON n.new_nm = o.old_nm
         UNION ALL SELECT old_cd, 'Y' || lpad(CAST(s_suppkey - s_suppkey % 7 AS VARCHAR), 6, '0') FROM gone)"""


@query(f"WITH {_SUCC_SQL} SELECT * FROM succ")
def code_succession(spark, sf):
    old, new, _, merged = _code_lists(spark, sf)
    return J.successors(old, new, merged, "old_cd", "old_nm", "new_cd", "new_nm")


@query(f"WITH {_SUCC_SQL} SELECT old_cd, old_nm FROM gone")
def codes_without_successor(spark, sf):
    return _code_lists(spark, sf)[2].select("old_cd", "old_nm")


@query("""WITH data AS (SELECT CASE WHEN o_custkey % 9 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS code FROM orders),
look AS (SELECT c_custkey AS code FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0),
d AS (SELECT code, count(*) AS n FROM data GROUP BY code), k AS (SELECT code, count(*) AS m FROM look GROUP BY code)
SELECT CAST(sum(CASE WHEN m IS NULL THEN n ELSE 0 END) AS BIGINT) AS rows_unmatched, CAST(sum(CASE WHEN m IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS codes_unmatched,
       CAST(sum(CASE WHEN m > 1 THEN 1 ELSE 0 END) AS BIGINT) AS codes_fanned_out, CAST(sum(CASE WHEN m > 1 THEN n * (m - 1) ELSE 0 END) AS BIGINT) AS rows_added
FROM d LEFT JOIN k USING (code)""")
def code_audit(spark, sf):
    data = table(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 9 == 0, F.col("o_custkey") + 100000000).otherwise(F.col("o_custkey")).alias("code"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("code"))
    return J.audit(data, c.unionByName(c.filter(F.col("code") % 4 == 0)), "code")


@query(f"""WITH {LADS_SQL},
a AS (SELECT CASE WHEN s_acctbal > 6000 THEN s_nationkey END AS s_nationkey, count(*) AS n_sup FROM supplier GROUP BY 1),
b AS (SELECT CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS c_nationkey, max(c_acctbal) AS top FROM customer GROUP BY 1),
c AS (SELECT c_nationkey, min(c_acctbal) AS low FROM customer GROUP BY 1)
SELECT lad_code, lad_name, n_sup, {sql_rnd('top')} AS top, {sql_rnd('low')} AS low
FROM lads LEFT JOIN a ON n_nationkey = s_nationkey LEFT JOIN b ON n_nationkey = b.c_nationkey LEFT JOIN c ON n_nationkey = c.c_nationkey""")
def star_left_join(spark, sf):
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    # Rows without a key have no partner.
    a = s.groupBy(F.when(F.col("s_acctbal") > 6000, F.col("s_nationkey")).alias("s_nationkey")).agg(F.count(F.lit(1)).alias("n_sup"))
    b = c.groupBy(F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey")).alias("c_nationkey")).agg(rnd(F.max("c_acctbal")).alias("top"))
    d = c.groupBy("c_nationkey").agg(rnd(F.min("c_acctbal")).alias("low"))
    return J.star(lads(spark, sf), (a, {"n_nationkey": "s_nationkey"}), (b, {"n_nationkey": "c_nationkey"}),
                  (d, {"n_nationkey": "c_nationkey"})).select("lad_code", "lad_name", "n_sup", "top", "low")


@query("""SELECT nk AS key, count(*) AS n, count(r_name) AS n_named FROM (
  SELECT CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_nationkey % 5 END AS nk FROM customer) x
  LEFT JOIN (SELECT CASE WHEN r_regionkey = 2 THEN NULL ELSE r_regionkey END AS rk, r_name FROM region) r ON x.nk IS NOT DISTINCT FROM r.rk
GROUP BY nk""")
def missing_keys_join(spark, sf):
    c = table(spark, sf, "customer").select(F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey") % 5).alias("key"))
    r = table(spark, sf, "region").select(F.when(F.col("r_regionkey") != 2, F.col("r_regionkey")).alias("rk"), "r_name")
    return J.attach(c, r, {"key": "rk"}, null_safe=True).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count("r_name").alias("n_named"))


@query(f"""WITH {LADDER_SQL}
SELECT DISTINCT lsoa, CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE 'F' || CAST(n_nationkey % 6 AS VARCHAR) END AS fra FROM ladder""")
def composed_lookup(spark, sf):
    lower = ladder(spark, sf).select("lsoa", "lad_code")
    upper = lads(spark, sf).select(
        "lad_code", F.when(F.col("n_nationkey") % 6 != 5, F.concat(F.lit("F"), (F.col("n_nationkey") % 6).cast("string"))).alias("fra"))
    return J.compose(lower, upper, "lsoa", "lad_code", "fra")


@query("""SELECT s_nationkey AS nation, count(*) AS n, count(bal) AS n_bal, count(seg) AS n_seg FROM (
  SELECT s_nationkey, s_acctbal AS bal, NULL AS seg FROM supplier UNION ALL SELECT c_nationkey, NULL, c_mktsegment FROM customer) GROUP BY 1""")
def union_missing_columns(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal"))
    b = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg"))
    return J.union_filled(a, b).groupBy("nation").agg(
        F.count(F.lit(1)).alias("n"), F.count("bal").alias("n_bal"), F.count("seg").alias("n_seg"))


@query(f"""WITH {LADDER_SQL}, promoted AS (
  SELECT lsoa, CASE WHEN lsoa LIKE '9%' THEN lsoa ELSE area_code END AS area FROM ladder)
SELECT {country_sql('area')} AS country, count(*) AS n, count(DISTINCT area) AS n_areas FROM promoted GROUP BY 1""")
def promote_child_code(spark, sf):
    l = ladder(spark, sf)
    rest = l.filter(~S.has_prefix("lsoa", ["9"])).select("lsoa", F.col("area_code").alias("area"))
    own = l.filter(S.has_prefix("lsoa", ["9"])).select("lsoa", F.col("lsoa").alias("area"))
    per_area = J.union_filled(rest, own).groupBy(S.country_of("area").alias("country"), "area").agg(F.count(F.lit(1)).alias("n"))
    return per_area.groupBy("country").agg(big(F.sum("n")).alias("n"), F.count(F.lit(1)).alias("n_areas"))


# ---- reshapes and windows --------------------------------------------------

_TYPES = ["view", "error", "signup", "purchase", "click"]


@query(f"""SELECT user_id, {', '.join(
    f"CASE WHEN count(*) FILTER (WHERE event_type = '{t}') = 0 THEN 0.0 WHEN count(v) FILTER (WHERE event_type = '{t}') = count(*) FILTER (WHERE event_type = '{t}') THEN round(sum(v) FILTER (WHERE event_type = '{t}'), 2) + 0.0 END AS {t}" for t in _TYPES)}
FROM (SELECT *, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS v FROM events) GROUP BY user_id""")
def pivot_sum_fill0(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("v"))
    wide = R.pivot_sum(e, ["user_id"], "event_type", "v", _TYPES, 0.0)
    return wide.select("user_id", *[rnd(t, 2).alias(t) for t in _TYPES])


@query("""WITH t AS (SELECT p_brand, sum(CASE WHEN p_type = 'SMALL' THEN p_size END) AS a, sum(p_size) AS b, sum(p_partkey % 5) AS c FROM part GROUP BY p_brand)
SELECT p_brand, CAST(a AS BIGINT) AS "Small: Total", CAST(b AS BIGINT) AS "All: Total", CAST(c AS BIGINT) AS "Other" FROM t""")
def rename_from_metadata(spark, sf):
    p = table(spark, sf, "part").select("p_brand", F.when(F.col("p_type") == "SMALL", F.col("p_size")).otherwise(0).alias("Q1"),
                                        F.col("p_size").alias("Q2"), (F.col("p_partkey") % 5).alias("Q3"))
    summed = R.sum_all(p, "p_brand")
    names = spark.createDataFrame([("Q1", "Small: Total"), ("Q2", "All: Total"), ("Q3", "Other")], "code string, description string")
    out = rename_from_descriptions(summed, names, "code", "description")
    return out.select("p_brand", *[F.col(f"`{c}`").cast("long").alias(c) for c in out.columns[1:]])


@query(f"""SELECT event_id, user_id, {sql_rnd('last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)')} AS filled
FROM (SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)""")
def fill_down(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    # Small blocks, so that values are carried between blocks on every table size.
    return R.fill_down(e, ["user_id"], "event_id", "v", "filled", block_rows=1000).select("event_id", "user_id", rnd("filled").alias("filled"))


@query("""SELECT c_nationkey, o_custkey, n FROM (
  SELECT c_nationkey, o_custkey, n, rank() OVER (PARTITION BY c_nationkey ORDER BY n DESC) AS r FROM (
    SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey) WHERE r <= 2""")
def top_n_ties(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return R.top_n(n.join(c, "o_custkey"), ["c_nationkey"], "n", 2).select("c_nationkey", "o_custkey", "n")


@query(f"""WITH t AS (SELECT c_nationkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Urban' WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'Rural' END AS ruc FROM customer)
SELECT c_nationkey, count(*) FILTER (WHERE ruc = 'Urban') AS "Urban", count(*) FILTER (WHERE ruc = 'Rural') AS "Rural", count(*) FILTER (WHERE ruc IS NULL) AS missing,
       {sql_rnd("count(*) FILTER (WHERE ruc = 'Urban') * 1.0 / nullif(count(ruc), 0)")} AS prop_urban,
       {sql_rnd("(count(*) FILTER (WHERE ruc = 'Urban') + count(*) FILTER (WHERE ruc IS NULL) / 2.0) / nullif(count(*), 0)")} AS prop_mixed
FROM t GROUP BY c_nationkey""")
def crosstab_share(spark, sf):
    codes = {"AUTOMOBILE": "A1", "BUILDING": "C2", "FURNITURE": "Z9", "HOUSEHOLD": "D1", "MACHINERY": "F2"}
    code = None
    for seg, c in codes.items():
        code = (F if code is None else code).when(F.col("c_mktsegment") == seg, c)
    t = table(spark, sf, "customer").withColumn("ruc", S.settlement_of_code(code))
    x = R.share(R.crosstab(t, "c_nationkey", "ruc", ["Urban", "Rural"]), "Urban", ["Rural"], "prop_urban")
    return x.withColumn("prop_mixed", rnd(S.mixed_share("Urban", "missing", "Rural"))).withColumn("prop_urban", rnd("prop_urban"))


@query(f"""SELECT o_orderstatus, {', '.join(f"{sql_rnd(f'avg(o_totalprice) FILTER (WHERE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) = {i})', 4)} AS prio_{i}" for i in (1, 5))}
FROM orders GROUP BY o_orderstatus""")
def pivot_prefixed(spark, sf):
    o = table(spark, sf, "orders").withColumn("prio", F.substring("o_orderpriority", 1, 1).cast("int")).filter(F.col("prio").isin(1, 5))
    mean = o.groupBy("o_orderstatus", "prio").agg(rnd(F.avg("o_totalprice"), 4).alias("mean"))
    return R.pivot_prefixed(mean, ["o_orderstatus"], "prio", "mean", [1, 5], "prio_")


@query("""SELECT l_returnflag, measure, round(avg(amount), 6) + 0.0 AS mean, count(*) AS n, count(amount) AS n_present FROM (
  SELECT l_returnflag, 'quantity' AS measure, l_quantity AS amount FROM lineitem
  UNION ALL SELECT l_returnflag, 'discount', CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END FROM lineitem) GROUP BY 1, 2""")
def wide_to_long(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").alias("quantity"),
                                             F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount"))
    return R.to_long(li, ["l_returnflag"], ["quantity", "discount"], "measure", "amount").groupBy("l_returnflag", "measure").agg(
        rnd(F.avg("amount")).alias("mean"), F.count(F.lit(1)).alias("n"), F.count("amount").alias("n_present"))


@query("""SELECT c_nationkey AS lad, count(*) AS n, sum(CASE WHEN q = 99 THEN 0 ELSE q END) AS q_sum, min(CASE WHEN q = 99 THEN 0 ELSE q END) AS q_min FROM (
  SELECT c_nationkey, CAST(CASE WHEN c_custkey % 6 = 0 THEN 99 ELSE c_custkey % 6 END AS BIGINT) AS q FROM customer) GROUP BY 1""".replace("sum(CASE", "CAST(sum(CASE").replace(" END) AS q_sum", " END) AS BIGINT) AS q_sum"))
def sentinel_recode(spark, sf):
    from arearisk.operators.combine import clear_sentinel, fill_classes

    c = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("lad"), F.when(F.col("c_custkey") % 6 != 0, (F.col("c_custkey") % 6).cast("int")).alias("risk_Q"))
    t = clear_sentinel(fill_classes(c, ["risk_Q"]))
    return t.groupBy("lad").agg(F.count(F.lit(1)).alias("n"), big(F.sum("risk_Q")).alias("q_sum"), big(F.min("risk_Q")).alias("q_min"))
