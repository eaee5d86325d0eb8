"""Classification, labels and the nation plan."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from arearisk.functions import scalars as S
from arearisk.operators import combine as K
from arearisk.operators.classify import class_intervals, classify, natural_breaks
from arearisk.operators.hierarchy import roll_up_rate
from arearisk.operators.reshape import crosstab, share
from arearisk.plans import nations as NP
from arearisk.scratch import materialize
from workload.areas import AREA_EVENTS_SQL, area_events
from workload.base import (
    LADDER_SQL, LADS_SQL, big, breaks_sql, class_sql, country_sql, ladder, lads, registry, rnd, sql_rnd, strict_sql, table,
)

QUERIES, SQL, query = registry()


# Fixed values, written down here once more so that the SQL does not follow the plan that it checks.
_ROLLED = ("fires", "floods", "lonely", "health", "alone", "imd")
_LABELS = {
    "fires": "Fires", "floods": "Flooding", "displacement": "Displacement", "migrant_dest": "Migrant destitution", "lonely": "Loneliness",
    "health": "Health deprivation", "hle_birth": "Healthy life expectancy", "digital": "Digital exclusion", "alone": "Living alone",
    "imd": "IMD", "destitution": "All destitution"}
_LAD_ORDER = {
    "England": ("fires", "floods", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
    "Wales": ("floods", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
    "Scotland": ("fires", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
    "Northern Ireland": ("floods", "displacement", "health", "lonely", "hle_birth", "digital", "alone", "imd")}
_SERVICE_ORDER = ("fires", "floods", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution")
_TITLES = {
    "fires": "Fire risk", "floods": "Flooding risk", "displacement": "Displacement risk", "migrant_dest": "Migrant destitution risk",
    "lonely": "Loneliness risk", "health": "Health deprivation risk", "hle_birth": "Healthy life expectancy risk",
    "digital": "Digital exclusion risk", "alone": "Living alone risk", "imd": "Multiple deprivation risk", "destitution": "All destitution risk"}


def _lad_class(indicator: str) -> str:
    return f"worst_{indicator}_q" if indicator in _ROLLED else f"{indicator}_q"


def _per_class(df, value, by=()):
    return df.groupBy(*by, f"{value}_q", f"{value}_q_name").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.min(value), 2).alias("lowest"), rnd(F.max(value), 2).alias("highest"))


def _per_class_sql(source: str, value: str, k: int, by: str | None) -> str:
    """Rows per class with interval labels, for classes found by the plain dynamic programme."""
    grp = by or "0"
    lead = f"g.grp AS {by}, " if by else ""
    return f"""WITH src AS (SELECT {grp} AS grp, {value} AS x FROM {source}),
{breaks_sql('src', k)},
g AS (SELECT grp, kk, t, lo, hi, lag(hi) OVER (PARTITION BY grp ORDER BY t) AS prev FROM nb)
SELECT {lead}CAST(g.kk - g.t + 1 AS INTEGER) AS {value}_q,
       CASE WHEN g.t = 1 THEN '[' || printf('%.2f', g.lo) ELSE '(' || printf('%.2f', g.prev) END || ', ' || printf('%.2f', g.hi) || ']' AS {value}_q_name,
       CAST(sum(v.n) AS BIGINT) AS n, {sql_rnd('min(v.x)', 2)} AS lowest, {sql_rnd('max(v.x)', 2)} AS highest
FROM g JOIN nb_v v ON v.grp = g.grp AND v.x >= g.lo AND v.x <= g.hi GROUP BY ALL"""


@query(_per_class_sql("lineitem", "l_quantity", 5, None))
def natural_breaks_k5(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity")
    return _per_class(classify(li, "l_quantity", k=5, label_pattern="%.2f"), "l_quantity")


@query(_per_class_sql("lineitem", "l_discount", 3, "l_returnflag"))
def natural_breaks_grouped(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_discount")
    return _per_class(classify(li, "l_discount", k=3, by=["l_returnflag"], label_pattern="%.2f"), "l_discount", ["l_returnflag"])


@query(_per_class_sql("customer", "c_acctbal", 5, "c_nationkey"))
def natural_breaks_balances(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    return _per_class(classify(c, "c_acctbal", k=5, by=["c_nationkey"], label_pattern="%.2f"), "c_acctbal", ["c_nationkey"])


@query(f"""WITH src AS (SELECT o_orderstatus AS grp, round(CAST(o_totalprice AS DOUBLE) / 2500) AS x FROM orders),
{breaks_sql('src', 5)}
SELECT grp AS o_orderstatus, t, kk AS n_classes, lo, hi FROM nb""")
def natural_breaks_refined(spark, sf):
    """Few bins and few values at a time, so that nearly all breaks come from the refining rounds."""
    o = table(spark, sf, "orders").select("o_orderstatus", F.round(F.col("o_totalprice").cast("double") / 2500).alias("x"))
    out = natural_breaks(o, "x", 5, ["o_orderstatus"], bins=64, exact_rows=100)
    each = out.select("o_orderstatus", "n_classes", F.posexplode(F.arrays_zip("lowers", "uppers")).alias("at", "c"))
    return each.select("o_orderstatus", (F.col("at") + 1).alias("t"), big("n_classes").alias("n_classes"), F.col("c.lowers").alias("lo"), F.col("c.uppers").alias("hi"))


@query()
def natural_breaks_prices(spark, sf):
    """Nearly every value distinct: the refining rounds run on any table above 50,000 rows per group."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return natural_breaks(li, "l_extendedprice", 10, ["l_returnflag"])


@query(f"""WITH q AS (SELECT c_mktsegment, quantile_cont(c_acctbal, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS u FROM customer GROUP BY 1),
c AS (SELECT customer.c_mktsegment, c_acctbal,
  5 - (CASE WHEN c_acctbal > u[2] THEN 1 ELSE 0 END) - (CASE WHEN c_acctbal > u[3] THEN 1 ELSE 0 END)
    - (CASE WHEN c_acctbal > u[4] THEN 1 ELSE 0 END) - (CASE WHEN c_acctbal > u[5] THEN 1 ELSE 0 END) AS cls
  FROM customer JOIN q ON q.c_mktsegment = customer.c_mktsegment)
SELECT c_mktsegment, cls AS c_acctbal_q, count(*) AS n, {sql_rnd('min(c_acctbal)', 2)} AS lowest, {sql_rnd('max(c_acctbal)', 2)} AS highest
FROM c GROUP BY 1, 2""")
def quantile_classes(spark, sf):
    c = table(spark, sf, "customer").select("c_mktsegment", "c_acctbal")
    out = classify(c, "c_acctbal", k=5, by=["c_mktsegment"], method="quantile", label=False)
    return out.groupBy("c_mktsegment", "c_acctbal_q").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.min("c_acctbal"), 2).alias("lowest"), rnd(F.max("c_acctbal"), 2).alias("highest"))


@query("""SELECT CAST(d AS BIGINT) AS decile, CASE WHEN d BETWEEN 1 AND 10 THEN CAST(ceil(d / 2.0) AS BIGINT) END AS quintile,
       6 - CAST(ceil(d / 2.0) AS BIGINT) AS reversed, CASE WHEN d IS NULL THEN NULL WHEN d > 4 THEN 1 ELSE 5 END AS two, count(*) AS n
FROM (SELECT CASE WHEN p_size > 48 THEN NULL ELSE (p_size - 1) // 4 END AS d FROM part) GROUP BY ALL""")
def decile_quintile(spark, sf):
    p = table(spark, sf, "part").select(F.when(F.col("p_size") <= 48, F.floor((F.col("p_size") - 1) / 4)).alias("d"))
    return p.groupBy(big("d").alias("decile"), big(S.quintile_of_decile("d")).alias("quintile"), big(S.reverse_half("d")).alias("reversed"),
                     S.two_class(F.col("d") - 4).alias("two")).agg(F.count(F.lit(1)).alias("n"))


# ---- labels and scores -----------------------------------------------------

_CLS = [("fires", "Fires", 3), ("floods", "Flooding", 5), ("lonely", "Loneliness", 7), ("health", "Health deprivation", 2)]
_CLASS_COLS = ", ".join(f"CASE WHEN c_custkey % {m + 4} = 1 THEN NULL ELSE CAST(c_custkey // {m} % 6 AS BIGINT) END AS {n}_q" for n, _, m in _CLS)


def _classes(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", *[
        F.when(F.col("c_custkey") % (m + 4) != 1, F.floor(F.col("c_custkey") / m) % 6).alias(f"{n}_q") for n, _, m in _CLS])


_LABEL_SQL = "nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN {n}_q = 1 THEN '{t}' END" for n, t, _ in _CLS) + "), '')"
_SCORE_SQL = ("CASE WHEN coalesce(" + ", ".join(f"{n}_q" for n, _, _ in _CLS) + ") IS NOT NULL THEN "
              + " * ".join(f"coalesce(CAST({n}_q AS DOUBLE), 1)" for n, _, _ in _CLS) + " END")
_SKIP_SQL = ("CASE WHEN coalesce(" + ", ".join(f"nullif({n}_q, 0)" for n, _, _ in _CLS) + ") IS NOT NULL THEN "
             + " * ".join(f"coalesce(CAST(nullif({n}_q, 0) AS DOUBLE), 1)" for n, _, _ in _CLS) + " END")
_COUNT_SQL = " + ".join(f"CASE WHEN {n}_q = 1 THEN 1 ELSE 0 END" for n, _, _ in _CLS)


@query(f"""SELECT c_custkey, {_LABEL_SQL} AS combined_risk, {_SCORE_SQL} AS total_score, {_SKIP_SQL} AS score_no_zero,
       CAST({_COUNT_SQL} AS BIGINT) AS n_highest FROM (SELECT c_custkey, {_CLASS_COLS} FROM customer)""")
def combined_label(spark, sf):
    cols = [f"{n}_q" for n, _, _ in _CLS]
    return _classes(spark, sf).select(
        "c_custkey", K.combined_label([(f"{n}_q", t) for n, t, _ in _CLS]).alias("combined_risk"),
        K.total_score(cols).alias("total_score"), K.total_score(cols, skip_zero=True).alias("score_no_zero"),
        big(K.count_highest(cols)).alias("n_highest"))


@query(f"""SELECT c_name AS "Local Authority", fires_q AS "Fire risk", {_LABEL_SQL} AS "Combined risk",
       {_SCORE_SQL} AS "Total score", CAST({_COUNT_SQL} AS INTEGER) AS "No. 1s" FROM (SELECT c_custkey, c_name, {_CLASS_COLS} FROM customer)
ORDER BY 5 DESC NULLS LAST, 4 NULLS LAST""")
def risk_report(spark, sf):
    cols = [f"{n}_q" for n, _, _ in _CLS]
    t = _classes(spark, sf).withColumn("combined_risk", K.combined_label([(f"{n}_q", x) for n, x, _ in _CLS]))
    return K.report(t, [("c_name", "Local Authority"), ("fires_q", "Fire risk"), ("combined_risk", "Combined risk")], cols)


# ---- the nation plan on the ladder -----------------------------------------

def nation_inputs(spark, sf) -> NP.Inputs:
    """Indicators of all nations made from the driver tables."""
    lad, l = lads(spark, sf), ladder(spark, sf)
    # Two tables are made of the events; they are counted once.
    small = materialize(area_events(spark, sf), "processed-events")
    fires = roll_up_rate(small, l, "lsoa", "area_code", "n_fires", "n_people", "dens_fires")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    sup = table(spark, sf, "supplier").join(lad, F.col("s_nationkey") == F.col("n_nationkey"))
    prio = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_all"), F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("n_one"),
        F.count(F.when(F.col("o_orderpriority") == "5-LOW", 1)).alias("n_lone"),
        F.count(F.when(F.col("o_totalprice") > 350000, 1)).alias("n_flood"))
    people = l.join(prio, "c_custkey")
    alone = people.groupBy("area_code").agg(
        F.sum("n_all").alias("n_people_total"), F.sum("n_one").alias("n_one_person_hh"), F.sum("n_lone").alias("n_lone_parents"))
    alone = alone.withColumn("prop_alone", (F.col("n_one_person_hh") + F.col("n_lone_parents")) / F.col("n_people_total"))
    floods = people.filter("c_acctbal < 0").groupBy("area_code").agg(F.sum("n_flood").alias("n_people_flood"))
    band = F.floor((F.col("c_acctbal") + 1000) / 1100.1) + 1
    deciles = l.select("lsoa", band.cast("int").alias("imd_decile"),
                       F.when(F.col("c_custkey") % 40 != 3, (11 - band).cast("int")).alias("health_decile"))
    merged = F.when(F.col("n_nationkey") == 20, F.concat(F.lit("E"), F.lpad(F.lit("15"), 3, "0"))).otherwise(F.col("lad_code"))
    per_lad = sup.groupBy("lad_code").agg(
        F.count(F.when(F.col("s_acctbal") > 4000, 1)).alias("sec95"), F.sum(F.col("s_suppkey") % 7).alias("digital_total_mult"),
        F.avg("s_acctbal").alias("hle_birth"), F.count(F.when(F.col("s_acctbal") < 0, 1)).alias("debts"))
    # Processed tables are stored before the nation plan reads them, as they are in production. They do not depend on
    # each other, so their jobs run side by side.
    def stored(**frames):
        with ThreadPoolExecutor(len(frames)) as pool:
            return dict(zip(frames, pool.map(lambda f: materialize(f[1], f"processed-{f[0]}"), frames.items())))

    keep = stored(
        fires=fires, floods=floods, alone=alone, per_lad=per_lad, deciles=deciles,
        lookup=l.select("lsoa", "area_code", "lad_code", "lad_name"),
        loneliness=l.groupBy("area_code").agg(F.avg("c_acctbal").alias("loneills_2018")),
        service_fires=small.join(l, "lsoa").filter(F.col("n_regionkey") == 1).groupBy(
            F.concat(F.lit("W5"), (F.col("n_nationkey") % 2).cast("string")).alias("service_code")).agg(
            (F.sum("n_fires") / F.sum("n_people")).alias("dens_fires")),
    )
    per_lad, lad19 = keep.pop("per_lad"), F.col("lad_code").alias("lad19cd")
    return NP.Inputs(
        areas=keep["lookup"].select("area_code").distinct(), **keep,
        lad_successor=lad.select("lad_code", merged.alias("lad19cd")),
        displacement=per_lad.select(lad19, "sec95"), digital=per_lad.select("lad_code", "digital_total_mult"),
        life=per_lad.select("lad_code", "hle_birth"),
        destitution=lad.filter(F.col("n_regionkey") < 3).select(
            "lad_code", (F.col("n_nationkey") % 10 + 1).alias("destitution_all"),
            (F.col("n_nationkey") * 3 % 10 + 1).alias("destitution_migrant")),
        presence=per_lad.select(lad19, F.when(F.col("debts") > 0, "Yes").otherwise("No").alias("presence_services")),
        service_lookup=lad.filter(F.col("n_regionkey") == 1).select(
            "lad_code", F.concat(F.lit("W5"), (F.col("n_nationkey") % 2).cast("string")).alias("service_code"),
            F.concat(F.lit("Service "), (F.col("n_nationkey") % 2).cast("string")).alias("service_name")),
    )


_INPUT_SQL = f"""{LADDER_SQL}, {LADS_SQL}, {AREA_EVENTS_SQL},
fires_t AS (SELECT l.area_code, {strict_sql('sum', 'f.n_fires')} AS n_fires, {strict_sql('sum', 'p.n_people')} AS n_people
  FROM fires f JOIN ladder l USING (c_custkey) LEFT JOIN people p USING (c_custkey) GROUP BY 1),
prio AS (SELECT o_custkey AS c_custkey, count(*) AS n_all, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_one,
  count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_lone, count(*) FILTER (WHERE o_totalprice > 350000) AS n_flood FROM orders GROUP BY 1),
alone_t AS (SELECT area_code, sum(n_all) AS n_people_total, sum(n_one) AS n_one, sum(n_lone) AS n_lone,
  (sum(n_one) + sum(n_lone)) * 1.0 / sum(n_all) AS prop_alone FROM ladder JOIN prio USING (c_custkey) GROUP BY 1),
flood_t AS (SELECT area_code, sum(n_flood) AS n_people_flood FROM ladder JOIN prio USING (c_custkey) WHERE c_acctbal < 0 GROUP BY 1),
lonely_t AS (SELECT area_code, avg(c_acctbal) AS loneills FROM ladder GROUP BY 1),
dec AS (SELECT area_code, floor((c_acctbal + 1000) / 1100.1) + 1 AS imd,
  CASE WHEN c_custkey % 40 = 3 THEN NULL ELSE 11 - (floor((c_acctbal + 1000) / 1100.1) + 1) END AS health FROM ladder),
dec_t AS (SELECT area_code, CAST({strict_sql('min', 'health')} AS INTEGER) AS worst_health, CAST({strict_sql('min', 'imd')} AS INTEGER) AS worst_imd FROM dec GROUP BY 1),
per_lad AS (SELECT lad_code, count(*) FILTER (WHERE s_acctbal > 4000) AS sec95, sum(s_suppkey % 7) AS digital, avg(s_acctbal) AS hle,
  CASE WHEN count(*) FILTER (WHERE s_acctbal < 0) > 0 THEN 'Yes' ELSE 'No' END AS presence FROM supplier JOIN lads ON s_nationkey = n_nationkey GROUP BY 1),
spine AS (SELECT DISTINCT area_code, {country_sql('area_code')} AS country FROM ladder),
src AS (
  SELECT 'fires' || country AS grp, n_fires * 1.0 / nullif(n_people, 0) AS x FROM fires_t JOIN spine USING (area_code)
  UNION ALL SELECT 'floods' || country, n_people_flood FROM flood_t JOIN spine USING (area_code)
  UNION ALL SELECT 'lonely' || country, loneills FROM lonely_t JOIN spine USING (area_code)
  UNION ALL SELECT 'alone' || country, prop_alone FROM alone_t JOIN spine USING (area_code)
  UNION ALL SELECT 'sec95' || {country_sql('lad_code')}, sec95 FROM per_lad
  UNION ALL SELECT 'digital' || {country_sql('lad_code')}, digital FROM per_lad
  UNION ALL SELECT 'hle' || {country_sql('lad_code')}, hle FROM per_lad
  UNION ALL SELECT 'service', sum(f.n_fires) * 1.0 / sum(p.n_people) FROM fires f JOIN ladder USING (c_custkey) JOIN people p USING (c_custkey)
    WHERE n_regionkey = 1 GROUP BY n_nationkey % 2),
{breaks_sql('src', 5)},
joined AS (SELECT s.area_code, s.country, n_fires * 1.0 / nullif(n_people, 0) AS dens, n_people_flood, loneills, prop_alone, n_people_total, n_one, n_lone, worst_health, worst_imd,
  CASE WHEN s.country = 'Northern Ireland' THEN 0 ELSE 99 END AS gap
  FROM spine s LEFT JOIN fires_t USING (area_code) LEFT JOIN flood_t USING (area_code) LEFT JOIN lonely_t USING (area_code)
  LEFT JOIN alone_t USING (area_code) LEFT JOIN dec_t USING (area_code)),
small AS (SELECT *,
  CASE WHEN country IN ('England', 'Scotland') THEN coalesce({class_sql('nb', "'fires' || country", 'dens')}, gap) END AS fires_raw,
  CASE WHEN country <> 'Scotland' THEN coalesce({class_sql('nb', "'floods' || country", 'n_people_flood')}, gap) END AS floods_raw,
  coalesce({class_sql('nb', "'lonely' || country", 'loneills')}, gap) AS lonely_q,
  coalesce({class_sql('nb', "'alone' || country", 'prop_alone')}, gap) AS alone_q,
  coalesce(CASE WHEN worst_health BETWEEN 1 AND 10 THEN ceil(worst_health / 2.0) END, gap) AS health_q,
  coalesce(CASE WHEN worst_imd BETWEEN 1 AND 10 THEN ceil(worst_imd / 2.0) END, gap) AS imd_q FROM joined),
small_q AS (SELECT * EXCLUDE (fires_raw, floods_raw),
  CASE WHEN dens IS NULL AND country IN ('England', 'Scotland') THEN gap ELSE fires_raw END AS fires_q,
  CASE WHEN n_people_flood IS NULL AND country <> 'Scotland' THEN gap ELSE floods_raw END AS floods_q FROM small)"""

_SMALL_LABEL = ("nullif(concat_ws(', ', CASE WHEN fires_q = 1 THEN 'Fires' END, CASE WHEN floods_q = 1 THEN 'Flooding' END, "
                "CASE WHEN lonely_q = 1 THEN 'Loneliness' END, CASE WHEN health_q = 1 THEN 'Health deprivation' END, "
                "CASE WHEN alone_q = 1 THEN 'Living alone' END, CASE WHEN imd_q = 1 THEN 'IMD' END), '')")


def _clean(c: str) -> str:
    return f"CAST(CASE WHEN {c} = 99 THEN 0 ELSE {c} END AS BIGINT) AS {c}"


@query(f"""WITH {_INPUT_SQL}
SELECT area_code, country, {', '.join(_clean(f'{i}_q') for i in ('fires', 'floods', 'lonely', 'health', 'alone', 'imd'))},
       {sql_rnd('dens')} AS dens_fires, {sql_rnd('prop_alone')} AS prop_alone, {_SMALL_LABEL} AS combined_risk FROM small_q""")
def nation_small_areas(spark, sf):
    out = K.clear_sentinel(NP.small_area_risks(nation_inputs(spark, sf)))
    return out.select("area_code", "country", *[big(f"{i}_q").alias(f"{i}_q") for i in ("fires", "floods", "lonely", "health", "alone", "imd")],
                      rnd("dens_fires").alias("dens_fires"), rnd("prop_alone").alias("prop_alone"), "combined_risk")


def _lad_label(country: str, order: tuple[str, ...]) -> str:
    texts = ", ".join(f"CASE WHEN {_lad_class(i)} = 1 THEN '{_LABELS[i]}' END" for i in order)
    return f"WHEN '{country}' THEN nullif(concat_ws(', ', {texts}), '')"


_LAD_SQL = f"""fan AS (SELECT s.*, l.lad_code, l.lad_name FROM small_q s JOIN ladder l USING (area_code)),
rolled AS (SELECT country, lad_code, min(lad_name) AS lad_name, {', '.join(f"{strict_sql('min', f'{i}_q')} AS worst_{i}_q" for i in _ROLLED)},
  max(dens) AS worst_fires, max(n_people_flood) AS worst_floods, max(loneills) AS worst_lonely, min(worst_health) AS worst_health,
  (sum(n_one) + sum(n_lone)) * 1.0 / sum(n_people_total) AS worst_alone, min(worst_imd) AS worst_imd,
  quantile_cont(dens, 0.5) AS median_fires, quantile_cont(n_people_flood, 0.5) AS median_floods, quantile_cont(loneills, 0.5) AS median_lonely,
  quantile_cont(worst_health, 0.5) AS median_health, quantile_cont(prop_alone, 0.5) AS median_alone, quantile_cont(worst_imd, 0.5) AS median_imd
  FROM fan GROUP BY country, lad_code),
lad_in AS (SELECT r.*, CASE WHEN n_nationkey = 20 THEN 'E015' ELSE r.lad_code END AS lad19cd, n_nationkey FROM rolled r JOIN lads ON lads.lad_code = r.lad_code),
lad_j AS (SELECT i.*, d.sec95, p.digital, p.hle, d.presence,
  CASE WHEN country <> 'Northern Ireland' THEN 6 - CAST(ceil((n_nationkey % 10 + 1) / 2.0) AS BIGINT) END AS destitution_q,
  CASE WHEN country <> 'Northern Ireland' THEN 6 - CAST(ceil((n_nationkey * 3 % 10 + 1) / 2.0) AS BIGINT) END AS migrant_dest_q
  FROM lad_in i LEFT JOIN per_lad d ON d.lad_code = i.lad19cd LEFT JOIN per_lad p ON p.lad_code = i.lad_code),
lad_q AS (SELECT *,
  CASE WHEN country = 'Northern Ireland' THEN CASE WHEN sec95 > 0 THEN 1 ELSE 5 END WHEN sec95 IS NOT NULL THEN {class_sql('nb', "'sec95' || country", 'sec95')} END AS displacement_q,
  CASE WHEN hle IS NOT NULL THEN {class_sql('nb', "'hle' || country", 'hle')} END AS hle_birth_q,
  CASE WHEN digital IS NOT NULL THEN {class_sql('nb', "'digital' || country", 'digital')} END AS digital_q FROM lad_j),
lad_l AS (SELECT *, CASE country {' '.join(_lad_label(c, order) for c, order in _LAD_ORDER.items())} END AS combined_risk FROM lad_q)"""

_LAD_CLASSES = [f"worst_{i}_q" for i in _ROLLED] + ["displacement_q", "migrant_dest_q", "hle_birth_q", "digital_q", "destitution_q"]
_LAD_VALUES = [f"worst_{i}" for i in _ROLLED] + [f"median_{i}" for i in _ROLLED]


@query(f"""WITH {_INPUT_SQL}, {_LAD_SQL}
SELECT country, lad_code, lad_name, lad19cd, presence AS presence_services, combined_risk, {', '.join(_clean(c) for c in _LAD_CLASSES)},
       {', '.join(f'{sql_rnd(c, 5)} AS {c}' for c in _LAD_VALUES)} FROM lad_l""")
def nation_local_authorities(spark, sf):
    out = NP.run_nations(nation_inputs(spark, sf))["lad"]
    return out.select("country", "lad_code", "lad_name", "lad19cd", "presence_services", "combined_risk",
                      *[big(c).alias(c) for c in _LAD_CLASSES], *[rnd(c, 5).alias(c) for c in _LAD_VALUES])


_SERVICE_OWN = [i for i in _SERVICE_ORDER if i != "fires"]


@query(f"""WITH {_INPUT_SQL}, {_LAD_SQL},
svc AS (SELECT 'W5' || CAST(n_nationkey % 2 AS VARCHAR) AS service_code, 'Service ' || CAST(n_nationkey % 2 AS VARCHAR) AS service_name,
  {', '.join(f"{strict_sql('min', _lad_class(i))} AS worst_{i}_q" for i in _SERVICE_OWN)}
  FROM lad_l WHERE country = 'Wales' GROUP BY 1, 2),
svc_f AS (SELECT 'W5' || CAST(n_nationkey % 2 AS VARCHAR) AS service_code, sum(f.n_fires) * 1.0 / sum(p.n_people) AS dens
  FROM fires f JOIN ladder USING (c_custkey) JOIN people p USING (c_custkey) WHERE n_regionkey = 1 GROUP BY 1),
svc_q AS (SELECT svc.*, {class_sql('nb', "'service'", 'svc_f.dens')} AS fires_q FROM svc LEFT JOIN svc_f USING (service_code))
SELECT service_code, service_name, {', '.join(_clean(f'worst_{i}_q') for i in _SERVICE_OWN)}, CAST(fires_q AS BIGINT) AS fires_q,
  nullif(concat_ws(', ', {', '.join(f"CASE WHEN {'fires_q' if i == 'fires' else f'worst_{i}_q'} = 1 THEN '{_LABELS[i]}' END" for i in _SERVICE_ORDER)}), '') AS combined_risk
FROM svc_q""")
def nation_service_areas(spark, sf):
    out = NP.run_nations(nation_inputs(spark, sf))["service"]
    return out.select("service_code", "service_name", *[big(f"worst_{i}_q").alias(f"worst_{i}_q") for i in _SERVICE_OWN],
                      big("fires_q").alias("fires_q"), "combined_risk")


def _report_sql() -> str:
    cols = [_lad_class(i) for i in _LAD_ORDER["England"]]
    shown = ", ".join(f'q{n} AS "{_TITLES[i]}"' for n, i in enumerate(_LAD_ORDER["England"]))
    clean = ", ".join(f"CAST(CASE WHEN {c} = 99 THEN 0 ELSE {c} END AS BIGINT) AS q{n}" for n, c in enumerate(cols))
    score = " * ".join(f"coalesce(CAST(q{n} AS DOUBLE), 1)" for n in range(len(cols)))
    ones = " + ".join(f"CASE WHEN q{n} = 1 THEN 1 ELSE 0 END" for n in range(len(cols)))
    return f"""WITH {_INPUT_SQL}, {_LAD_SQL}, c AS (SELECT lad_code, lad_name, presence, combined_risk, {clean} FROM lad_l WHERE country = 'England')
SELECT lad_code AS "Local Authority code", lad_name AS "Local Authority", {shown}, presence AS "Services present?",
       combined_risk AS "Combined risk", {score} AS "Total score", CAST({ones} AS BIGINT) AS "No. 1s" FROM c"""


@query(_report_sql())
def nation_report(spark, sf):
    out = NP.nation_report(NP.run_nations(nation_inputs(spark, sf))["lad"], NP.NATIONS[0])
    return out.withColumns({c: F.col(f"`{c}`").cast("long") for c in [*_TITLES.values(), "No. 1s"]})


# ---- deprivation and settlement summaries ----------------------------------

_DEP_SQL = f"""{LADDER_SQL},
dep AS (SELECT area_code, count(*) FILTER (WHERE d <= 2) AS top, count(*) FILTER (WHERE d > 2) AS other FROM (
  SELECT CASE WHEN lsoa LIKE '9%' THEN lad_code ELSE area_code END AS area_code, CASE WHEN c_custkey % 31 = 7 THEN NULL ELSE floor((c_acctbal + 1000) / 1100.1) + 1 END AS d FROM ladder) GROUP BY 1),
dep_p AS (SELECT *, {country_sql('area_code')} AS country, top * 1.0 / nullif(top + other, 0) AS prop FROM dep),
dsrc AS (SELECT country AS grp, prop AS x FROM dep_p),
{breaks_sql('dsrc', 10, 'db')}"""


@query(f"""WITH {_DEP_SQL}
SELECT area_code, country, top, other, {sql_rnd('prop')} AS prop_top2deciles, CAST(CASE WHEN prop IS NOT NULL THEN {class_sql('db', 'country', 'prop')} END AS BIGINT) AS deprivation_q FROM dep_p""")
def deprivation_summary(spark, sf):
    from arearisk.plans.datasets import deprivation_summary as build

    l = ladder(spark, sf)
    deciles = l.select("lsoa", F.when(F.col("c_custkey") % 31 != 7, F.floor((F.col("c_acctbal") + 1000) / 1100.1) + 1).alias("imd_decile"))
    parent = F.when(F.col("lsoa").startswith("9"), F.col("lad_code")).otherwise(F.col("area_code"))
    out = build(deciles, l.select("lsoa", parent.alias("area_code")), "lsoa", "area_code", label=False)
    return out.select("area_code", "country", "top", "other", rnd("prop_top2deciles").alias("prop_top2deciles"), big("deprivation_q").alias("deprivation_q"))


def settlements(spark, sf):
    from arearisk.plans.datasets import rural_urban_uk

    l = ladder(spark, sf)
    codes = F.array(*[F.lit(x) for x in ("A1", "B1", "C1", "C2", "D1", "D2", "E1", "E2", "F1", "F2", "Z9")])
    ew = l.filter(S.has_prefix("lsoa", ["E", "W"])).select(
        F.col("lsoa").alias("lsoa11cd"), F.element_at(codes, (F.col("c_custkey") % 11 + 1).cast("int")).alias("ruc11cd"))
    sco = l.filter(S.has_prefix("lsoa", ["S"])).select(
        F.col("lsoa").alias("lsoa11cd"), F.when(F.col("c_custkey") % 19 != 0, F.col("c_custkey") % 3).alias("ur2fold"))
    count = (F.col("c_custkey") % 4).cast("string")
    ni = l.filter(S.has_prefix("lsoa", ["N", "9"])).select(
        F.col("lsoa").alias("lsoa11cd"), count.alias("urban"), F.when(F.col("c_custkey") % 2 == 0, "1").otherwise("-").alias("mixed"),
        (F.col("c_custkey") % 3).cast("string").alias("rural"))
    return rural_urban_uk(ew, sco, ni)


_SET_SQL = f"""{LADDER_SQL},
ruc AS (SELECT lad_code, {country_sql('lsoa')} AS country,
  CASE WHEN n_regionkey < 2 THEN CASE WHEN c_custkey % 11 < 4 THEN 1 ELSE 0 END WHEN n_regionkey = 2 THEN CASE WHEN c_custkey % 19 <> 0 AND c_custkey % 3 = 1 THEN 1 ELSE 0 END ELSE c_custkey % 4 END AS u,
  CASE WHEN n_regionkey < 3 THEN 0 ELSE CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END END AS m,
  CASE WHEN n_regionkey < 2 THEN CASE WHEN c_custkey % 11 BETWEEN 4 AND 9 THEN 1 ELSE 0 END WHEN n_regionkey = 2 THEN CASE WHEN c_custkey % 19 <> 0 AND c_custkey % 3 <> 1 THEN 1 ELSE 0 END ELSE c_custkey % 3 END AS r FROM ladder),
ruc_p AS (SELECT lad_code, country, sum(u) AS urban, sum(m) AS mixed, sum(r) AS rural, (sum(u) + sum(m) / 2.0) / nullif(sum(u) + sum(m) + sum(r), 0) AS prop FROM ruc GROUP BY 1, 2),
rsrc AS (SELECT country AS grp, prop AS x FROM ruc_p),
{breaks_sql('rsrc', 3, 'rb')}"""


@query(f"""WITH {_SET_SQL}
SELECT lad_code, country, CAST(urban AS BIGINT) AS urban, CAST(mixed AS BIGINT) AS mixed, CAST(rural AS BIGINT) AS rural, {sql_rnd('prop')} AS prop_urban,
       CAST({class_sql('rb', 'country', 'prop')} AS BIGINT) AS settlement_q FROM ruc_p""")
def settlement_summary(spark, sf):
    from arearisk.plans.datasets import settlement_summary as build

    lookup = ladder(spark, sf).select(F.col("lsoa").alias("lsoa11cd"), "lad_code")
    out = build(settlements(spark, sf), lookup, "lsoa11cd", "lad_code", label=False)
    return out.select("lad_code", "country", *[big(c).alias(c) for c in ("urban", "mixed", "rural")],
                      rnd("prop_urban").alias("prop_urban"), big("settlement_q").alias("settlement_q"))


@query(f"""WITH {_SET_SQL}
SELECT grp AS country, CAST(kk - t + 1 AS BIGINT) AS settlement_q, CASE WHEN t = 1 THEN '[' || printf('%.3f', lo) ELSE '(' || printf('%.3f', lag(hi) OVER (PARTITION BY grp ORDER BY t)) END
       || ', ' || printf('%.3f', hi) || ']' AS settlement_q_name FROM rb""")
def settlement_classes(spark, sf):
    """The list of class intervals per country."""
    from arearisk.plans.datasets import settlement_summary as build

    lookup = ladder(spark, sf).select(F.col("lsoa").alias("lsoa11cd"), "lad_code")
    out = class_intervals(build(settlements(spark, sf), lookup, "lsoa11cd", "lad_code", label_pattern="%.3f"), "settlement", ["country"])
    return out.select("country", big("settlement_q").alias("settlement_q"), "settlement_q_name")


_SERVICE_DEP_SQL = _DEP_SQL.replace("CASE WHEN lsoa LIKE '9%' THEN lad_code ELSE area_code END AS area_code",
                                    "CASE WHEN n_nationkey % 7 <> 6 THEN substr(lad_code, 1, 1) || '5' || CAST(n_nationkey % 3 AS VARCHAR) || substr(c_mktsegment, 1, 1) END AS area_code")


@query(f"""WITH {_SERVICE_DEP_SQL}
SELECT area_code AS fra17cd, country, top, other, {sql_rnd('prop')} AS prop_top2deciles, CAST(CASE WHEN prop IS NOT NULL THEN {class_sql('db', 'country', 'prop')} END AS BIGINT) AS deprivation_q
FROM dep_p WHERE country IN ('Wales', 'Scotland')""")
def deprivation_services(spark, sf):
    """Small areas to fire service areas through local authorities; some authorities have no service."""
    from arearisk.plans.datasets import deprivation_summary as build
    from arearisk.plans.datasets import service_lookup

    l = ladder(spark, sf)
    deciles = l.select(F.col("lsoa").alias("lsoa11cd"), F.when(F.col("c_custkey") % 31 != 7, F.floor((F.col("c_acctbal") + 1000) / 1100.1) + 1).alias("imd_decile"))
    # Neighbourhoods stand for authorities, so that there are enough of them for ten classes.
    lad_to_service = l.select(F.col("area_code").alias("lad17cd"), F.when(F.col("n_nationkey") % 7 != 6, F.concat(
        F.substring("lad_code", 1, 1), F.lit("5"), (F.col("n_nationkey") % 3).cast("string"), F.substring("c_mktsegment", 1, 1))).alias("fra17cd"))
    look = service_lookup(l.select(F.col("lsoa").alias("lsoa11cd"), F.col("area_code").alias("lad17cd")), lad_to_service.distinct())
    out = build(deciles, look, "lsoa11cd", "fra17cd", label=False, countries=["Wales", "Scotland"])
    return out.select("fra17cd", "country", "top", "other", rnd("prop_top2deciles").alias("prop_top2deciles"), big("deprivation_q").alias("deprivation_q"))
