"""Dataset builders on inputs made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.functions import scalars as S
from arearisk.plans import datasets as D
from workload.base import LADDER_SQL, LADS_SQL, big, country_sql, ladder, lads, registry, rnd, sql_rnd, strict_sql, table
from workload.classes import _DEP_SQL, _SET_SQL, QUERIES as CLASS_QUERIES
from workload.spatial import _PIP_SQL, layer, points

QUERIES, SQL, query = registry()


# ---- destitution, digital exclusion, displacement --------------------------

@query(f"""WITH {LADS_SQL}, d AS (SELECT CASE WHEN n_nationkey % 6 = 2 THEN n_name || ' (former)' ELSE n_name END AS name, count(*) % 10 + 1 AS a, count(*) FILTER (WHERE s_acctbal > 0) % 10 + 1 AS m,
  count(*) FILTER (WHERE s_acctbal > 5000) % 10 + 1 AS c, sum(s_suppkey) % 10 + 1 AS u FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT lad_code AS lad17cd, a AS destitution_all, m AS destitution_migrant, c AS destitution_complex, CAST(u AS BIGINT) AS destitution_uk_other
FROM lads LEFT JOIN d ON lad_name = name WHERE lad_code NOT LIKE 'N%'""")
def destitution(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    # Some names have no partner.
    name = F.when(F.col("n_nationkey") % 6 == 2, F.concat("n_name", F.lit(" (former)"))).otherwise(F.col("n_name"))
    deciles = s.groupBy(name.alias("name")).agg(
        (F.count(F.lit(1)) % 10 + 1).alias("all_destitute"), (F.count(F.when(F.col("s_acctbal") > 0, 1)) % 10 + 1).alias("migrant"),
        (F.count(F.when(F.col("s_acctbal") > 5000, 1)) % 10 + 1).alias("complex_needs"), (F.sum("s_suppkey") % 10 + 1).alias("uk_other"))
    names = lads(spark, sf).select(F.col("lad_code").alias("lad17cd"), F.col("lad_name").alias("lad17nm"))
    return D.destitution(names, deciles)


def placemarks(spark, sf):
    """One style per brand and metric: the largest size of its parts, unreadable where that is 50."""
    p = table(spark, sf, "part")
    metric = F.element_at(F.array(*[F.lit(m) for m in D.DIGITAL_METRICS]), (F.col("p_partkey") % 4 + 1).cast("int"))
    top = p.groupBy(metric.alias("metric"), F.col("p_brand").alias("name")).agg(F.max(F.col("p_size") % 7).alias("v"), F.min("p_size").alias("low"))
    return top.select("metric", "name", F.when(F.col("low") == 3, "#x").otherwise(F.concat(F.lit("#"), F.col("v").cast("string"))).alias("style_url"))


DIGITAL_SQL = """WITH t AS (SELECT p_brand AS b, p_partkey % 4 AS m, CASE WHEN min(p_size) = 3 THEN NULL ELSE max(p_size % 7) END AS v FROM part GROUP BY 1, 2),
w AS (SELECT b, max(v) FILTER (WHERE m = 0) AS i, max(v) FILTER (WHERE m = 1) AS a, max(v) FILTER (WHERE m = 2) AS s, max(v) FILTER (WHERE m = 3) AS u FROM t GROUP BY b)
SELECT b AS la_code, CAST(i AS BIGINT) AS infrastructure, CAST(a AS BIGINT) AS access, CAST(s AS BIGINT) AS skill, CAST(u AS BIGINT) AS "use",
       CAST(i + a + s + u AS BIGINT) AS digital_total_sum, CAST(i * a * s * u AS BIGINT) AS digital_total_mult FROM w"""


@query(DIGITAL_SQL)
def digital_exclusion(spark, sf):
    out = D.digital_exclusion(placemarks(spark, sf))
    return out.select("la_code", *[big(c).alias(c) for c in out.columns[1:]])


@query(f"""WITH {LADS_SQL}, e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN user_id % 25 <> 4 THEN user_id % 25 END AS nk, event_type, event_id % 5 AS people FROM events),
l AS (SELECT * FROM e WHERE day = (SELECT max(day) FROM e)),
w AS (SELECT nk, coalesce(sum(people) FILTER (WHERE event_type = 'view'), 0) AS d, coalesce(sum(people) FILTER (WHERE event_type = 'click'), 0) AS s FROM l GROUP BY 1)
SELECT lad_code AS lad19cd, CAST(d AS BIGINT) AS dispersed_accommodation, CAST(s AS BIGINT) AS subsistence_only, CAST(coalesce(d + s, 0) AS BIGINT) AS sec95
FROM lads LEFT JOIN w ON nk = n_nationkey""")
def displacement(spark, sf):
    e = table(spark, sf, "events")
    lad = lads(spark, sf)
    support = e.join(lad, F.col("user_id") % 25 == F.col("n_nationkey")).select(
        F.date_format("ts", "dd MMM yyyy").alias("date_text"),
        # One authority goes by a code that the list does not have.
        F.when(F.col("n_nationkey") != 4, F.col("lad_code")).otherwise("X004").alias("lad19cd"),
        F.when(F.col("event_type") == "view", "Dispersed Accommodation").when(F.col("event_type") == "click", "Subsistence Only")
        .otherwise(F.col("event_type")).alias("support"),
        (F.col("event_id") % 5).alias("people"))
    return D.displacement(support, lad.select(F.col("lad_code").alias("lad19cd")))


# ---- fires -----------------------------------------------------------------

def _english():
    """Every customer is an English small area here."""
    return F.concat(F.lit("E"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))


def incidents(spark, sf):
    """Finished orders as incidents; for some the code sits in the description, some have none."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    l = ladder(spark, sf).select("c_custkey", _english().alias("lsoa"))
    kinds = F.element_at(F.array(*[F.lit(x) for x in D.DWELLING_FIRES]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    j = o.join(l, F.col("o_custkey") == F.col("c_custkey"))
    moved = F.col("o_orderkey") % 5 == 0
    return j.select(
        F.when(F.col("o_orderstatus") == "F", "2018/19").otherwise("2017/18").alias("financial_year"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Secondary fire").otherwise(kinds).alias("incident_type"),
        F.when(~moved, F.col("lsoa")).alias("lsoa_code"),
        F.when(moved, F.col("lsoa")).when(F.col("o_orderkey") % 7 == 1, F.lit(None)).otherwise("near the church").alias("lsoa_description"))


_FIRE_ENG_SQL = f"""{LADDER_SQL}, eng AS (SELECT *, 'E' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS small FROM ladder),
inc AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN small WHEN o_orderkey % 7 = 1 THEN NULL ELSE small END AS code FROM orders JOIN eng ON c_custkey = o_custkey
  WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'),
cnt AS (SELECT code, count(*) AS n_fires FROM inc GROUP BY 1),
pop AS (SELECT small, area_code, CASE WHEN c_custkey % 997 = 5 OR c_custkey % 1009 = 6 THEN NULL ELSE c_custkey % 90 + 10 END AS n_people FROM eng)"""


def _population(spark, sf):
    """Gaps: some areas without a number, some whose code has no partner."""
    code = F.when(F.col("c_custkey") % 1009 != 6, _english()).otherwise(F.concat(F.lit("X"), F.col("c_custkey").cast("string")))
    return ladder(spark, sf).select(code.alias("lsoa11cd"), F.when(F.col("c_custkey") % 997 != 5, F.col("c_custkey") % 90 + 10).alias("n_people"))


def _fires_england(spark, sf):
    lookup = ladder(spark, sf).select(_english().alias("lsoa11cd"), F.col("area_code").alias("msoa11cd"))
    return D.fires_england(incidents(spark, sf), _population(spark, sf), lookup, "2018/19")


@query(f"""WITH {_FIRE_ENG_SQL} SELECT code AS lsoa11cd, n_fires, n_people, {sql_rnd('n_fires * 1.0 / nullif(n_people, 0)')} AS dens_fires FROM cnt LEFT JOIN pop ON code = small""")
def fires_england_small(spark, sf):
    return _fires_england(spark, sf)[0].withColumn("dens_fires", rnd("dens_fires"))


@query(f"""WITH {_FIRE_ENG_SQL}, j AS (SELECT l.area_code, n_fires, n_people FROM cnt LEFT JOIN pop ON code = pop.small LEFT JOIN eng l ON l.small = code),
g AS (SELECT area_code, {strict_sql('sum', 'n_fires')} AS f, {strict_sql('sum', 'n_people')} AS p FROM j GROUP BY 1)
SELECT area_code AS msoa11cd, CAST(f AS BIGINT) AS n_fires, CAST(p AS BIGINT) AS n_people, {sql_rnd('f * 1.0 / nullif(p, 0)')} AS dens_fires FROM g""")
def fires_england_area(spark, sf):
    return _fires_england(spark, sf)[1].withColumn("dens_fires", rnd("dens_fires"))


@query(f"""WITH rec AS (SELECT 'Service ' || CAST(n_regionkey AS VARCHAR) AS nm, CASE WHEN o_orderkey % 50 = 0 AND n_regionkey = 2 THEN NULL ELSE 1.0 END AS d FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND n_regionkey <> 4),
f AS (SELECT nm, {strict_sql('sum', 'd')} AS n FROM rec GROUP BY 1),
dw AS (SELECT CASE WHEN n_nationkey % 9 <> 8 THEN n_regionkey END AS n_regionkey, sum(w) AS n FROM (SELECT c_nationkey, nullif(count(*) FILTER (c_nationkey % 7 <> 3), 0) AS w FROM customer GROUP BY 1) JOIN nation ON n_nationkey = c_nationkey GROUP BY 1)
SELECT 'W2' || CAST(r_regionkey AS VARCHAR) AS fra19cd, {sql_rnd('f.n', 2)} AS n_fires, {sql_rnd('dw.n', 2)} AS n_dwellings, {sql_rnd('f.n / nullif(dw.n, 0)')} AS dens_fires
FROM f JOIN region ON nm = 'Service ' || CAST(r_regionkey AS VARCHAR) LEFT JOIN dw ON n_regionkey = r_regionkey""")
def fires_wales(spark, sf):
    o, c, n = table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "nation")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    records = j.select(
        F.when(F.col("n_regionkey") == 4, "All").otherwise("area").alias("area_code"),
        F.concat(F.lit("Service "), F.col("n_regionkey").cast("string")).alias("area_name"),
        F.lit("Dwellings").alias("location"), F.when(F.col("o_orderstatus") == "F", "2018-19").otherwise("2017-18").alias("year_code"),
        F.lit("Fires").alias("count_name"), F.when(F.col("o_orderpriority") == "1-URGENT", "All motives").otherwise("Accidental").alias("motive"),
        F.when((F.col("o_orderkey") % 50 != 0) | (F.col("n_regionkey") != 2), F.lit(1.0)).alias("data"))
    stock = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.when(F.col("c_nationkey") % 7 != 3, 1)).alias("w"), F.count(F.lit(1)).alias("all"))
    years = F.explode(F.array(F.lit("2016-17"), F.lit("2018-19")))
    dwellings = stock.select(years.alias("year_code"), F.lit("All tenures (Number)").alias("tenure"), F.col("n_name").alias("area_name"),
                             F.when(F.col("w") > 0, F.col("w").cast("double")).alias("data"))
    services = table(spark, sf, "region").select(
        F.concat(F.lit("W2"), F.col("r_regionkey").cast("string")).alias("fra19cd"),
        F.concat(F.lit("Service "), F.col("r_regionkey").cast("string")).alias("fra19nm"))
    lad_fra = n.select(F.col("n_name").alias("lad19nm"), F.when(F.col("n_nationkey") % 9 != 8, F.concat(F.lit("W2"), F.col("n_regionkey").cast("string"))).alias("fra19cd"))
    out = D.fires_wales(records, dwellings, services, lad_fra, "2018-19")
    return out.select("fra19cd", rnd("n_fires", 2).alias("n_fires"), rnd("n_dwellings", 2).alias("n_dwellings"), rnd("dens_fires").alias("dens_fires"))


_FIRE_SCO_SQL = f"""{LADDER_SQL},
inc AS (SELECT o_custkey, count(*) AS n_fires, {strict_sql('sum', 'acc')} AS n_accidental, sum(fat) AS n_fatalities FROM (
  SELECT o_custkey, CASE WHEN o_orderkey % 77 = 0 THEN NULL ELSE o_orderkey % 2 END AS acc, o_orderkey % 3 AS fat FROM orders WHERE year(o_orderdate) = 1998) GROUP BY 1),
small AS (SELECT lsoa, area_code, lad_code, n_fires, n_accidental, n_fatalities, CASE WHEN c_custkey % 4999 = 4 THEN NULL ELSE c_custkey % 50 END AS n_dwellings FROM inc JOIN ladder ON c_custkey = o_custkey)"""


def _fires_scotland(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("calendar_year"))
    l = ladder(spark, sf)
    inc = o.join(l, F.col("o_custkey") == F.col("c_custkey")).select(
        "calendar_year", F.col("lsoa").alias("dz"), F.when(F.col("o_orderkey") % 77 != 0, F.col("o_orderkey") % 2).alias("accidental"),
        (F.col("o_orderkey") % 3).alias("fatalities"), F.lit(0).alias("casualties"))
    dwellings = l.select(F.col("lsoa").alias("dz"), F.when(F.col("c_custkey") % 4999 != 4, F.col("c_custkey") % 50).alias("n_dwellings"))
    lookup = l.select(F.col("lsoa").alias("dz"), F.col("area_code").alias("iz"), F.col("lad_code").alias("council"))
    return D.fires_scotland(inc, dwellings, lookup, 1998)


@query(f"""WITH {_FIRE_SCO_SQL} SELECT lsoa AS dz, n_fires, CAST(n_accidental AS BIGINT) AS n_accidental, CAST(n_fatalities AS BIGINT) AS n_fatalities, n_dwellings,
       {sql_rnd('n_fires * 1.0 / nullif(n_dwellings, 0)')} AS dens_fires FROM small""")
def fires_scotland_small(spark, sf):
    return _fires_scotland(spark, sf)[0].drop("n_casualties").withColumn("dens_fires", rnd("dens_fires"))


@query(f"""WITH {_FIRE_SCO_SQL}, g AS (SELECT lad_code, {strict_sql('sum', 'n_fires')} AS f, {strict_sql('sum', 'n_dwellings')} AS d FROM small GROUP BY 1)
SELECT lad_code AS council, CAST(f AS BIGINT) AS n_fires, CAST(d AS BIGINT) AS n_dwellings, {sql_rnd('f * 1.0 / nullif(d, 0)')} AS dens_fires FROM g""")
def fires_scotland_council(spark, sf):
    return _fires_scotland(spark, sf)[2].withColumn("dens_fires", rnd("dens_fires"))


# ---- floods ----------------------------------------------------------------

def _flood(spark, sf):
    pts = points(spark, sf).select(F.concat(F.lit("E"), F.lpad(F.col("vec_id").cast("string"), 8, "0")).alias("oa11cd"), "vec_id", "x", "y")
    zones = layer(spark, sf)
    eng = zones.filter("label < 6").select(F.col("label").alias("zone_id"), "rings", F.when(F.col("label") != 2, "Flood Zone 3").otherwise("Flood Zone 2").alias("layer"))
    wal = zones.filter("label >= 6").select(F.col("label").alias("zone_id"), "rings", F.when(F.col("label") != 8, "coast").alias("type"))
    lsoa = F.concat(F.lit("E"), (F.col("vec_id") % 40).cast("string"))
    pop = pts.select("oa11cd", lsoa.alias("lsoa11cd"), F.when(F.col("vec_id") % 487 != 3, F.col("vec_id") % 300).alias("n"))
    c = table(spark, sf, "customer").select("c_custkey")
    small = c.select(F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("sa2011"),
                                                  F.concat(F.lit("95"), (F.col("c_custkey") % 7).cast("string")).alias("soa2011"))
    pop_ni = c.select(F.explode(F.array(F.lit(2017), F.lit(2018))).alias("year"), F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("sa2011"),
                      (F.col("c_custkey") % 90).alias("n"))
    lookup = pts.select("oa11cd", F.concat(F.lit("E0"), (F.col("vec_id") % 8).cast("string")).alias("msoa11cd"))
    return D.people_in_flood_zones(pts, eng, wal, pop, small, pop_ni, lookup)


_FLOOD_SQL = f"""{_PIP_SQL},
oa AS (SELECT DISTINCT vec_id, CASE WHEN label < 6 THEN 'e' ELSE 'w' END AS part FROM inside WHERE label NOT IN (2, 8)),
gb AS (SELECT vec_id, 'E' || CAST(vec_id % 40 AS VARCHAR) AS lsoa, 'E0' || CAST(vec_id % 8 AS VARCHAR) AS msoa, CASE WHEN vec_id % 487 = 3 THEN NULL ELSE vec_id % 300 END AS n FROM oa),
ni AS (SELECT '95' || CAST(c_custkey % 7 AS VARCHAR) AS lsoa, c_custkey % 90 AS n FROM customer),
by_lsoa AS (SELECT lsoa, {strict_sql('sum', 'n')} AS n FROM (SELECT lsoa, n FROM gb UNION ALL SELECT lsoa, n FROM ni) GROUP BY 1)"""


@query(f"WITH {_FLOOD_SQL} SELECT lsoa AS lsoa11cd, CAST(n AS BIGINT) AS n FROM by_lsoa")
def flood_people_small(spark, sf):
    return _flood(spark, sf)[0]


@query(f"""WITH {_FLOOD_SQL} SELECT msoa AS msoa11cd, CAST({strict_sql('sum', 'n')} AS BIGINT) AS n FROM gb GROUP BY 1
UNION ALL SELECT lsoa, CAST(n AS BIGINT) FROM by_lsoa WHERE lsoa LIKE '9%'""")
def flood_people_area(spark, sf):
    return _flood(spark, sf)[1]


# ---- life expectancy and living alone --------------------------------------

def _sheet(spark, sf, name, gap):
    s = table(spark, sf, "supplier")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("E10", "E12", "E06", "W06", "S12", "N09")]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    code = F.when(F.col("s_suppkey") % 31 == 30, "1 footnote").when(F.col("s_suppkey") % 37 != 36, F.concat(kinds, F.lpad(F.col("s_suppkey").cast("string"), 6, "0")))
    return s.select(F.lit(name).alias("sheet"), F.col("s_suppkey").alias("row_no"), code.alias("code"),
                    F.when(F.col("s_suppkey") % gap != gap - 1, 50 + F.col("s_acctbal") / 1000).alias("hle"))


def _sheet_sql(name: str, gap: int) -> str:
    return f"""{name} AS (SELECT code, v FROM (SELECT CASE WHEN s_suppkey % 31 = 30 THEN '1 footnote' WHEN s_suppkey % 37 = 36 THEN NULL ELSE
  list_extract(['E10', 'E12', 'E06', 'W06', 'S12', 'N09'], s_suppkey % 6 + 1) || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') END AS code,
  last_value(CASE WHEN s_suppkey % {gap} = {gap - 1} THEN NULL ELSE 50 + s_acctbal / 1000 END IGNORE NULLS) OVER (ORDER BY s_suppkey ROWS UNBOUNDED PRECEDING) AS v FROM supplier)
  WHERE code IS NOT NULL AND v IS NOT NULL AND regexp_matches(code, '[A-Z][0-9]+'))"""


@query(f"""WITH {_sheet_sql('bm', 5)}, {_sheet_sql('bf', 7)}, {_sheet_sql('om', 4)}, {_sheet_sql('ow', 9)}
SELECT code, {sql_rnd('bm.v')} AS hle_birth_male, {sql_rnd('bf.v')} AS hle_birth_female, {sql_rnd('(bm.v + bf.v) / 2')} AS hle_birth, {sql_rnd('(om.v + ow.v) / 2')} AS hle_65,
  CASE substr(code, 1, 3) WHEN 'E10' THEN 'county' WHEN 'E12' THEN 'region' ELSE 'local authority' END AS area_kind
FROM bm LEFT JOIN bf USING (code) LEFT JOIN om USING (code) LEFT JOIN ow USING (code)""")
def healthy_life_expectancy(spark, sf):
    out = D.healthy_life_expectancy(_sheet(spark, sf, "bm", 5), _sheet(spark, sf, "bf", 7), _sheet(spark, sf, "om", 4), _sheet(spark, sf, "of", 9))
    return out.select("code", *[rnd(c).alias(c) for c in ("hle_birth_male", "hle_birth_female", "hle_birth", "hle_65")], "area_kind")


@query(f"""WITH eng AS (SELECT 'NHS A & B ' || s_name AS nm, s_suppkey AS k, s_acctbal AS m, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal + 100 END AS f FROM supplier WHERE s_suppkey % 4 <> 1),
wal AS (SELECT 'W' || CAST(o_custkey % 7 AS VARCHAR) AS code, 'Health Board ' || CAST(o_custkey % 7 AS VARCHAR) AS name, avg(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
sco AS (SELECT CASE WHEN c_nationkey = 9 THEN NULL ELSE 'S' || CAST(c_nationkey AS VARCHAR) END AS code, c_mktsegment AS name, avg(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END) AS v FROM customer GROUP BY 1, 2)
SELECT CASE WHEN k % 5 <> 0 THEN 'C' || CAST(k AS VARCHAR) END AS code, replace(nm || ' CCG', '&', 'and') AS name, {sql_rnd('m')} AS hle_birth_male, {sql_rnd('f')} AS hle_birth_female, {sql_rnd('(m + f) / 2', 3)} AS hle_birth FROM eng
UNION ALL SELECT code, name, NULL, NULL, {sql_rnd('v', 3)} FROM wal UNION ALL SELECT code, name, NULL, NULL, {sql_rnd('v', 3)} FROM sco WHERE code IS NOT NULL AND v IS NOT NULL""")
def life_expectancy_by_health_area(spark, sf):
    s = table(spark, sf, "supplier")
    own = s.withColumn("name", F.when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("Total "), F.col("s_name"))).otherwise(F.concat(F.lit("NHS A & B "), F.col("s_name"))))
    male = own.select("name", F.col("s_acctbal").alias("hle"))
    female = own.filter("s_suppkey % 3 <> 0").select("name", (F.col("s_acctbal") + 100).alias("hle"))
    areas = own.filter("s_suppkey % 5 <> 0").select(F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("code"),
                                                    S.harmonise_name("name", " CCG").alias("name"))
    o = table(spark, sf, "orders")
    wales = o.select(F.lit("HLE").alias("measure_code"), F.when(F.col("o_orderstatus") == "F", "201014").otherwise("201113").alias("year_code"),
                     F.concat(F.lit("Health Board "), (F.col("o_custkey") % 7).cast("string")).alias("area_name"),
                     F.concat(F.lit("W"), (F.col("o_custkey") % 7).cast("string")).alias("area_code"), F.col("o_totalprice").alias("data"))
    c = table(spark, sf, "customer")
    sco = c.select(F.when(F.col("c_nationkey") != 9, F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))).alias("code"),
                   F.col("c_mktsegment").alias("name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("hle"))
    out = D.life_expectancy_by_health_area(male, female, areas, wales, sco)
    return out.select("code", "name", rnd("hle_birth_male").alias("hle_birth_male"), rnd("hle_birth_female").alias("hle_birth_female"), rnd("hle_birth", 3).alias("hle_birth"))


_ALONE = {"ew": ("People: Total", "One person", "Lone parent"), "sco": ("All", "One", "Lone"), "ni": ("P", "O", "L")}


@query(f"""WITH {LADDER_SQL}, b AS (SELECT l.*, CASE WHEN c_custkey % 211 = 9 AND n_regionkey = 2 THEN NULL ELSE c_custkey % 60 + 40 END AS p, c_custkey % 20 AS o, c_custkey % 12 AS f FROM ladder l),
r AS (SELECT lsoa AS code, p, o, f FROM b WHERE n_regionkey <> 2
  UNION ALL SELECT area_code, {strict_sql('sum', 'p')}, {strict_sql('sum', 'o')}, {strict_sql('sum', 'f')} FROM b WHERE n_regionkey = 2 AND c_custkey % 13 <> 4 GROUP BY 1)
SELECT code, {sql_rnd('(o + f) * 1.0 / nullif(p, 0)')} AS prop_alone, {sql_rnd('p')} AS n_people_total, {sql_rnd('o')} AS n_one_person_hh, {sql_rnd('f')} AS n_lone_parents FROM r""")
def living_alone(spark, sf):
    l = ladder(spark, sf).withColumns({
        "p": F.when((F.col("c_custkey") % 211 == 9) & (F.col("n_regionkey") == 2), F.lit(None)).otherwise(F.col("c_custkey") % 60 + 40),
        "o": F.col("c_custkey") % 20, "f": F.col("c_custkey") % 12})

    def census(cond, key, names):
        return l.filter(cond).select(F.col("lsoa").alias(key), *[F.col(c).alias(n) for c, n in zip("pof", names)])

    zones = l.filter("n_regionkey = 2 AND c_custkey % 13 <> 4").select(F.col("lsoa").alias("dz"), F.col("area_code").alias("iz"))
    out = D.living_alone(census("n_regionkey < 2", "code", _ALONE["ew"]), census("n_regionkey = 2", "dz", _ALONE["sco"]),
                         census("n_regionkey > 2", "code", _ALONE["ni"]), zones, _ALONE)
    return out.select("code", *[rnd(c).alias(c) for c in out.columns[1:]])


# ---- indicator table -------------------------------------------------------

_LAD_DEP_SQL = _DEP_SQL.replace("CASE WHEN lsoa LIKE '9%' THEN lad_code ELSE area_code END AS area_code", "lad_code AS area_code")


@query(f"""WITH {_LAD_DEP_SQL}, {_SET_SQL[_SET_SQL.index('ruc AS'):]},
ind AS (SELECT n_nationkey, avg(s_acctbal) AS hle, count(*) FILTER (WHERE s_acctbal > 4000) AS sec95 FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
codes AS (SELECT DISTINCT n_nationkey, lad_code FROM ladder)
SELECT c.lad_code, {country_sql('c.lad_code')} AS country, {sql_rnd('hle', 3)} AS hle_birth, CASE WHEN c.lad_code LIKE 'N%' OR c.lad_code LIKE '9%' THEN NULL ELSE sec95 END AS sec95,
  {sql_rnd('d.prop')} AS prop_top2deciles, {sql_rnd('r.prop')} AS prop_urban
FROM codes c JOIN ind USING (n_nationkey) LEFT JOIN dep_p d ON d.area_code = c.lad_code LEFT JOIN ruc_p r ON r.lad_code = c.lad_code""")
def indicator_table(spark, sf):
    l = ladder(spark, sf)
    deciles = l.select("lsoa", F.when(F.col("c_custkey") % 31 != 7, F.floor((F.col("c_acctbal") + 1000) / 1100.1) + 1).alias("imd_decile"))
    dep = D.deprivation_summary(deciles, l.select("lsoa", "lad_code"), "lsoa", "lad_code", label=False)
    setl = CLASS_QUERIES["settlement_summary"](spark, sf)
    sup = table(spark, sf, "supplier").join(lads(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    ind = sup.groupBy("lad_code").agg(F.avg("s_acctbal").alias("hle_birth"), F.count(F.when(F.col("s_acctbal") > 4000, 1)).alias("sec95"))
    gb = ind.filter(S.has_prefix("lad_code", ["E", "W", "S"]))
    ni = ind.filter(S.has_prefix("lad_code", ["N", "9"])).drop("sec95")
    out = D.indicator_table([gb, ni], "lad_code", ["hle_birth", "sec95"], dep, setl)
    return out.select("lad_code", "country", rnd("hle_birth", 3).alias("hle_birth"), "sec95", rnd("prop_top2deciles").alias("prop_top2deciles"), rnd("prop_urban").alias("prop_urban"))
