"""Readers and writers: tables are written in each staged format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.plans import datasets as D
from arearisk.scratch import scratch_path
from arearisk.sources import readers as R
from arearisk.sources import writers as W
from workload.base import big, registry, rnd, sql_rnd, table
from workload.products import DIGITAL_SQL, placemarks
from workload.spatial import HOLE, OUTER, PART, layer, points

QUERIES, SQL, query = registry()


@query("SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def csv_round_trip(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).alias("c_name"),
                                            F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    path = scratch_path(spark, "csv")
    W.write_csv(c, path)
    return R.read_csv(spark, path, R.typed_schema(c.columns, overrides={"c_custkey": T.LongType(), "c_name": T.StringType()}))


@query(f"""SELECT s_suppkey // 1000 AS sheet, s_suppkey % 1000 + 1 AS row_no, 'E' || CAST(s_suppkey AS VARCHAR) AS code, {sql_rnd('CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_acctbal END')} AS hle FROM supplier""")
def sheet_scan(spark, sf):
    """Worksheets of up to 1,000 suppliers with three title rows, read as one table."""
    s = table(spark, sf, "supplier").select(
        F.floor(F.col("s_suppkey") / 1000).alias("sheet"), "s_suppkey",
        F.concat_ws(",", F.concat(F.lit("E"), F.col("s_suppkey").cast("string")), F.lit("\"a, quoted\""),
                    F.when(F.col("s_suppkey") % 6 == 5, "").otherwise(F.col("s_acctbal").cast("string"))).alias("line"))
    head = F.array(F.lit("Title"), F.lit(""), F.lit("Period 2016-18"), F.lit("Area Codes,Notes,HLE"))
    lines = F.array_sort(F.collect_list(F.struct("s_suppkey", "line")))  # at most 1,000 rows per sheet
    path = scratch_path(spark, "sheets")
    s.groupBy("sheet").agg(F.concat_ws("\n", F.concat(head, lines["line"])).alias("value")).write.partitionBy("sheet").text(path)
    rows = R.read_sheets(spark, f"{path}/*", {"Area Codes": ("code", T.StringType()), "HLE": ("hle", T.DoubleType())}, skip=3, tag="folder")
    return rows.select(F.regexp_replace("sheet", "sheet=", "").cast("long").alias("sheet"), "row_no", "code", rnd("hle").alias("hle"))


@query(f"""SELECT o_orderstatus AS sheet, count(*) AS n, count(DISTINCT o_orderkey) AS keys, sum(o_orderkey) AS key_sum, sum(length(p)) AS letters,
       {sql_rnd('sum(CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END)', 1)} AS price
FROM (SELECT *, o_orderstatus || chr(10) || '"' || CAST(o_orderkey AS VARCHAR) || '", x' || chr(10) AS p FROM orders) GROUP BY 1""")
def sheets_mixed_headers(spark, sf):
    """Order sheets per status whose columns come in different orders, with quotes, separators and line ends in cells."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("Price, total"),
        F.concat("o_orderstatus", F.lit('\n"'), F.col("o_orderkey").cast("string"), F.lit('", x\n')).alias("Notes"), "o_orderstatus")
    path = scratch_path(spark, "mixed")
    for status, order in (("F", ["Order", "Price, total", "Notes"]), ("O", ["Notes", "Order", "Price, total"]), ("P", ["Price, total", "Notes", "Order"])):
        o.filter(F.col("o_orderstatus") == status).select(*order).write.option("header", True).options(
            escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{path}/{status}")
    rows = R.read_sheets(spark, f"{path}/*", {"Notes": ("notes", T.StringType()), "Order": ("key", T.LongType()), "Price, total": ("price", T.DoubleType())},
                         tag="folder")
    whole = F.concat("sheet", F.lit('\n"'), F.col("key").cast("string"), F.lit('", x\n'))
    return rows.groupBy("sheet").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("keys"), F.sum("key").alias("key_sum"),
        big(F.sum(F.when(F.col("notes") == whole, F.length("notes")))).alias("letters"), rnd(F.sum("price"), 1).alias("price"))


@query(DIGITAL_SQL)
def xml_placemarks(spark, sf):
    """Digital ratings through one XML file set per metric."""
    marks = placemarks(spark, sf)
    paths = {}
    for metric in D.DIGITAL_METRICS:
        paths[metric] = scratch_path(spark, f"xml-{metric}")
        marks.filter(F.col("metric") == metric).select("name", F.col("style_url").alias("styleUrl")).write.format("xml").option(
            "rowTag", "Placemark").option("rootTag", "kml").save(paths[metric])
    out = D.digital_exclusion(R.read_placemarks(spark, paths))
    return out.select("la_code", *[big(c).alias(c) for c in out.columns[1:]])


def _feature(kind: str, coordinates, **properties):
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties"),
        F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))


@query(f"SELECT 'p' || CAST(vec_id AS VARCHAR) AS oa, {sql_rnd('embedding[1]')} AS x, {sql_rnd('embedding[2]')} AS y FROM embeddings")
def geojson_points(spark, sf):
    path = scratch_path(spark, "points")
    p = points(spark, sf)
    p.select(_feature("Point", F.array("x", "y"), oa=F.concat(F.lit("p"), F.col("vec_id").cast("string")))).write.text(path)
    out = R.read_points(spark, path, R.typed_schema(["oa"], T.StringType()))
    return out.select("oa", rnd("x").alias("x"), rnd("y").alias("y"))


_BOX_SQL = """box AS (SELECT label, round(avg(CAST(embedding[3] AS DOUBLE)), 9) AS cx, round(avg(CAST(embedding[4] AS DOUBLE)), 9) AS cy,
  round(stddev_samp(CAST(embedding[3] AS DOUBLE)), 9) AS r FROM embeddings GROUP BY 1)"""
_OFFSETS = [(i, j, a, b) for i, ring in enumerate([OUTER, HOLE, PART]) for j, (a, b) in enumerate(ring)]


@query(f"""WITH {_BOX_SQL}, off AS (SELECT * FROM (VALUES {', '.join(str(o) for o in _OFFSETS)}) t(ring, pos, a, b))
SELECT CAST(label AS BIGINT) AS label, CAST(ring AS BIGINT) AS ring, CAST(pos AS BIGINT) AS pos, {sql_rnd('cx + r * CAST(a AS DOUBLE)')} AS x, {sql_rnd('cy + r * CAST(b AS DOUBLE)')} AS y FROM box, off""")
def geojson_polygons(spark, sf):
    """Polygons with holes and multi-polygons, one feature per line, back as rings."""
    path = scratch_path(spark, "polygons")
    shapes = layer(spark, sf)
    part = F.array(F.slice("rings", 1, 2), F.slice("rings", 3, 1))
    lines = shapes.filter("label % 2 = 0").select(_feature("MultiPolygon", part, label=F.col("label")).alias("value")).unionByName(
        shapes.filter("label % 2 = 1").select(_feature("Polygon", F.col("rings"), label=F.col("label")).alias("value")))
    lines.write.text(path)
    out = R.read_polygons(spark, path, R.typed_schema(["label"], T.LongType()))
    xy = out.select("label", F.posexplode("rings").alias("ring", "r")).select("label", "ring", F.posexplode("r").alias("pos", "p"))
    return xy.select("label", big("ring").alias("ring"), big("pos").alias("pos"), rnd(F.col("p")[0]).alias("x"), rnd(F.col("p")[1]).alias("y"))


@query(f"""SELECT strftime(o_orderdate, '%Y') AS "Year_Code", o_orderstatus AS "Area_Code", count(*) AS n, {sql_rnd('sum(o_totalprice)', 1)} AS "Data" FROM orders GROUP BY 1, 2""")
def portal_records(spark, sf):
    path = scratch_path(spark, "records")
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy").alias("Year_Code"), F.col("o_orderstatus").alias("Area_Code"),
                                          F.col("o_totalprice").alias("Data"))
    o.write.json(path)
    rows = R.read_records(spark, path, R.typed_schema(["Year_Code", "Area_Code", "Data"], T.StringType(), {"Data": T.DoubleType()}))
    return rows.groupBy("Year_Code", "Area_Code").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("Data"), 1).alias("Data"))


@query(f"""SELECT r_name AS sheet, s_name AS "Local Authority", CASE WHEN s_acctbal < 0 THEN NULL ELSE {sql_rnd('s_acctbal')} END AS "Total score"
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def report_sheets(spark, sf):
    s = (table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    t = s.select("r_name", F.col("s_name").alias("Local Authority"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("Total score"))
    path = scratch_path(spark, "report")
    names = [r[0] for r in table(spark, sf, "region").select("r_name").collect()]  # the five sheets
    W.write_report({n: t.filter(F.col("r_name") == n).drop("r_name") for n in names}, path)
    schema = R.typed_schema(["Local Authority", "Total score", "sheet"], T.StringType(), {"Total score": T.DoubleType()})
    return R.read_csv(spark, path, schema).select("sheet", "Local Authority", rnd("`Total score`").alias("Total score"))
