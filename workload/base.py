"""Shared pieces: table access, the area ladder on the driver tables, SQL fragments.

The ladder: small area = customer, neighbourhood = nation x market segment,
local authority = nation, country = first letter of the code (from the region).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def registry() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str], Callable]:
    """Queries and their SQL by name, and the decorator that enters them."""
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    texts: dict[str, str] = {}

    def query(sql: str | None = None):
        def add(fn):
            queries[fn.__name__] = fn
            if sql is not None:
                texts[fn.__name__] = sql
            return fn
        return add

    return queries, texts, query


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Rounded double; adding 0.0 turns -0.0 into 0.0."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits) + F.lit(0.0)


def sql_rnd(text: str, digits: int = 6) -> str:
    return f"round(CAST({text} AS DOUBLE), {digits}) + 0.0"


def letter(region: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(x) for x in "EWSN9"]), (region + 1).cast("int"))


def ladder(spark: SparkSession, sf: str) -> DataFrame:
    """One row per small area with the codes of all its parents."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    mark = letter(F.col("n_regionkey"))
    lad = F.concat(mark, F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        "c_custkey", "c_acctbal", "c_mktsegment", "n_nationkey", "n_regionkey",
        F.concat(mark, F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("lsoa"),
        F.concat(lad, F.substring("c_mktsegment", 1, 2)).alias("area_code"),
        lad.alias("lad_code"), F.col("n_name").alias("lad_name"),
    )


def lads(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(
        "n_nationkey", "n_regionkey", F.col("n_name").alias("lad_name"),
        F.concat(letter(F.col("n_regionkey")), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("lad_code"))


LADDER_SQL = """ladder AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, n_nationkey, n_regionkey, n_name AS lad_name,
         substr('EWSN9', n_regionkey + 1, 1) || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS lsoa,
         substr('EWSN9', n_regionkey + 1, 1) || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS lad_code,
         substr('EWSN9', n_regionkey + 1, 1) || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || substr(c_mktsegment, 1, 2) AS area_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

LADS_SQL = """lads AS (
  SELECT n_nationkey, n_regionkey, n_name AS lad_name,
         substr('EWSN9', n_regionkey + 1, 1) || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS lad_code
  FROM nation)"""


def country_sql(code: str) -> str:
    return (f"CASE substr({code}, 1, 1) WHEN 'E' THEN 'England' WHEN 'W' THEN 'Wales' WHEN 'S' THEN 'Scotland' "
            f"WHEN 'N' THEN 'Northern Ireland' WHEN '9' THEN 'Northern Ireland' ELSE '' END")


def strict_sql(agg: str, col: str) -> str:
    return f"CASE WHEN count({col}) = count(*) THEN {agg}({col}) END"


def breaks_sql(source: str, k: int, name: str = "nb") -> str:
    """CTEs for natural breaks over `source` (grp, x): result `<name>` (grp, kk, t, lo, hi).

    Classes t = 1..kk from the lowest values; plain dynamic programme over all segments.
    """
    p = name
    parts = [
        f"{p}_m AS (SELECT grp, avg(x) AS m FROM {source} WHERE x IS NOT NULL GROUP BY grp)",
        f"{p}_v AS (SELECT grp, x, count(*) AS n FROM {source} WHERE x IS NOT NULL GROUP BY grp, x)",
        f"""{p}_p AS (
  SELECT v.grp, v.x, row_number() OVER w AS j, CAST(sum(v.n) OVER w AS DOUBLE) AS sn,
         sum(v.n * (v.x - m.m)) OVER w AS sx, sum(v.n * (v.x - m.m) * (v.x - m.m)) OVER w AS sq
  FROM {p}_v v JOIN {p}_m m ON v.grp = m.grp
  WINDOW w AS (PARTITION BY v.grp ORDER BY v.x ROWS UNBOUNDED PRECEDING))""",
        f"{p}_d AS (SELECT grp, max(j) AS d, least(max(j), {k}) AS kk FROM {p}_p GROUP BY grp)",
        f"{p}_a AS (SELECT grp, j + 1 AS i, sn, sx, sq FROM {p}_p UNION ALL SELECT grp, 1, 0.0, 0.0, 0.0 FROM {p}_d)",
        f"""{p}_s AS (
  SELECT b.grp, a.i, b.j,
         (b.sq - a.sq) - (b.sx - a.sx) * (b.sx - a.sx) / (b.sn - a.sn) AS cost
  FROM {p}_p b JOIN {p}_a a ON a.grp = b.grp AND a.i <= b.j)""",
        f"{p}_f1 AS (SELECT grp, j, cost, 1 AS start FROM {p}_s WHERE i = 1)",
    ]
    for t in range(2, k + 1):
        parts.append(f"""{p}_f{t} AS (
  SELECT s.grp, s.j, min(f.cost + s.cost) AS cost, arg_min(s.i, f.cost + s.cost) AS start
  FROM {p}_f{t - 1} f JOIN {p}_s s ON f.grp = s.grp AND f.j = s.i - 1 GROUP BY s.grp, s.j)""")
    for t in range(k, 0, -1):
        top = f"SELECT f.grp, {t} AS t, f.start AS i, f.j FROM {p}_f{t} f JOIN {p}_d d ON f.grp = d.grp AND f.j = d.d AND d.kk = {t}"
        if t < k:
            top += f" UNION ALL SELECT f.grp, {t}, f.start, f.j FROM {p}_f{t} f JOIN {p}_b{t + 1} b ON f.grp = b.grp AND f.j = b.i - 1"
        parts.append(f"{p}_b{t} AS ({top})")
    every = " UNION ALL ".join(f"SELECT * FROM {p}_b{t}" for t in range(1, k + 1))
    parts.append(f"""{p} AS (
  SELECT b.grp, CAST(d.kk AS BIGINT) AS kk, b.t, l.x AS lo, h.x AS hi
  FROM ({every}) b JOIN {p}_d d ON b.grp = d.grp
  JOIN {p}_p l ON l.grp = b.grp AND l.j = b.i JOIN {p}_p h ON h.grp = b.grp AND h.j = b.j)""")
    return ",\n".join(parts)


def class_sql(name: str, grp: str, x: str) -> str:
    """Scalar subquery: class number (1 = highest) of value `x` in group `grp`."""
    return f"(SELECT max(kk) - count(*) FILTER (WHERE t < kk AND {x} > hi) FROM {name} WHERE {name}.grp = {grp})"
