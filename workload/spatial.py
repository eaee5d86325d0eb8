"""Points and polygons made from the embeddings: one polygon with a hole and a second part per label."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from arearisk.operators.spatial import points_in_polygons, polygon_flags
from workload.base import registry, table

QUERIES, SQL, query = registry()


# Offsets from a label's mean in standard deviations: outer ring, hole, second part.
OUTER = [(round(1.2 * math.cos(i * math.pi / 4), 3), round(1.2 * math.sin(i * math.pi / 4), 3)) for i in range(8)]
HOLE = [(0.3, 0.25), (-0.3, 0.35), (-0.25, -0.3), (0.35, -0.3)]
PART = [(1.5, 1.5), (2.5, 1.4), (2.4, 2.6)]
RINGS = [OUTER, HOLE, PART]


def points(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


def layer(spark, sf):
    e = table(spark, sf, "embeddings").select(
        "label", F.col("embedding")[2].cast("double").alias("u"), F.col("embedding")[3].cast("double").alias("v"))
    box = e.groupBy("label").agg(
        F.round(F.avg("u"), 9).alias("cx"), F.round(F.avg("v"), 9).alias("cy"), F.round(F.stddev_samp("u"), 9).alias("r"))
    rings = F.array(*[
        F.array(*[F.array(F.col("cx") + F.col("r") * F.lit(a), F.col("cy") + F.col("r") * F.lit(b)) for a, b in ring]) for ring in RINGS])
    return box.select("label", rings.alias("rings"))


def _edges_sql() -> str:
    rows = []
    for ring in RINGS:
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"({a}, {b}, {c}, {d})")
    return ", ".join(rows)


_PIP_SQL = f"""pts AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
box AS (SELECT label, round(avg(CAST(embedding[3] AS DOUBLE)), 9) AS cx, round(avg(CAST(embedding[4] AS DOUBLE)), 9) AS cy,
        round(stddev_samp(CAST(embedding[3] AS DOUBLE)), 9) AS r FROM embeddings GROUP BY 1),
off AS (SELECT * FROM (VALUES {_edges_sql()}) t(a, b, c, d)),
edge AS (SELECT label, cx + r * CAST(a AS DOUBLE) AS x1, cy + r * CAST(b AS DOUBLE) AS y1, cx + r * CAST(c AS DOUBLE) AS x2, cy + r * CAST(d AS DOUBLE) AS y2 FROM box, off),
hit AS (SELECT vec_id, label FROM pts, edge WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1),
inside AS (SELECT vec_id, label FROM hit GROUP BY 1, 2 HAVING count(*) % 2 = 1)"""


@query(f"WITH {_PIP_SQL} SELECT vec_id, label FROM inside")
def point_in_polygon(spark, sf):
    return points_in_polygons(points(spark, sf), "vec_id", "x", "y", layer(spark, sf), "label", "rings")


# Three point sets, each of all vectors: their first two entries, and two others further and further off.
_SETS = {"has_near": (0, 0.4), "has_off": (4, 0.5), "has_far": (8, 0.5)}


def _set_sql(name: str, at: int, shift: float) -> str:
    return f"""{name} AS (SELECT DISTINCT label FROM (SELECT label, vec_id FROM (
  SELECT vec_id, CAST(embedding[{at + 1}] AS DOUBLE) + {shift} AS x, CAST(embedding[{at + 2}] AS DOUBLE) + {shift} AS y FROM embeddings), edge
  WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY label, vec_id HAVING count(*) % 2 = 1))"""


@query(f"""WITH {_PIP_SQL}, {", ".join(_set_sql(n, *v) for n, v in _SETS.items())}
SELECT label, {", ".join(f"CASE WHEN label IN (SELECT label FROM {n}) THEN 'Yes' ELSE 'No' END AS {n}" for n in _SETS)} FROM (SELECT DISTINCT label FROM embeddings)""")
def polygon_has_point(spark, sf):
    """Three named point sets in one pass."""
    e = table(spark, sf, "embeddings")
    sets = {name: (e.select("vec_id", (F.col("embedding")[at].cast("double") + shift).alias("x"),
                            (F.col("embedding")[at + 1].cast("double") + shift).alias("y")), "vec_id", "x", "y")
            for name, (at, shift) in _SETS.items()}
    return polygon_flags(layer(spark, sf), "label", "rings", sets)
