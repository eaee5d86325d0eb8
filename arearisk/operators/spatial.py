"""Which points lie in which polygons, by joins on grid cells and edge bands.

Layers are rows of (feature id, rings), rings being arrays of [x, y] points in
longitude and latitude; outer rings, parts and holes may be mixed, as a point
is inside when a ray from it crosses the edges an odd number of times.

1. Every polygon goes to the grid level on which its box spans at most two
   cells each way, so it fills at most four cells however large it is. Points
   look into one cell per level in use (at most 64). Only pairs whose box
   holds the point survive.
2. The box of a polygon is cut into bands and columns, about as many each as the
   square root of its edges. A cell that no edge touches lies wholly inside or
   outside; which, follows from the crossings to its right. Pairs in an inner cell
   need no test, pairs in an outer one go.
3. Only pairs in cells that an edge touches meet the edges of their band, which
   come as one array, so crossings are counted in the row and nothing is shuffled
   for them.

The joins are equi-joins without hints: small layers are broadcast by their
checked size, large ones are shuffled with hot cells split by adaptive
execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.operators.joins import attach, union_filled
from arearisk.scratch import materialize

MIN_LEVEL, MAX_LEVEL = -20, 43  # cell side = 1024 / 2**level; at most 64 levels
BASE_SIDE = 1024.0
MIN_PARTS = 8  # bands, and columns, of the smallest polygon


def _side(level):
    return F.lit(BASE_SIDE) / F.pow(F.lit(2.0), level)


def polygon_edges(layer: DataFrame, feature: str, rings: str) -> DataFrame:
    """One row per non-horizontal edge: feature, x1, y1, x2, y2. Open rings are closed."""
    ring = layer.select(F.col(feature).alias("feature"), F.explode(rings).alias("ring"))
    closed = ring.withColumn("ring", F.concat("ring", F.slice("ring", 1, 1)))
    step = closed.select(
        "feature",
        F.explode(F.arrays_zip(
            F.slice("ring", F.lit(1), F.size("ring") - 1).alias("a"),
            F.slice("ring", F.lit(2), F.size("ring") - 1).alias("b"),
        )).alias("e"),
    )
    out = step.select(
        "feature",
        F.col("e.a")[0].cast("double").alias("x1"), F.col("e.a")[1].cast("double").alias("y1"),
        F.col("e.b")[0].cast("double").alias("x2"), F.col("e.b")[1].cast("double").alias("y2"),
    )
    return out.filter(F.col("y1") != F.col("y2"))


def _place(c: Column, start: Column, step: Column, parts: Column) -> Column:
    """Band or column of a coordinate; never falls as the coordinate grows."""
    return F.least(F.greatest(F.floor((c - start) / step), F.lit(0)), parts - 1).cast("int")


def polygon_boxes(edges: DataFrame) -> DataFrame:
    """Box, grid level, and sizes of bands and columns per feature."""
    boxes = edges.groupBy("feature").agg(
        F.min(F.least("x1", "x2")).alias("xmin"), F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.min(F.least("y1", "y2")).alias("ymin"), F.max(F.greatest("y1", "y2")).alias("ymax"), F.count(F.lit(1)).alias("n_edges"))
    span = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return boxes.withColumn("level", F.least(F.lit(MAX_LEVEL), F.greatest(
        F.lit(MIN_LEVEL), F.floor(F.log2(F.lit(BASE_SIDE) / span)))).cast("int")).withColumns({
            "parts": F.greatest(F.lit(MIN_PARTS), F.ceil(F.sqrt("n_edges"))).cast("int"),
            # Where a box is tiny beside its coordinates, rounding could put an edge into the wrong cell: no cell counts as free.
            "coarse": span < F.lit(1e-6) * F.greatest(F.abs("xmin"), F.abs("xmax"), F.abs("ymin"), F.abs("ymax")),
        }).withColumns({"height": (F.col("ymax") - F.col("ymin")) / F.col("parts"), "width": (F.col("xmax") - F.col("xmin")) / F.col("parts")})


def polygon_cover(edges: DataFrame, boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells (feature, band, col, inner) that are not outside, and the edges of each band that cells with `inner` false need."""
    shape = boxes.select("feature", "xmin", "xmax", "ymin", "height", "width", "parts", "coarse")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.join(shape, "feature").withColumn("band", F.explode(F.sequence(
        _place(low, F.col("ymin"), F.col("height"), F.col("parts")), _place(high, F.col("ymin"), F.col("height"), F.col("parts")))))

    def x_at(y: Column) -> Column:
        return F.col("x1") + (F.col("x2") - F.col("x1")) * ((y - F.col("y1")) / (F.col("y2") - F.col("y1")))

    bottom, middle = F.col("ymin") + F.col("band") * F.col("height"), F.col("ymin") + (F.col("band") + 0.5) * F.col("height")
    # The stretch of the edge within its band, a little wider than it is, so that rounding frees no touched cell.
    slack = F.lit(1e-9) * (F.col("xmax") - F.col("xmin"))
    begin, end = x_at(F.greatest(low, bottom)), x_at(F.least(high, bottom + F.col("height")))

    def column(x: Column) -> Column:
        return _place(x, F.col("xmin"), F.col("width"), F.col("parts"))

    first = F.when(F.col("coarse"), 0).otherwise(column(F.least(begin, end) - slack))
    last = F.when(F.col("coarse"), F.col("parts") - 1).otherwise(column(F.greatest(begin, end) + slack))
    crosses = (F.col("y1") > middle) != (F.col("y2") > middle)
    touched = banded.select("feature", "band", "parts", F.explode(F.sequence(first, last)).alias("col"),
                            F.when(crosses, column(x_at(middle))).alias("crossed"))
    cells = touched.groupBy("feature", "band", "parts", "col").agg((F.count(F.when(F.col("crossed") == F.col("col"), 1)) % 2).alias("odd"))
    # At most `parts` cells of a band.
    per_band = cells.groupBy("feature", "band", "parts").agg(F.collect_list(F.struct("col", "odd")).alias("t"))
    free = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda c: ~F.exists("t", lambda t: t["col"] == c) & (
        F.aggregate("t", F.lit(0).cast("bigint"), lambda n, t: n + F.when(t["col"] > c, t["odd"]).otherwise(0)) % 2 == 1))
    cover = per_band.select("feature", "band", F.explode(F.concat(
        F.transform("t", lambda t: F.struct(t["col"].alias("col"), F.lit(False).alias("inner"))),
        F.transform(free, lambda c: F.struct(c.alias("col"), F.lit(True).alias("inner"))))).alias("c"))
    bands = banded.groupBy("feature", "band").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    return cover.select("feature", "band", "c.col", "c.inner"), bands


def points_in_polygons(points: DataFrame, point: str, x: str, y: str,
                       layer: DataFrame, feature: str, rings: str) -> DataFrame:
    """Distinct (point, feature) pairs with the point inside a row of the feature.

    Crossings are counted per row of the points and of the layer, not per id: a repeated id or row,
    or one without an id, is tested like any other.
    """
    # Stored, so that the numbers stay the same wherever the rows are read again.
    layer = materialize(layer.select(F.col(feature).alias("feature_id"), F.col(rings).alias("rings")).withColumn(
        "feature_row", F.monotonically_increasing_id()), "polygon-rows")
    edges = polygon_edges(layer, "feature_row", "rings")
    boxes = materialize(polygon_boxes(edges), "polygon-boxes")
    levels = sorted(r[0] for r in boxes.select("level").distinct().collect())  # at most 64 numbers
    if not levels:
        return points.select(F.col(point).alias(point), F.lit(None).cast(layer.schema["feature_id"].dataType).alias(feature)).limit(0)
    # Stored after the explodes, so that the planner sees the size of what it may broadcast.
    cover, bands = (materialize(df, "polygon-cover") for df in polygon_cover(edges, boxes))

    def cell(c, level):
        return F.floor(c / _side(level)).cast("long")

    cells = (
        boxes.withColumn("cx", F.explode(F.sequence(cell(F.col("xmin"), F.col("level")), cell(F.col("xmax"), F.col("level")))))
        .withColumn("cy", F.explode(F.sequence(cell(F.col("ymin"), F.col("level")), cell(F.col("ymax"), F.col("level")))))
    )
    probes = (
        points.select(F.col(point).alias("point"), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"))
        .filter(F.col("px").isNotNull() & F.col("py").isNotNull())
        .withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])))
        .withColumn("cx", cell(F.col("px"), F.col("level")))
        .withColumn("cy", cell(F.col("py"), F.col("level")))
    )
    in_box = (
        (F.col("px") >= F.col("xmin")) & (F.col("px") <= F.col("xmax"))
        & (F.col("py") >= F.col("ymin")) & (F.col("py") <= F.col("ymax"))
    )
    pairs = probes.join(cells, ["level", "cx", "cy"]).filter(in_box).select(
        "point", "px", "py", "feature",
        _place(F.col("py"), F.col("ymin"), F.col("height"), F.col("parts")).alias("band"),
        _place(F.col("px"), F.col("xmin"), F.col("width"), F.col("parts")).alias("col"))
    near = pairs.join(cover, ["feature", "band", "col"]).withColumn("edge_band", F.when(~F.col("inner"), F.col("band")))
    tested = near.join(bands.withColumnsRenamed({"feature": "edge_feature", "band": "edges_of"}),
                       (F.col("feature") == F.col("edge_feature")) & (F.col("edge_band") == F.col("edges_of")), "left")
    crossing = F.size(F.filter("edges", lambda e: ((e["y1"] > F.col("py")) != (e["y2"] > F.col("py"))) & (
        F.col("px") < (e["x2"] - e["x1"]) * (F.col("py") - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])))
    inside = tested.filter(F.col("inner") | (crossing % 2 == 1)).select("point", "feature")
    named = inside.join(layer.select("feature_id", F.col("feature_row").alias("feature")), "feature")
    return named.select(F.col("point").alias(point), F.col("feature_id").alias(feature)).distinct()


def polygon_flags(layer: DataFrame, feature: str, rings: str,
                  point_sets: dict[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Yes/No per polygon and named point set: does any of its points lie inside?

    Point sets map a column name to (points, id column, x column, y column).
    """
    tagged = union_filled(*[
        points.select(F.struct(F.lit(name).alias("set"), F.col(pid).cast("string").alias("id")).alias("point"),
                      F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        for name, (points, pid, x, y) in point_sets.items()
    ])
    found = points_in_polygons(tagged, "point", "x", "y", layer, feature, rings)
    hits = found.groupBy(feature).agg(*[F.max(F.col("point.set") == n).alias(n) for n in point_sets])
    own = layer.select(feature).distinct()
    marked = own.join(hits.withColumnRenamed(feature, "hit_feature"), own[feature].eqNullSafe(F.col("hit_feature")), "left")
    return marked.select(feature, *[F.when(F.col(n), "Yes").otherwise("No").alias(n) for n in point_sets])
