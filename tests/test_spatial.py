import math
import random

import pytest
from pyspark.sql import functions as F

from arearisk.operators.spatial import points_in_polygons, polygon_boxes, polygon_cover, polygon_edges, polygon_flags
from tests.conftest import rows

LAYER = "id string, rings array<array<array<double>>>"
SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]
HOLE = [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0]]
FAR = [[10.0, 10.0], [12.0, 10.0], [11.0, 12.0]]
BAY = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 1.0], [0.0, 4.0]]


def inside(px, py, rings):
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                n += 1
    return n % 2 == 1


def test_square_hole_parts_and_bay(spark):
    layer = spark.createDataFrame([("square", [SQUARE]), ("hole", [SQUARE, HOLE]), ("parts", [SQUARE, FAR]), ("bay", [BAY])], LAYER)
    pts = spark.createDataFrame([("mid", 2.0, 2.1), ("rim", 0.5, 0.6), ("far", 11.0, 10.5), ("out", -1.0, 2.0), ("gone", None, 1.0)],
                                "p string, x double, y double")
    got = rows(points_in_polygons(pts, "p", "x", "y", layer, "id", "rings"), "p", "id")
    assert got == [("far", "parts"), ("mid", "parts"), ("mid", "square"), ("rim", "bay"), ("rim", "hole"), ("rim", "parts"), ("rim", "square")]


def test_closed_rings_give_the_same(spark):
    layer = spark.createDataFrame([("a", [SQUARE + SQUARE[:1], HOLE + HOLE[:1]])], LAYER)
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.5, 0.5)], "p int, x double, y double")
    assert rows(points_in_polygons(pts, "p", "x", "y", layer, "id", "rings")) == [(2, "a")]


@pytest.mark.parametrize("scale", [1e-4, 1.0, 100.0])
def test_agrees_with_a_scalar_ray_cast_at_all_sizes(spark, scale):
    rng = random.Random(7)
    shapes = []
    for i in range(30):
        size, cx, cy = scale * 10 ** rng.uniform(-2, 0), scale * rng.uniform(-1, 1), scale * rng.uniform(-1, 1)
        n = rng.randint(3, 60)
        ring = [[cx + size * rng.uniform(0.2, 1) * math.cos(2 * math.pi * j / n), cy + size * rng.uniform(0.2, 1) * math.sin(2 * math.pi * j / n)]
                for j in range(n)]
        shapes.append((f"s{i}", [ring]))
    pts = [(j, scale * rng.uniform(-1.5, 1.5), scale * rng.uniform(-1.5, 1.5)) for j in range(400)]
    got = rows(points_in_polygons(spark.createDataFrame(pts, "p int, x double, y double"), "p", "x", "y",
                                  spark.createDataFrame(shapes, LAYER), "id", "rings"), "p", "id")
    assert got == sorted((p, s) for p, x, y in pts for s, rings in shapes if inside(x, y, rings))


def test_cells_without_edges_are_wholly_inside_or_outside(spark):
    """Most points of large polygons need no edge, and none is lost for it: star, comb, hole and two parts, many edges."""
    rng = random.Random(11)
    star = [[10 * (1 + 0.5 * (j % 2)) * math.cos(2 * math.pi * j / 400), 10 * (1 + 0.5 * (j % 2)) * math.sin(2 * math.pi * j / 400)] for j in range(400)]
    comb = [[0.0, 0.0]] + [p for j in range(60) for p in ([j / 2, 9.0 + (j % 3)], [j / 2 + 0.2, 0.5])] + [[30.0, 0.0]]
    ring = [[8 * math.cos(j / 40), 8 * math.sin(j / 40)] for j in range(252)]
    hole = [[5 * math.cos(j / 40), 5 * math.sin(j / 40)] for j in range(252)]
    far = [[20 + x / 9, 30 + y / 9] for x, y in ring]
    shift = [[1e6 + x * 1e-3, 1e6 + y * 1e-3] for x, y in ring]
    shapes = [("star", [star]), ("comb", [comb]), ("rings", [ring, hole, far]), ("shifted", [shift])]
    layer = spark.createDataFrame(shapes, LAYER)
    pts = [(j, rng.uniform(-16, 32), rng.uniform(-16, 32)) for j in range(1500)] + [(j, 1e6 + rng.uniform(-0.01, 0.01), 1e6 + rng.uniform(-0.01, 0.01)) for j in range(1500, 1700)]
    got = rows(points_in_polygons(spark.createDataFrame(pts, "p int, x double, y double"), "p", "x", "y", layer, "id", "rings"), "p", "id")
    assert got == sorted((p, s) for p, x, y in pts for s, rings in shapes if inside(x, y, rings))
    edges = polygon_edges(layer, "id", "rings")
    cover, _ = polygon_cover(edges, polygon_boxes(edges))
    share = {r["feature"]: r["s"] for r in cover.groupBy("feature").agg(F.avg(F.col("inner").cast("int")).alias("s")).collect()}
    assert share["star"] > 0.3 and share["rings"] > 0.2 and share["shifted"] == 0


def test_no_polygons(spark):
    pts = spark.createDataFrame([(1, 2.0, 2.0)], "p int, x double, y double")
    out = points_in_polygons(pts, "p", "x", "y", spark.createDataFrame([], LAYER), "id", "rings")
    assert out.columns == ["p", "id"] and out.count() == 0


def test_flags_for_several_point_sets(spark):
    layer = spark.createDataFrame([("a", [SQUARE]), ("b", [FAR])], LAYER)
    one = spark.createDataFrame([(1, 1.0, 1.0)], "id int, x double, y double")
    two = spark.createDataFrame([("z", 11.0, 10.5), ("y", 99.0, 99.0)], "code string, lon double, lat double")
    got = rows(polygon_flags(layer, "id", "rings", {"shops": (one, "id", "x", "y"), "props": (two, "code", "lon", "lat")}))
    assert got == [("a", "Yes", "No"), ("b", "No", "Yes")]


def test_repeated_and_missing_ids_are_tested_by_place(spark):
    """A point or a polygon given twice, or without an id, is inside like any other."""
    square = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]]
    far = [[[10.0, 10.0], [12.0, 10.0], [12.0, 12.0]]]
    layer = spark.createDataFrame([("a", square), ("a", square), (None, far), ("b", far)], "zone string, rings array<array<array<double>>>")
    points = spark.createDataFrame(
        [("p", 1.0, 1.0), ("p", 1.0, 1.0), (None, 2.0, 2.0), (None, 11.5, 11.0), ("q", 9.0, 9.0), ("p", 50.0, 50.0)], "id string, x double, y double")
    got = points_in_polygons(points, "id", "x", "y", layer, "zone", "rings").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("p", "a"), (None, "a"), (None, None), (None, "b")]))
    flags = polygon_flags(layer, "zone", "rings", {"any": (points, "id", "x", "y")})
    assert {r["zone"]: r["any"] for r in flags.collect()} == {"a": "Yes", "b": "Yes", None: "Yes"}
