import random

from pyspark.sql import functions as F

from arearisk.operators import inequality as I
from arearisk.operators import reshape as R
from tests.conftest import rows


def test_crosstab_counts_missing_apart_and_share_ignores_it(spark):
    t = spark.createDataFrame([("a", "U"), ("a", None), ("b", "R"), (None, "U")], "k string, c string")
    x = R.share(R.crosstab(t, "k", "c", ["U", "R"]), "U", ["R"], "p")
    assert rows(x) == [("a", 1, 0, 1, 1.0), ("b", 0, 1, 0, 0.0), (None, 1, 0, 0, 1.0)]


def test_pivot_fills_absent_combinations_only(spark):
    t = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", None), ("b", "x", 5)], "k string, n string, v int")
    assert rows(R.pivot_sum(t, ["k"], "n", "v", ["x", "y"])) == [("a", 3, 0), ("b", 5, None)]


def test_pivot_with_prefix(spark):
    t = spark.createDataFrame([("a", 1, 0.5), ("a", 10, 2.0), ("b", 1, 3.0)], "k string, d int, v double")
    p = R.pivot_prefixed(t, ["k"], "d", "v", [1, 10], "Dep_")
    assert p.columns == ["k", "Dep_1", "Dep_10"] and rows(p) == [("a", 0.5, 2.0), ("b", 3.0, None)]


def test_sum_all_is_strict(spark):
    t = spark.createDataFrame([("a", 1, 2), ("a", 3, None)], "k string, `x y` int, z int")
    assert rows(R.sum_all(t, "k")) == [("a", 4, None)]


def test_long_keeps_missing_values(spark):
    t = spark.createDataFrame([("a", 1.0, None)], "k string, x double, y double")
    assert rows(R.to_long(t, ["k"], ["x", "y"], "n", "v")) == [("a", "x", 1.0), ("a", "y", None)]


def test_fill_down_carries_over_block_borders(spark):
    random.seed(2)
    data, want = [], {}
    for g in "ab":
        last = None
        for i in range(200):
            v = random.random() if random.random() < 0.03 else None
            last = v if v is not None else last
            data.append((g, i, v))
            want[g, i] = last
    df = spark.createDataFrame(data, "g string, i long, v double").repartition(5)
    for size in (1, 7, 1000):
        got = {(r["g"], r["i"]): r["f"] for r in R.fill_down(df, ["g"], "i", "v", "f", block_rows=size).collect()}
        assert got == want


def test_top_n_keeps_ties(spark):
    t = spark.createDataFrame([("a", 5), ("a", 5), ("a", 1), ("b", None), ("b", 2)], "g string, v int")
    assert rows(R.top_n(t, ["g"], "v", 1)) == [("a", 5), ("a", 5), ("b", 2)]


def test_inequality_from_areas_to_gaps(spark):
    t = spark.createDataFrame(
        [("E", 1, 1, 60.0, 5.0), ("E", 10, 3, 70.0, None), ("E", 1, 3, 58.0, 7.0), ("W", 1, 1, None, None)],
        "c string, dep int, urb int, hle double, fires double")
    long = I.extremes(t, "c", {"Deprivation": "dep", "Settlement": "urb"}, {"Life": ("hle", "min"), "Fires": ("fires", "max")})
    assert ("E", "Deprivation", 1, "Life", 58.0) in rows(long) and ("W", "Deprivation", 1, "Fires", None) in rows(long)
    s = {(r["country"], r["domain"], r["indicator"]): (r["max"], r["min"], r["diff"], r["mean_diff"])
         for r in I.summary(long, [("Deprivation", 1, 10), ("Settlement", 1, 3)]).collect()}
    assert s["E", "Deprivation", "Life"] == (70.0, 58.0, 12.0, 12.0)
    assert s["E", "Deprivation", "Fires"] == (7.0, 7.0, 0.0, None)
    assert s["W", "Settlement", "Life"] == (None, None, None, None)
    assert [r[0] for r in I.indicator_list(long).collect()] == ["Fires", "Life"]


def test_gap_needs_both_ends(spark):
    long = spark.createDataFrame([("E", "D", 1, "x", 4.0), ("E", "D", 1, "x", 6.0), ("E", "D", 5, "x", 100.0)],
                                 "country string, domain string, domain_value int, indicator string, indicator_value double")
    assert rows(I.gap(long, "D", 1, 10)) == [("E", "D", "x", None)]
    more = long.unionByName(long.limit(1).withColumn("domain_value", F.lit(10)).withColumn("indicator_value", F.lit(1.0)))
    assert rows(I.gap(more, "D", 1, 10)) == [("E", "D", "x", 4.0)]
