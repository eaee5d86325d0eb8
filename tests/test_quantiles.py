import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arearisk.operators import profile as P
from arearisk.operators.quantiles import exact_quantiles, medians, quantile_columns, ratio_bin
from tests.conftest import rows

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


SHAPES = {
    "normal": lambda rng, n: rng.normal(size=n), "ties": lambda rng, n: np.round(rng.normal(size=n)),
    "cauchy": lambda rng, n: rng.standard_cauchy(n), "close": lambda rng, n: 1000 + rng.random(n) / 1e6,
    "wide": lambda rng, n: np.exp(rng.uniform(-700, 700, n)) * rng.choice([-1, 1], n),
    "tiny": lambda rng, n: rng.integers(-3, 4, n) * 5e-324,
}


@pytest.mark.parametrize("few_rows,cuts", [(1, 4), (50, 16), (10_000, 1024)])
@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_equal_the_sorted_rule(spark, shape, few_rows, cuts):
    """With few rows to a value and few cuts, many rounds narrow the bins."""
    rng = np.random.default_rng(3)
    data = {g: SHAPES[shape](rng, n) for g, n in (("a", 3000), ("b", 37), ("c", 1), ("d", 2), (None, 500))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, x double")
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "x", PROBS, ["g"], few_rows=few_rows, cuts=cuts).collect()}
    assert len(got) == len(PROBS) * len(data)
    for g, vs in data.items():
        for p in PROBS:
            assert got[g, p] == pytest.approx(float(np.quantile(vs, p)), rel=1e-9, abs=1e-9 if shape != "wide" else 0), (g, p)


@given(st.floats(allow_nan=False, allow_infinity=False), st.floats(allow_nan=False, allow_infinity=False))
@settings(max_examples=25, deadline=None)
def test_ratio_bins_keep_the_order(spark, a, b):
    r = spark.createDataFrame([(min(a, b), max(a, b))], "a double, b double").select(ratio_bin(F.col("a")), ratio_bin(F.col("b"))).first()
    assert r[0] <= r[1]


def test_hot_groups_are_neither_repeated_nor_windowed(spark):
    """Weights are summed, not unfolded, and windows run over bins, not over rows."""
    df = spark.range(200_000).select((F.col("id") % 3 == 0).alias("g"), F.rand(1).alias("x"), F.lit(1_000_000_000).alias("w"))
    out = exact_quantiles(df, "x", [0.5], ["g"], weight="w", few_rows=100)
    assert "Generate explode(sequence" not in out._jdf.queryExecution().toString()
    got = {r["g"]: r["quantile"] for r in out.collect()}
    held = df.toPandas()
    for g, part in held.groupby("g"):
        # Ranks fall inside one repeated value or between two neighbours.
        x = np.sort(part["x"].to_numpy())
        assert got[g] == pytest.approx(x[len(x) // 2] if len(x) % 2 else (x[len(x) // 2 - 1] + x[len(x) // 2]) / 2, rel=1e-12)


def test_no_values_no_rows(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 2.0, 0), ("c", float("nan"), 3)], "g string, x double, w int")
    assert exact_quantiles(df, "x", [0.5], ["g"], weight="w").count() == 0
    assert exact_quantiles(df, "x", [0.5], weight="w").count() == 0


def test_weights_repeat_rows(spark):
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=3000), rng.integers(0, 9, 3000)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, w)], "x double, w int")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "x", [0.1, 0.5], weight="w", few_rows=100).collect()}
    fan = np.repeat(x, w)
    assert got[0.5] == pytest.approx(np.quantile(fan, 0.5)) and got[0.1] == pytest.approx(np.quantile(fan, 0.1))


def test_quarter_points_of_four_numbers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    r = quantile_columns(df, "x", {"q1": 0.25, "q2": 0.5, "q3": 0.75}).first()
    assert tuple(r) == (1.75, 2.5, 4.75)


def test_medians_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, 4.0), ("b", None, None)], "g string, x double, y double")
    assert rows(medians(df, ["x", "y"], ["g"])) == [("a", 2.0, 4.0)]


def test_six_numbers_and_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("b", 5.0)], "g string, x double")
    assert rows(P.six_numbers(df, "x", ["g"])) == [("a", 1.0, 1.75, 2.5, 4.0, 4.75, 10.0), ("b", *[5.0] * 6)]
    assert rows(P.spread(df, "x", ["g"]))[1] == ("b", 5.0, 0.0, 5.0, 5.0)
    assert rows(P.totals(df, "x", ["g"])) == [("a", 16.0), ("b", 5.0)]


def test_histogram_bins_are_centred_and_right_closed(spark):
    df = spark.createDataFrame([(-0.5,), (0.4,), (0.5,), (0.6,), (1.5,), (None,)], "x double")
    assert rows(P.histogram(df, "x", 1)) == [(-1.0, 1), (0.0, 2), (1.0, 2)]


def test_box_whiskers_end_on_data(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 5, 100)], "g string, x double")
    assert rows(P.box(df, "x", ["g"])) == [("a", 2.25, 3.5, 4.75, 1.0, 5.0, 1)]
