import pytest
from pyspark.sql import functions as F

from arearisk.functions import nulls as N
from tests.conftest import rows


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [("full", 1.0, 2.0), ("full", 3.0, 4.0), ("one_gap", None, 1.0), ("one_gap", 5.0, 0.0), ("empty", None, 3.0)],
        "g string, x double, w double")


def test_strict_aggregates_are_poisoned_by_one_gap(groups):
    got = rows(groups.groupBy("g").agg(N.strict_sum("x"), N.strict_min("x"), N.strict_max("x")))
    assert got == [("empty", None, None, None), ("full", 4.0, 1.0, 3.0), ("one_gap", None, None, None)]


def test_skipping_extremes_of_nothing_are_missing(groups):
    got = rows(groups.groupBy("g").agg(F.max("x"), F.min("x"), F.avg("x")))
    assert got == [("empty", None, None, None), ("full", 3.0, 1.0, 2.0), ("one_gap", 5.0, 5.0, 5.0)]


def test_division_never_fails(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(N.ratio("a", "b")).collect()] == [None, None, None, 1.5]


def test_ratio_of_sums_skips_gaps_and_takes_weights(groups):
    assert rows(groups.groupBy("g").agg(N.ratio_of_sums(["x"], "w"))) == [("empty", 0.0), ("full", 4 / 6), ("one_gap", 5.0)]
    both = groups.withColumn("n", F.lit(3))
    assert rows(both.groupBy("g").agg(N.ratio_of_sums(["x", "w"], "w", F.col("n"))))[1] == ("full", 10 / 6)


def test_spread_of_a_single_row_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    assert rows(df.groupBy("g").agg(N.sd_or_zero("x"))) == [("a", 0.0), ("b", pytest.approx(2 ** 0.5))]


def test_row_mean_needs_all_inputs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(N.row_mean("a", "b")).collect()] == [1.5, None]


def test_membership_is_never_missing(spark):
    df = spark.createDataFrame([("E",), ("W",), (None,)], "c string")
    assert [r[0] for r in df.select(N.is_member("c", ["E"])).collect()] == [True, False, False]
    assert [r[0] for r in df.filter(N.not_in("c", ["E"])).collect()] == ["W", None]


def test_nan_and_infinity_become_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(N.finite_or_null("x")).collect()] == [None, None, -1.0, None]


def test_missing_conditions_drop_rows_and_dropna_covers_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert df.filter(F.col("x") <= 1).count() == 1
    assert df.dropna("any").count() == 1
