"""Distribution tables by group: the numbers behind summaries, histograms and box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.functions.nulls import sd_or_zero
from arearisk.operators.joins import attach
from arearisk.operators.quantiles import quantile_columns
from arearisk.scratch import materialize


def six_numbers(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Minimum, quartiles, mean and maximum per group."""
    quart = quantile_columns(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    rest = df.groupBy(*by).agg(F.min(value).alias("minimum"), F.avg(value).alias("mean"), F.max(value).alias("maximum"))
    return attach(rest, quart, by, null_safe=True).select(*by, "minimum", "q1", "median", "mean", "q3", "maximum")


def histogram(df: DataFrame, value: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin; bins are centred on multiples of the width and closed on the right."""
    centre = (F.ceil(F.col(value) / F.lit(float(width)) - F.lit(0.5)) * F.lit(float(width))).cast("double")
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, centre.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box(df: DataFrame, value: str, by: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers that end on data within `reach` quartile ranges, and outlier counts."""
    rows = df.select(*by, F.col(value).alias("x")).filter(F.col("x").isNotNull())
    quart = materialize(quantile_columns(rows, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by), "box-quartiles")
    span = (F.col("q3") - F.col("q1")) * F.lit(reach)
    inside = (F.col("x") >= F.col("q1") - span) & (F.col("x") <= F.col("q3") + span)
    return attach(rows, quart, by, "inner", null_safe=True).groupBy(*by).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )


def spread(df: DataFrame, value: str, by: Sequence[str], centre: str = "median") -> DataFrame:
    """Centre with one standard deviation to each side."""
    if centre == "median":
        sd = df.groupBy(*by).agg(sd_or_zero(value).alias("sd"))
        out = attach(sd, quantile_columns(df, value, {"centre": 0.5}, by), by, null_safe=True)
    else:
        out = df.groupBy(*by).agg(F.avg(value).alias("centre"), sd_or_zero(value).alias("sd"))
    return out.select(
        *by, "centre", "sd", (F.col("centre") - F.col("sd")).alias("low"), (F.col("centre") + F.col("sd")).alias("high")
    )


def totals(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias("total"))
