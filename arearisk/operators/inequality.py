"""How far apart the most and least deprived, or the most and least urban, areas are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extremes(df: DataFrame, country: str, domains: dict[str, str], indicators: dict[str, tuple[str, str]]) -> DataFrame:
    """Worst value per (country, domain, domain class, indicator).

    `domains` maps domain names to class columns; `indicators` maps names to
    (column, 'max' or 'min'). Columns: country, domain, domain_value,
    indicator, indicator_value.
    """
    ids = [F.col(country).alias("country"), *[F.col(c).cast("double").alias(n) for n, (c, _) in indicators.items()]]
    wide = df.select(*ids, *[F.col(c).cast("int").alias(d) for d, c in domains.items()])
    per_domain = wide.unpivot(["country", *indicators], list(domains), "domain", "domain_value")
    worst = per_domain.groupBy("country", "domain", "domain_value").agg(
        *[{"max": F.max, "min": F.min}[end](n).alias(n) for n, (_, end) in indicators.items()]
    )
    return worst.unpivot(["country", "domain", "domain_value"], list(indicators), "indicator", "indicator_value")


def ranges(long: DataFrame) -> DataFrame:
    """Largest, smallest and their distance per (country, domain, indicator)."""
    return long.groupBy("country", "domain", "indicator").agg(
        F.max("indicator_value").alias("max"), F.min("indicator_value").alias("min")
    ).withColumn("diff", F.abs(F.col("max") - F.col("min")))


def gap(long: DataFrame, domain: str, first: int, last: int) -> DataFrame:
    """Distance between the means of the first and the last class of one domain."""
    def mean_of(v: int):
        return F.avg(F.when(F.col("domain_value") == v, F.col("indicator_value")))

    return (
        long.filter((F.col("domain") == domain) & F.col("domain_value").isin(first, last))
        .groupBy("country", "domain", "indicator")
        .agg(F.abs(mean_of(first) - mean_of(last)).alias("mean_diff"))
    )


def summary(long: DataFrame, ends: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Ranges with the gap of each domain, given as (domain, first class, last class), in one aggregation."""
    def mean_of(place: int):
        wanted = F.coalesce(*[F.when(F.col("domain") == e[0], F.lit(e[place])) for e in ends])
        return F.avg(F.when(F.col("domain_value") == wanted, F.col("indicator_value")))

    return long.groupBy("country", "domain", "indicator").agg(
        F.max("indicator_value").alias("max"), F.min("indicator_value").alias("min"),
        F.abs(mean_of(1) - mean_of(2)).alias("mean_diff"),
    ).select("country", "domain", "indicator", "max", "min", F.abs(F.col("max") - F.col("min")).alias("diff"), "mean_diff")


def indicator_list(long: DataFrame) -> DataFrame:
    return long.select("indicator").distinct().orderBy("indicator")
