"""Exact quantiles per group by radix selection: no row is repeated, sorted or gathered by group.

The first round puts values into bins of equal ratio and adds up rows and weights
per (group, bin), with the least and largest value of each bin. Running weights over
the bins of a group, whose number is bounded, tell which bins hold a wanted rank.
Only their rows go on to a round that cuts each such bin into `CUTS` equal parts, or
into its single values once it has few rows, until every wanted bin is one value.
Each round narrows a bin by a factor of `CUTS`, so there are at most seven.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arearisk.functions.nulls import finite_or_null
from arearisk.operators.joins import attach
from arearisk.scratch import materialize

#: First bins per doubling of the value, and equal parts of a bin in later rounds.
PER_DOUBLING, CUTS = 16, 1024

#: A bin of at most this many rows is cut into its values.
FEW_ROWS = 10_000


def ratio_bin(x: Column) -> Column:
    """A whole number that never falls as the value grows; 0 for zero, negative numbers for negative values."""
    # The smallest double is 2 ** -1074.
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (1 + F.floor(PER_DOUBLING * (F.log2(F.abs(x)) + 1075))))


def _with_below(bins: DataFrame, keys: Sequence[str], start: Column) -> DataFrame:
    """Weight `below` each bin: `start` and the bins before it in the same group of keys."""
    running = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("__below", start + F.coalesce(F.sum("__w").over(running), F.lit(0)))


def _wanted(probs: Sequence[float]) -> Column:
    """Whether a bin holds one of the order statistics (counted from 0) that the probabilities need."""
    ranks = [(F.col("__n") - 1) * F.lit(p) for p in probs]
    places = [f(r) for r in ranks for f in (F.floor, F.ceil)]
    return F.exists(F.array(*places), lambda k: (k >= F.col("__below")) & (k < F.col("__below") + F.col("__w")))


def _bins(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "__bin").agg(
        F.sum("__w").alias("__w"), F.count(F.lit(1)).alias("__rows"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))


def _cut(rows: DataFrame, few_rows: int, cuts: int) -> DataFrame:
    """Rows of open bins with the number of the part that they fall into: the value itself in a bin of few rows."""
    part = F.floor((F.col("__x") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * cuts).cast("double")
    return rows.withColumn("__bin", F.when(F.col("__rows") <= few_rows, F.col("__x")).otherwise(part)) \
        .withColumnRenamed("__below", "__start")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    weight: str | None = None, few_rows: int = FEW_ROWS, cuts: int = CUTS) -> DataFrame:
    """Linear-interpolation quantiles: one row per group and probability.

    Columns: `by`, `prob`, `quantile`. `weight` is a whole-number repeat count; the result equals the quantile of the
    repeated rows. Missing values and weights below one are left out; a group without any value has no row.
    """
    probs = [float(p) for p in probs]
    rows = df.select(
        *(by or [F.lit(0).alias("__all")]), finite_or_null(value).alias("__x"),
        (F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias("__w"),
    ).filter(F.col("__x").isNotNull() & (F.col("__w") > 0))
    keys = list(by) or ["__all"]
    rows = rows.withColumn("__bin", ratio_bin(F.col("__x")))
    bins = _with_below(_bins(rows, keys), keys, F.lit(0)).withColumn("__n", F.sum("__w").over(Window.partitionBy(*keys)))
    wanted = bins.filter(_wanted(probs)).withColumn("__start", F.lit(0).cast("long"))
    found, first, known = None, True, [*keys, "__n"]
    while True:
        wanted = materialize(wanted, "quantile-bins")
        done = wanted.filter("__lo = __hi").select(*known, "__below", "__w", F.col("__lo").alias("__x"))
        found = done if found is None else found.unionByName(done)
        most = wanted.filter("__lo < __hi").agg(F.max("__rows")).first()[0]
        if most is None:
            break
        hot = wanted.filter("__lo < __hi").select(*known, "__start", "__bin", "__below", "__rows", "__lo", "__hi")
        # The first bin follows from the value; later ones are those of the rows that went on.
        same = [*keys, "__bin"] if first else [*keys, "__start", "__bin"]
        inside = attach(rows.select(*same, "__x", "__w"), hot.drop("__start") if first else hot, same, "inner", null_safe=True)
        rows = _cut(inside.drop("__bin", "__start"), few_rows, cuts)
        below = _with_below(_bins(rows, [*known, "__start"]), [*known, "__start"], F.col("__start"))
        wanted = below.filter(_wanted(probs))
        if most <= few_rows:
            # Every part is one value now.
            found = found.unionByName(wanted.select(*known, "__below", "__w", F.col("__lo").alias("__x")))
            break
        rows, first = materialize(rows, "quantile-rows"), False
    return _interpolated(found, keys, probs, by)


def _interpolated(found: DataFrame, keys: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles from the values that hold the wanted ranks."""
    ranks = F.array(*[F.struct(F.lit(p).alias("prob"), ((F.col("__n") - 1) * F.lit(p)).alias("rank")) for p in probs])
    each = found.withColumn("__r", F.explode(ranks))

    def at(place: Column) -> Column:
        return F.max(F.when((place >= F.col("__below")) & (place < F.col("__below") + F.col("__w")), F.col("__x")))

    rank = F.col("__r.rank")
    both = each.groupBy(*keys, F.col("__r.prob").alias("prob"), rank.alias("__rank")).agg(
        at(F.floor(rank)).alias("__left"), at(F.ceil(rank)).alias("__right"))
    part = F.col("__rank") - F.floor("__rank")
    return both.select(*by, "prob", F.when(part == 0, F.col("__left")).otherwise(
        F.col("__left") + part * (F.col("__right") - F.col("__left"))).alias("quantile"))


def quantile_columns(df: DataFrame, value: str, named: dict[str, float], by: Sequence[str] = (),
                     weight: str | None = None, **kw) -> DataFrame:
    """Same, one column per named probability."""
    long = exact_quantiles(df, value, sorted(set(named.values())), by, weight, **kw)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for name, p in named.items()]
    )


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str], weight: str | None = None,
            prefix: str = "median_") -> DataFrame:
    """Median of several columns per group, all columns in the same passes."""
    keep = [*by, *([weight] if weight else [])]
    long = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(keep, list(cols), "__what", "__x")
    q = exact_quantiles(long, "__x", [0.5], [*by, "__what"], weight)
    return q.groupBy(*by).agg(
        *[F.max(F.when(F.col("__what") == c, F.col("quantile"))).alias(f"{prefix}{c}") for c in cols]
    )
