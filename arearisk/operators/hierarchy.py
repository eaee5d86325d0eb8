"""Rolling small areas up to their parents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.functions.nulls import ratio, ratio_of_sums, strict_min, strict_sum
from arearisk.operators.joins import attach
from arearisk.operators.quantiles import medians


def edges(lookup: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct child-parent pairs with `n_children`, the rows of the lookup behind each pair."""
    return lookup.groupBy(child, parent).agg(F.count(F.lit(1)).alias("n_children"))


def roll_up_rate(df: DataFrame, lookup: DataFrame, child: str, parent: str,
                 num: str, den: str, rate: str) -> DataFrame:
    """Sum numerator and denominator per parent, then divide again; rates are never averaged."""
    pairs = lookup.select(child, parent).distinct()
    summed = attach(df, pairs, child).groupBy(parent).agg(strict_sum(num).alias(num), strict_sum(den).alias(den))
    return summed.withColumn(rate, ratio(num, den))


def event_rate(events: DataFrame, population: DataFrame, code: str, count: str, den: str, rate: str,
               denominator: str = "areas_with_events") -> DataFrame:
    """Events per area over its population.

    `areas_with_events` keeps only areas that had an event, so rates of their
    parents later divide by the population of those areas alone.
    `all_areas` starts from the population table and counts 0 elsewhere.
    """
    counted = events.groupBy(code).agg(F.count(F.lit(1)).alias(count))
    if denominator == "areas_with_events":
        joined = attach(counted, population.select(code, den), code)
    elif denominator == "all_areas":
        joined = attach(population.select(code, den), counted, code).withColumn(count, F.coalesce(F.col(count), F.lit(0)))
    else:
        raise ValueError(f"unknown denominator: {denominator}")
    return joined.select(code, count, den, ratio(count, den).alias(rate))


@dataclass(frozen=True)
class Measure:
    """How one indicator rolls up: its class column, its raw column and which end is bad.

    `extreme` is max, min or ratio; ratio divides the summed `parts` by the
    summed `whole`. Without a class column only raw values are rolled up.
    """

    name: str
    value: str | None = None
    class_col: str | None = None
    extreme: str = "max"
    parts: tuple[str, ...] = ()
    whole: str | None = None


def worst_of(df: DataFrame, parent: str | Sequence[str], measures: Sequence[Measure],
             weight: str | None = None, with_medians: bool = True) -> DataFrame:
    """Worst class, worst raw value and median raw value of the children of each parent.

    `worst_<name>_q` is missing if any child's class is. `weight` repeats a
    child in sums and medians as a fanned-out lookup would, without the rows.
    """
    by = [parent] if isinstance(parent, str) else list(parent)
    aggs: list[Column] = []
    for m in measures:
        if m.class_col:
            aggs.append(strict_min(m.class_col).alias(f"worst_{m.name}_q"))
    for m in measures:
        if m.extreme == "ratio":
            aggs.append(ratio_of_sums(list(m.parts), m.whole, F.col(weight) if weight else None).alias(f"worst_{m.name}"))
        elif m.value:
            aggs.append({"max": F.max, "min": F.min}[m.extreme](m.value).alias(f"worst_{m.name}"))
    worst = df.groupBy(*by).agg(*aggs)
    valued = [m for m in measures if m.value]
    if not (with_medians and valued):
        return worst
    named = df.select(*by, *([weight] if weight else []), *[F.col(m.value).alias(m.name) for m in valued])
    mid = medians(named, [m.name for m in valued], by, weight)
    return attach(worst, mid, by, null_safe=True)


def roll_up_worst(df: DataFrame, lookup: DataFrame, child: str, parent: str, measures: Sequence[Measure],
                  weight: str = "children", keep: Sequence[str] = ()) -> DataFrame:
    """`worst_of` over a lookup step.

    `children`: a child counts once per lookup row, as when the lookup is kept
    at a finer grain. `none`: a child counts once per parent. `keep` names
    further grouping columns of `df`, such as the country.
    """
    pairs = edges(lookup, child, parent)
    joined = attach(df, pairs, child).withColumn("n_children", F.coalesce(F.col("n_children"), F.lit(1)))
    return worst_of(joined, [*keep, parent], measures, "n_children" if weight == "children" else None)
