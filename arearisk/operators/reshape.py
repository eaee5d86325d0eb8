"""Cross-tabs, pivots, long tables, fill-down and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arearisk.functions.nulls import ratio, strict_sum
from arearisk.operators.joins import attach


def crosstab(df: DataFrame, key: str | Sequence[str], category: str, values: Sequence[str],
             missing: str | None = "missing") -> DataFrame:
    """Counts of each category per key; combinations that never occur are 0.

    `missing` names a column for rows without a category; None leaves them out.
    Conditional counts rather than a pivot: one pass, partial sums before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [F.count(F.when(F.col(category) == v, 1)).alias(v) for v in values]
    if missing:
        aggs.append(F.count(F.when(F.col(category).isNull(), 1)).alias(missing))
    return df.groupBy(*keys).agg(*aggs)


def share(df: DataFrame, part: str, others: Sequence[str], out: str) -> DataFrame:
    """part / (part + others)."""
    total = F.col(part)
    for c in others:
        total = total + F.col(c)
    return df.withColumn(out, ratio(part, total))


def pivot_sum(df: DataFrame, keys: Sequence[str], names: str, value: str, values: Sequence[str],
              fill: float | int = 0) -> DataFrame:
    """One summed column per name; absent combinations are filled, missing members are not."""
    wide = []
    for v in values:
        hit = F.col(names) == v
        present = F.count(F.when(hit, 1))
        complete = F.count(F.when(hit, F.col(value))) == present
        wide.append(
            F.when(present == 0, F.lit(fill)).when(complete, F.sum(F.when(hit, F.col(value)))).alias(v)
        )
    return df.groupBy(*keys).agg(*wide)


def pivot_prefixed(df: DataFrame, keys: Sequence[str], names: str, value: str, values: Sequence, prefix: str) -> DataFrame:
    """One column `prefix + name` per name, for values that occur once per key."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(names) == v, F.col(value))).alias(f"{prefix}{v}") for v in values]
    )


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long; missing values are kept."""
    return df.unpivot(list(ids), list(cols), name, value)


def sum_all(df: DataFrame, key: str) -> DataFrame:
    """Strict sum of every other column per key."""
    return df.groupBy(key).agg(*[strict_sum(F.col(f"`{c}`")).alias(c) for c in df.columns if c != key])


def fill_down(df: DataFrame, by: Sequence[str], order: str, value: str, out: str,
              block_rows: int = 1_000_000) -> DataFrame:
    """Last non-missing value in row order.

    Each group is cut into blocks of the order column, so that no task has to
    sort a whole group: rows fill inside their block, and what a block starts
    with is carried over from the last filled block before it.
    """
    by = list(by)
    cut = df.withColumn("__block", F.floor(F.col(order) / F.lit(block_rows)).cast("long"))
    ends = cut.groupBy(*by, "__block").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("__end")
    )
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__carry", F.last("__end", ignorenulls=True).over(earlier)).drop("__end")
    inside = Window.partitionBy(*by, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = attach(cut, carried, [*by, "__block"], null_safe=True)
    filled = joined.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("__carry")))
    return filled.drop("__block", "__carry")


def top_n(df: DataFrame, by: Sequence[str], value: str, n: int = 1) -> DataFrame:
    """The n largest per group with ties.

    The rank filter is pushed below the shuffle by the planner, so a hot group
    is cut down to its top rows in every input task first.
    """
    w = Window.partitionBy(*by).orderBy(F.desc_nulls_last(value))
    ranked = df.filter(F.col(value).isNotNull()).withColumn("__rank", F.rank().over(w))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")
