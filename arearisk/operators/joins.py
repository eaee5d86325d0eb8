"""Lookups, stars, successor codes and integrity audits.

No join here carries a broadcast hint. Lookup tables come from files, so
Catalyst knows their size and broadcasts the ones below its threshold; above
it the join is a shuffle join, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.functions.nulls import strict_max


def attach(left: DataFrame, right: DataFrame, on: str | Sequence[str] | dict[str, str],
           how: str = "left", null_safe: bool = False) -> DataFrame:
    """Left join that keeps the left key names.

    `on` may map left names to right names. With `null_safe` a missing key on
    the left finds the missing key on the right.
    """
    if isinstance(on, str):
        on = [on]
    pairs = on if isinstance(on, dict) else {c: c for c in on}
    renamed = right
    hidden = {}
    for i, (lk, rk) in enumerate(pairs.items()):
        hidden[lk] = f"__key{i}"
        renamed = renamed.withColumnRenamed(rk, hidden[lk])
    cond: Column | None = None
    for lk, rk in hidden.items():
        one = left[lk].eqNullSafe(renamed[rk]) if null_safe else left[lk] == renamed[rk]
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*hidden.values())


def star(spine: DataFrame, *spokes: tuple[DataFrame, str | Sequence[str] | dict[str, str]]) -> DataFrame:
    """Left joins of many indicator tables onto one area spine."""
    return reduce(lambda acc, s: attach(acc, s[0], s[1]), spokes, spine)


def union_filled(*dfs: DataFrame) -> DataFrame:
    """Union by name; columns absent from a table are filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_pairs(lookup: DataFrame, child: str, parent: str) -> DataFrame:
    return lookup.select(child, parent).distinct()


def compose(lower: DataFrame, upper: DataFrame, child: str, mid: str, top: str) -> DataFrame:
    """child->mid and mid->top joined into a distinct child->top lookup."""
    return attach(lower.select(child, mid), upper.select(mid, top).distinct(), mid).select(child, top).distinct()


def latest(df: DataFrame, period: str, strict: bool = True) -> DataFrame:
    """Rows of the latest period, found by a one-value subquery.

    Strict as the period maximum itself: one missing period leaves no rows.
    """
    top = strict_max(period) if strict else F.max(period)
    return df.filter(F.col(period) == df.select(period).agg(top.alias("top")).scalar())


def successors(old: DataFrame, new: DataFrame, exceptions: DataFrame,
               old_code: str, old_name: str, new_code: str, new_name: str) -> DataFrame:
    """Map old codes to new ones: equal names first, a table of exceptions for the rest."""
    by_name = (
        old.select(old_code, F.col(old_name).alias("__name"))
        .join(new.select(new_code, F.col(new_name).alias("__name")), "__name")
        .select(old_code, new_code)
        .dropna("any")
    )
    return by_name.unionByName(exceptions.select(old_code, new_code))


def without_successor(old: DataFrame, new: DataFrame, old_name: str, new_name: str) -> DataFrame:
    """Old areas whose name is gone from the new list."""
    names = new.select(F.col(new_name).alias(old_name))
    return old.join(names, old_name, "left_anti")


def audit(data: DataFrame, lookup: DataFrame, code: str, lookup_code: str | None = None) -> DataFrame:
    """One row: how many rows and codes find no parent, and how many rows a join would add."""
    lookup_code = lookup_code or code
    per_code = data.groupBy(code).agg(F.count(F.lit(1)).alias("n_rows"))
    per_key = lookup.groupBy(F.col(lookup_code).alias(code)).agg(F.count(F.lit(1)).alias("n_keys"))
    return per_code.join(per_key, code, "left").agg(
        F.sum(F.when(F.col("n_keys").isNull(), F.col("n_rows")).otherwise(0)).alias("rows_unmatched"),
        F.sum(F.when(F.col("n_keys").isNull(), 1).otherwise(0)).alias("codes_unmatched"),
        F.sum(F.when(F.col("n_keys") > 1, 1).otherwise(0)).alias("codes_fanned_out"),
        F.sum(F.when(F.col("n_keys") > 1, F.col("n_rows") * (F.col("n_keys") - 1)).otherwise(0)).alias("rows_added"),
    )


def grid(keys: DataFrame, name: str, steps: int = 100, lower: float = 0.0, upper: float = 1.0) -> DataFrame:
    """Every key with an even sequence of values from `lower` to `upper`."""
    at = F.explode(F.sequence(F.lit(0), F.lit(steps)))
    return keys.distinct().withColumn("__i", at).select(
        *keys.columns, (F.lit(lower) + F.col("__i") * F.lit(upper - lower) / F.lit(float(steps))).alias(name)
    )
