"""Combining classes: labels, counts of highest risks, total scores, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.functions.scalars import columns_ending, recode

NO_CLASS = 99


def fill_classes(df: DataFrame, cols: Sequence[str], sentinel: int | Column = NO_CLASS) -> DataFrame:
    """Missing classes become the sentinel (one number, or a column such as one per country)."""
    value = sentinel if isinstance(sentinel, Column) else F.lit(sentinel)
    return df.withColumns({c: F.coalesce(F.col(c), value.cast("int")) for c in cols})


def clear_sentinel(df: DataFrame, sentinel: int = NO_CLASS, to: int = 0) -> DataFrame:
    """Turn the sentinel into 0 in every class column."""
    return recode(df, columns_ending(df, "_q"), sentinel, to)


def combined_label(pairs: Sequence[tuple[str, str]]) -> Column:
    """Comma-separated labels of the (class column, label) pairs whose class is 1; NULL if none."""
    flags = [F.when(F.col(q) == 1, F.lit(text)) for q, text in pairs]
    return F.nullif(F.concat_ws(", ", *flags), F.lit(""))


def count_highest(cols: Sequence[str]) -> Column:
    """Number of class columns equal to 1."""
    return reduce(lambda a, b: a + b, [F.when(F.col(c) == 1, 1).otherwise(0) for c in cols])


def total_score(cols: Sequence[str], skip_zero: bool = False) -> Column:
    """Product of the classes, ignoring missing ones (and zeros with `skip_zero`); NULL if all are missing."""
    def factor(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(x != 0, x) if skip_zero else x

    product = reduce(lambda a, b: a * b, [F.coalesce(factor(c), F.lit(1.0)) for c in cols])
    return F.when(F.coalesce(*[factor(c) for c in cols]).isNotNull(), product)


def report(df: DataFrame, columns: Sequence[tuple[str, str]], class_cols: Sequence[str],
           skip_zero: bool = False) -> DataFrame:
    """Readable table: renamed columns, `Total score`, `No. 1s`; most highest risks first."""
    scored = df.withColumns({"Total score": total_score(class_cols, skip_zero), "No. 1s": count_highest(class_cols)})
    chosen = [F.col(f"`{c}`").alias(title) for c, title in columns]
    return scored.select(*chosen, "`Total score`", "`No. 1s`").orderBy(
        F.desc_nulls_last("`No. 1s`"), F.asc_nulls_last("`Total score`")
    )
