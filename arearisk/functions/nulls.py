"""Missing-value rules.

Two families of aggregates exist: strict ones, where a single missing member
makes the whole group missing, and skipping ones, which Spark gives anyway.
Division never raises and never yields infinities; missing stays NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict(agg: Callable[[Column], Column], c: Column | str) -> Column:
    """`agg(c)`, or NULL as soon as one member of the group is NULL."""
    c = _col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), agg(c))


def strict_sum(c: Column | str) -> Column:
    return strict(F.sum, c)


def strict_min(c: Column | str) -> Column:
    return strict(F.min, c)


def strict_max(c: Column | str) -> Column:
    return strict(F.max, c)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den; NULL where the denominator is zero or either side is missing."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def ratio_of_sums(nums: list[Column | str], den: Column | str, weight: Column | None = None) -> Column:
    """Sum of several columns over the sum of one, each sum skipping missing values."""
    w = (lambda c: _col(c) * weight) if weight is not None else _col
    total = None
    for c in nums:
        part = F.coalesce(F.sum(w(c)).cast("double"), F.lit(0.0))
        total = part if total is None else total + part
    return F.try_divide(total, F.sum(w(den)).cast("double"))


def sd_or_zero(c: Column | str) -> Column:
    """Sample standard deviation; a group of one has spread 0."""
    return F.coalesce(F.stddev_samp(_col(c)), F.lit(0.0))


def row_mean(*cols: Column | str) -> Column:
    """Mean across columns of one row, missing if any is missing."""
    total = _col(cols[0]).cast("double")
    for c in cols[1:]:
        total = total + _col(c).cast("double")
    return total / F.lit(float(len(cols)))


def not_in(c: Column | str, values: list) -> Column:
    """Negated membership in which a missing value counts as 'not a member'."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def is_member(c: Column | str, values: list) -> Column:
    """Membership that is never missing."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def finite_or_null(c: Column | str) -> Column:
    """NaN and infinities become NULL."""
    c = _col(c).cast("double")
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(~bad, c)
