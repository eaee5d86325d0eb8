"""Classes of an indicator: natural breaks or quantiles, per group, in one plan.

Class 1 holds the highest values. Finding natural breaks needs sums per bin
only, so each round is one scan with partial aggregation: values are counted
in bins per group, bins that provably hold no break are closed, and only the
rows in the remaining bins go to the next, finer round. The loop ends when no
bin is in doubt, so the breaks are those of the unbinned data. Rounds shrink
the rows in doubt by about the number of bins.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.functions.nulls import finite_or_null
from arearisk.operators import breaks
from arearisk.operators.breaks import solve
from arearisk.operators.joins import attach
from arearisk.operators.quantiles import exact_quantiles
from arearisk.scratch import materialize

# The helper travels with the task, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(breaks)

BINS = 4096
EXACT_ROWS = 50_000  # groups (or remainders) up to this many rows use their values as bins
TINY = 5e-324  # smallest positive double, keeps divisors off zero

# Bins of one group after a round: their sums, class, and how to cut the ones still open.
SOLVED = T.StructType([T.StructField(c, t) for c, t in (
    ("gid", T.LongType()), ("bin", T.LongType()), ("centre", T.DoubleType()), ("n", T.DoubleType()), ("s", T.DoubleType()),
    ("q", T.DoubleType()), ("lo", T.DoubleType()), ("hi", T.DoubleType()), ("cls", T.IntegerType()),
    ("open", T.BooleanType()), ("width", T.DoubleType()), ("parts", T.IntegerType()), ("base", T.LongType()),
    ("exact", T.BooleanType()))])


def natural_breaks(df: DataFrame, value: str, k: int = 5, by: Sequence[str] = (),
                   bins: int = BINS, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Least-squares class limits per group.

    One row per group: `n_classes`, and `lowers` / `uppers`, the smallest and
    largest value of each class in ascending order. Groups with at most `k`
    distinct values get one class per value.
    """
    by = list(by)
    rows = df.select(*by, finite_or_null(value).alias("x")).filter(F.col("x").isNotNull())
    keys = by or ["__all"]
    if not by:
        rows = rows.withColumn("__all", F.lit(0))
    ranges = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("centre"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.stddev_pop("x").alias("sd"),
    )
    if (ranges.agg(F.max("n")).first()[0] or 0) <= exact_rows:
        return _breaks_of_values(rows, keys, k).select(*by, "n_classes", "lowers", "uppers")
    # First bins are even on a scale that is linear near the mean and logarithmic far from it,
    # so long tails do not push everything into a few bins. log1p keeps the order of its inputs.
    unit = F.greatest(F.col("sd") / 16, (F.col("hi") - F.col("lo")) / F.lit(1e9), F.lit(TINY))

    def scaled(c: Column) -> Column:
        u = (c - F.col("centre")) / F.col("unit")
        return F.signum(u) * F.log1p(F.abs(u))

    start = ranges.withColumn("unit", unit).select(
        *keys, F.monotonically_increasing_id().alias("gid"), "centre", "unit", scaled(F.col("lo")).alias("from"),
        F.greatest((scaled(F.col("hi")) - scaled(F.col("lo"))) / F.lit(float(bins)), F.lit(TINY)).alias("width"),
        (F.col("n") <= exact_rows).alias("exact"),
    )
    start = materialize(start, "break-range")  # stored, so the group numbers are fixed
    first = F.least(F.greatest(F.floor((scaled(F.col("x")) - F.col("from")) / F.col("width")), F.lit(0)), F.lit(bins - 1))
    located = attach(rows, start, keys, "inner", null_safe=True).select(
        "gid", "x", "centre",
        F.when(F.col("exact"), 0).otherwise(first).cast("long").alias("bin"),
        F.when(F.col("exact"), F.col("x")).alias("exact_value"),
    )
    atom_cols = ["gid", "bin", "centre", "n", "s", "q", "lo", "hi", "closed"]

    def solve_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo", kind="stable").reset_index(drop=True)
        cls, open_ = solve(*(pdf[c].to_numpy(float) for c in ("n", "s", "q", "lo", "hi")), k, pdf["closed"].to_numpy(bool))
        count = int(open_.sum())
        parts = max(2, bins // count) if count else 2
        pdf["cls"], pdf["open"] = cls, open_
        pdf["width"] = np.maximum((pdf["hi"] - pdf["lo"]) / parts, TINY)
        pdf["parts"] = parts
        round_no = int(pdf["bin"].max() >> 40) + 1
        pdf["base"] = (np.int64(round_no) << 40) + np.where(open_, np.cumsum(open_) - 1, 0).astype(np.int64) * parts
        pdf["exact"] = bool(pdf.loc[open_, "n"].sum() <= exact_rows)
        return pdf[SOLVED.names]

    closed = None
    while True:
        off = F.col("x") - F.col("centre")
        atoms = located.groupBy("gid", "bin", "exact_value").agg(
            F.first("centre").alias("centre"),
            F.count(F.lit(1)).cast("double").alias("n"), F.sum(off).alias("s"), F.sum(off * off).alias("q"),
            F.min("x").alias("lo"), F.max("x").alias("hi"),
        ).withColumn("closed", F.lit(False)).select(*atom_cols)
        state = atoms if closed is None else atoms.unionByName(closed)
        solved = materialize(state.groupBy("gid").applyInPandas(solve_group, SOLVED), "break-bins")
        open_bins = solved.filter("open")
        if open_bins.isEmpty():
            break
        closed = solved.filter("not open").withColumn("closed", F.lit(True)).select(*atom_cols)
        level = materialize(
            open_bins.select("gid", "bin", F.col("lo").alias("from"), "width", "parts", "base", "exact"), "break-level")
        in_doubt = materialize(
            attach(located.select("gid", "bin", "x", "centre"), level.select("gid", "bin"), ["gid", "bin"], "left_semi"), "break-rows")
        sub = F.least(F.floor((F.col("x") - F.col("from")) / F.col("width")), F.col("parts") - 1)
        located = attach(in_doubt, level, ["gid", "bin"], "inner").select(
            "gid", "x", "centre",
            F.when(F.col("exact"), F.col("base")).otherwise(F.col("base") + sub).cast("long").alias("bin"),
            F.when(F.col("exact"), F.col("x")).alias("exact_value"),
        )

    per_class = solved.groupBy("gid", "cls").agg(F.min("lo").alias("lower"), F.max("hi").alias("upper"))
    ordered = F.array_sort(F.collect_list(F.struct("cls", "lower", "upper")))  # at most k entries
    limits = per_class.groupBy("gid").agg(ordered.alias("c"))
    return attach(limits, start.select("gid", *by), "gid", "inner").select(
        *by, F.size("c").alias("n_classes"), F.col("c.lower").alias("lowers"), F.col("c.upper").alias("uppers")
    )


def _breaks_of_values(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Limits of groups small enough to be solved by their values, in one plan without stored tables."""
    def limits(t: pa.Table) -> pa.Table:
        t = t.sort_by("x")
        x, n = t["x"].to_numpy(), t["n"].to_numpy().astype(float)
        off = x - (x * n).sum() / n.sum()
        cls, _ = solve(n, n * off, n * off * off, x, x, k, np.zeros(len(x), bool))
        first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
        ends = np.append(first[1:], len(x)) - 1
        out = t.select(list(keys)).slice(0, 1)
        for name, column in (("n_classes", pa.array([len(first)], pa.int32())), ("lowers", pa.array([x[first].tolist()], pa.list_(pa.float64()))),
                             ("uppers", pa.array([x[ends].tolist()], pa.list_(pa.float64())))):
            out = out.append_column(name, column)
        return out

    schema = T.StructType([rows.schema[c] for c in keys] + [
        T.StructField("n_classes", T.IntegerType()), T.StructField("lowers", T.ArrayType(T.DoubleType())),
        T.StructField("uppers", T.ArrayType(T.DoubleType()))])
    return rows.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).applyInArrow(limits, schema)


def quantile_breaks(df: DataFrame, value: str, k: int = 5, by: Sequence[str] = (), **kw) -> DataFrame:
    """Class limits at the k-quantiles; equal limits merge."""
    by = list(by)
    q = exact_quantiles(df, value, [i / k for i in range(k + 1)], by, **kw)
    cuts = F.array_sort(F.collect_set("quantile"))  # at most k + 1 entries
    return q.groupBy(*by).agg(cuts.alias("c")).select(
        *by,
        F.greatest(F.size("c") - 1, F.lit(1)).alias("n_classes"),
        F.slice("c", F.lit(1), F.greatest(F.size("c") - 1, F.lit(1))).alias("lowers"),
        F.when(F.size("c") > 1, F.slice("c", F.lit(2), F.size("c") - 1)).otherwise(F.col("c")).alias("uppers"),
    )


def class_of(value: Column, n_classes: Column, uppers: Column, k: int, ascending: bool = False) -> Column:
    """Class number of a value; 1 is the highest class, or the lowest with `ascending`."""
    above = None
    for i in range(k - 1):
        one = F.when((F.lit(i) < n_classes - 1) & (value > F.get(uppers, F.lit(i))), 1).otherwise(0)
        above = one if above is None else above + one
    above = F.lit(0) if above is None else above
    cls = above + 1 if ascending else n_classes - above
    return F.when(value.isNotNull() & n_classes.isNotNull(), cls.cast("int"))


def class_labels(lowers: Column, uppers: Column, pattern: str = "%.6g") -> Column:
    """Interval texts of all classes: the lowest is closed on both sides, others are (low, high]."""
    def text(u: Column, i: Column) -> Column:
        low = F.when(i == 0, F.get(lowers, F.lit(0))).otherwise(F.get(uppers, i - 1))
        return F.concat(F.when(i == 0, "[").otherwise("("), F.format_string(f"{pattern}, {pattern}]", low, u))

    return F.transform(uppers, text)


def classify(df: DataFrame, value: str, out: str | None = None, k: int = 5, by: Sequence[str] = (),
             method: str = "natural", ascending: bool = False, label: bool = True,
             label_pattern: str = "%.6g", **kw) -> DataFrame:
    """Add `<out>_q`, the class of `value` within its group, and `<out>_q_name`, its interval."""
    out, by = out or value, list(by)
    find = {"natural": natural_breaks, "quantile": quantile_breaks}[method]
    limits = find(df, value, k, by, **kw).withColumn(
        "__labels", class_labels(F.col("lowers"), F.col("uppers"), label_pattern)
    ).drop("lowers").withColumnsRenamed({"n_classes": "__classes", "uppers": "__uppers"})
    if by:
        # Natural breaks end on a stored table of bins, so their size is known already.
        limits = limits if method == "natural" else materialize(limits, "class-limits")
        wide = attach(df, limits, by, null_safe=True)
    else:
        # Without groups the limits are one row of at most k classes; they become literals.
        one = limits.first()
        n, uppers, labels = (one["__classes"], one["__uppers"], one["__labels"]) if one else (None, None, None)
        wide = df.withColumns({
            "__classes": F.lit(n).cast("int"),
            "__uppers": F.array(*map(F.lit, uppers)) if uppers else F.lit(None).cast("array<double>"),
            "__labels": F.array(*map(F.lit, labels)) if labels else F.lit(None).cast("array<string>")})
    cls = class_of(finite_or_null(value), F.col("__classes"), F.col("__uppers"), k, ascending)
    wide = wide.withColumn(f"{out}_q", cls)
    if label:
        from_bottom = F.col(f"{out}_q") - 1 if ascending else F.col("__classes") - F.col(f"{out}_q")
        wide = wide.withColumn(f"{out}_q_name", F.get("__labels", from_bottom))
    return wide.drop("__classes", "__uppers", "__labels")


def class_intervals(df: DataFrame, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Sorted list of the classes that occur with their interval texts, per group; for tables from `classify`."""
    cols = [*by, f"{out}_q", f"{out}_q_name"]
    return df.filter(F.col(f"{out}_q").isNotNull()).select(*cols).distinct().orderBy(*cols)


def pivot_limits(limits: DataFrame, indicator: str, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group with `<name>__n` and `<name>__u` for every indicator, ready to be joined once."""
    aggs = []
    for name in names:
        hit = F.col(indicator) == name
        aggs.append(F.max(F.when(hit, F.col("n_classes"))).alias(f"{name}__n"))
        aggs.append(F.max(F.when(hit, F.col("uppers"))).alias(f"{name}__u"))
    return limits.groupBy(*by).agg(*aggs)
