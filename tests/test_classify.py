import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arearisk.operators.breaks import solve
from arearisk.operators.classify import classify, natural_breaks, quantile_breaks
from tests.conftest import rows


def cost(values, cuts):
    parts = np.split(np.sort(values), cuts)
    return sum(((p - p.mean()) ** 2).sum() for p in parts if len(p))


def bins_of(x, key):
    order = np.lexsort((x, key))
    x, key = x[order], key[order]
    _, start, count = np.unique(key, return_index=True, return_counts=True)
    n, s, q = count.astype(float), np.add.reduceat(x, start), np.add.reduceat(x * x, start)
    lo, hi = x[start], x[start + count - 1]
    o = np.argsort(lo)
    return n[o], s[o], q[o], lo[o], hi[o]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=14), st.integers(1, 5))
def test_solution_is_the_cheapest_of_all_partitions(ints, k):
    x = np.array(ints, float)
    v = np.unique(x)
    n, s, q, lo, hi = bins_of(x, x)
    cls, still = solve(n, s, q, lo, hi, k)
    assert not still.any()
    assert (np.diff(cls) >= 0).all() and cls.max() + 1 == min(k, len(v))
    got = sum(((x[np.isin(x, v[cls == c])] - x[np.isin(x, v[cls == c])].mean()) ** 2).sum() for c in range(cls.max() + 1))
    edges = [int((x < t).sum()) for t in v[1:]]
    best = min(cost(x, list(c)) for c in itertools.combinations(edges, min(k, len(v)) - 1))
    assert got == pytest.approx(best, abs=1e-6)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 8), st.sampled_from(["normal", "skewed", "heavy", "ties"]))
def test_a_bin_that_holds_a_break_is_never_closed(seed, k, shape):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(50, 800))
    x = {"normal": rng.normal(size=n), "skewed": rng.gamma(0.3, 1, n), "heavy": rng.standard_cauchy(n),
         "ties": np.round(rng.normal(size=n), 1)}[shape]
    x = np.sort(x - x.mean())
    exact, _ = solve(*bins_of(x, x), k)
    uppers = [np.unique(x)[exact == c].max() for c in range(exact.max() + 1)][:-1]
    key = np.floor((x - x[0]) / ((x[-1] - x[0]) / 32))
    n_, s, q, lo, hi = bins_of(x, key)
    _, still = solve(n_, s, q, lo, hi, k)
    for u in uppers:
        b = int(np.searchsorted(hi, u))
        assert hi[b] == u or still[b]


def test_few_distinct_values_get_a_class_each(spark):
    df = spark.createDataFrame(
        [("one", 4.0), ("one", 4.0), ("three", 0.0), ("three", 0.0), ("three", 5.0), ("three", 9.0), ("none", None)]
        + [("five", float(i)) for i in range(5)], "g string, x double")
    got = rows(classify(df, "x", "r", 5, ["g"]).distinct(), "g", "x", "r_q")
    assert got == [("five", 0.0, 5), ("five", 1.0, 4), ("five", 2.0, 3), ("five", 3.0, 2), ("five", 4.0, 1), ("none", None, None),
                   ("one", 4.0, 1), ("three", 0.0, 3), ("three", 5.0, 2), ("three", 9.0, 1)]


def test_direction_labels_and_bad_values(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 10.0, 11.0, 20.0, float("nan"), float("inf"), None)], "x double")
    got = {r["x"]: (r["x_q"], r["x_q_name"]) for r in classify(df, "x", k=3, label_pattern="%.1f").collect() if r["x"] is not None and r["x"] == r["x"]}
    assert got[0.0] == (3, "[0.0, 1.0]") and got[10.0] == (2, "(1.0, 11.0]") and got[20.0] == (1, "(11.0, 20.0]")
    assert got[float("inf")] == (None, None)
    low_first = {r["x"]: r["x_q"] for r in classify(df, "x", k=3, ascending=True).collect()}
    assert low_first[0.0] == 1 and low_first[20.0] == 3


def test_no_values_at_all(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(classify(df, "x").first()) == (None, None, None)


@pytest.mark.parametrize("k", [3, 6])
def test_refining_rounds_end_at_the_unbinned_breaks(spark, k):
    random.seed(5)
    data = [(g, random.gauss(0, 1) if g == "a" else random.expovariate(1) ** 3) for g in "ab" for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, x double")
    whole = rows(natural_breaks(df, "x", k, ["g"]))
    rounds = rows(natural_breaks(df, "x", k, ["g"], bins=64, exact_rows=50))
    assert whole == rounds


def test_quantile_classes_merge_equal_limits(spark):
    df = spark.createDataFrame([(0.0,)] * 8 + [(1.0,), (2.0,)], "x double")
    r = quantile_breaks(df, "x", 5).first()
    assert r["n_classes"] == 2 and r["uppers"] == [pytest.approx(0.2), 2.0]


def test_unknown_group_has_no_class(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "g string, x double")
    got = rows(classify(df, "x", k=2, by=["g"]), "g", "x", "x_q")
    assert got == [("a", 1.0, 2), ("a", 2.0, 1), (None, 3.0, 1)]
