from pyspark.sql import functions as F

from arearisk.operators import combine as K
from tests.conftest import rows

PAIRS = [("a_q", "Fires"), ("b_q", "Flooding"), ("c_q", "Loneliness")]


def table(spark, data):
    return spark.createDataFrame(data, "id string, a_q int, b_q int, c_q int")


def test_label_lists_class_one_in_order_and_is_missing_without_any(spark):
    t = table(spark, [("none", 2, 99, None), ("first", 1, 2, 3), ("last", 0, 5, 1), ("all", 1, 1, 1)])
    got = dict(rows(t.select("id", K.combined_label(PAIRS))))
    assert got == {"none": None, "first": "Fires", "last": "Loneliness", "all": "Fires, Flooding, Loneliness"}


def test_sentinels_go_in_and_out(spark):
    t = table(spark, [("x", None, 2, 99)])
    filled = K.fill_classes(t, ["a_q", "b_q"])
    assert rows(filled) == [("x", 99, 2, 99)]
    assert rows(K.clear_sentinel(filled)) == [("x", 0, 2, 0)]
    zero = K.fill_classes(t, ["a_q"], F.when(F.col("id") == "x", 0).otherwise(99))
    assert rows(zero, "a_q") == [(0,)]


def test_score_ignores_missing_and_optionally_zero(spark):
    t = table(spark, [("x", 2, 3, None), ("y", 0, 3, 2), ("z", None, None, None)])
    cols = ["a_q", "b_q", "c_q"]
    got = rows(t.select("id", K.total_score(cols), K.total_score(cols, skip_zero=True), K.count_highest(cols)))
    assert got == [("x", 6.0, 6.0, 0), ("y", 0.0, 6.0, 0), ("z", None, None, 0)]


def test_report_puts_most_ones_first_and_missing_last(spark):
    t = table(spark, [("two", 1, 1, 2), ("none", None, None, None), ("low", 2, 1, 2), ("high", 5, 1, 2)])
    r = K.report(t, [("id", "Area name")], ["a_q", "b_q", "c_q"])
    assert r.columns == ["Area name", "Total score", "No. 1s"]
    assert [x[0] for x in r.collect()] == ["two", "low", "high", "none"]
