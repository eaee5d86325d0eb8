from pyspark.sql import functions as F

from arearisk.operators import joins as J
from tests.conftest import rows


def test_left_join_keeps_left_key_and_unmatched_rows(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("x", 9), (None, 8)], "code string, w int")
    assert rows(J.attach(a, b, {"k": "code"})) == [("x", 1, 9), ("y", 2, None), (None, 3, None)]
    assert rows(J.attach(a, b, {"k": "code"}, null_safe=True)) == [("x", 1, 9), ("y", 2, None), (None, 3, 8)]


def test_attach_to_a_table_made_from_itself(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, v int")
    total = a.groupBy("k").agg(F.sum("v").alias("t"))
    assert rows(J.attach(a, total, "k")) == [("x", 1, 3), ("x", 2, 3), ("y", 3, 3)]


def test_successors_by_name_and_exception(spark):
    old = spark.createDataFrame([("a1", "Alpha"), ("a2", "Beta"), ("a3", "Gamma")], "old string, nm string")
    new = spark.createDataFrame([("b1", "Alpha"), ("b9", "Merged")], "new string, nm2 string")
    gone = J.without_successor(old, new, "nm", "nm2")
    assert rows(gone, "old") == [("a2",), ("a3",)]
    exceptions = gone.select("old", F.lit("b9").alias("new"))
    assert rows(J.successors(old, new, exceptions, "old", "nm", "new", "nm2")) == [("a1", "b1"), ("a2", "b9"), ("a3", "b9")]


def test_audit_counts_lost_and_doubled_rows(spark):
    data = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "code string")
    look = spark.createDataFrame([("a",), ("a",), ("b",)], "code string")
    assert tuple(J.audit(data, look, "code").first()) == (1, 1, 1, 2)


def test_latest_is_emptied_by_one_missing_period(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "p int, v string")
    assert rows(J.latest(df, "p"), "v") == [("b",), ("c",)]
    gap = df.unionByName(spark.createDataFrame([(None, "d")], "p int, v string"))
    assert J.latest(gap, "p").count() == 0
    assert J.latest(gap, "p", strict=False).count() == 2


def test_compose_and_star(spark):
    lower = spark.createDataFrame([("l1", "d1"), ("l2", "d2")], "l string, d string")
    upper = spark.createDataFrame([("d1", "f1"), ("d1", "f1")], "d string, f string")
    assert rows(J.compose(lower, upper, "l", "d", "f")) == [("l1", "f1"), ("l2", None)]
    s = J.star(lower, (upper.distinct(), "d"), (lower.select("l", F.lit(1).alias("one")), "l"))
    assert rows(s, "l", "f", "one") == [("l1", "f1", 1), ("l2", None, 1)]


def test_union_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert rows(J.union_filled(a, b)) == [(1, None), (None, 2)]


def test_grid_has_every_step_per_key(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    g = J.grid(keys, "x")
    assert g.count() == 202
    assert [r[0] for r in g.agg(F.min("x"), F.max("x")).select(F.array("min(x)", "max(x)")).collect()] == [[0.0, 1.0]]
