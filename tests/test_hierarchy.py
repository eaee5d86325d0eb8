import pytest
from pyspark.sql import functions as F

from arearisk.operators import hierarchy as H
from tests.conftest import rows


@pytest.fixture(scope="module")
def ladder(spark):
    """Two authorities, three neighbourhoods with 1, 4 and 2 small areas."""
    return spark.createDataFrame(
        [("s1", "m1", "d1"), *[(f"s{i}", "m2", "d1") for i in range(2, 6)], ("s6", "m3", "d2"), ("s7", "m3", "d2")],
        "lsoa string, msoa string, lad string")


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([("m1", 1, 10.0, 1, 2, 10), ("m2", 3, 20.0, 2, 2, 20), ("m3", None, 5.0, 1, 1, 0)],
                                 "msoa string, q int, x double, a int, b int, n int")


MEASURES = [H.Measure("x", "x", "q", "max"), H.Measure("alone", None, None, "ratio", ("a", "b"), "n")]


def test_weighted_rollup_equals_the_fanned_out_join(spark, ladder, areas):
    got = rows(H.roll_up_worst(areas, ladder, "msoa", "lad", MEASURES, "children"))
    fan = areas.join(ladder.select("msoa", "lad"), "msoa")
    want = fan.groupBy("lad").agg(F.max("x"), F.try_divide(F.sum("a") + F.sum("b"), F.sum("n")), F.median("x"))
    want = {r[0]: tuple(r)[1:] for r in want.collect()}
    assert [(r[0], r[2], r[3], r[4]) for r in got] == [(k, *want[k]) for k in sorted(want)]
    assert got[0][4] == 20.0  # four of the five copies are 20


def test_unweighted_rollup_counts_each_child_once(ladder, areas):
    got = rows(H.roll_up_worst(areas, ladder, "msoa", "lad", MEASURES, "none"))
    assert got[0] == ("d1", 1, 20.0, 7 / 30, 15.0)


def test_worst_class_is_missing_if_a_child_has_none(ladder, areas):
    got = rows(H.roll_up_worst(areas, ladder, "msoa", "lad", MEASURES), "lad", "worst_x_q", "worst_alone")
    assert got == [("d1", 1, pytest.approx((1 + 2 + 4 * 4) / 90)), ("d2", None, None)]


def test_rates_divide_by_areas_with_events_or_by_all(spark, ladder):
    events = spark.createDataFrame([("s1",), ("s1",), ("s2",)], "lsoa string")
    people = spark.createDataFrame([(f"s{i}", 10) for i in range(1, 7)], "lsoa string, n_people int")
    few = H.event_rate(events, people, "lsoa", "n", "n_people", "rate")
    assert rows(few) == [("s1", 2, 10, 0.2), ("s2", 1, 10, 0.1)]
    up = H.roll_up_rate(few, ladder, "lsoa", "msoa", "n", "n_people", "rate")
    assert rows(up) == [("m1", 2, 10, 0.2), ("m2", 1, 10, 0.1)]
    every = H.event_rate(events, people, "lsoa", "n", "n_people", "rate", "all_areas")
    up = H.roll_up_rate(every, ladder, "lsoa", "msoa", "n", "n_people", "rate")
    assert rows(up) == [("m1", 2, 10, 0.2), ("m2", 1, 40, 0.025), ("m3", 0, 10, 0.0)]
    with pytest.raises(ValueError):
        H.event_rate(events, people, "lsoa", "n", "n_people", "rate", "other")


def test_rollup_sum_is_missing_if_a_population_is(spark, ladder):
    small = spark.createDataFrame([("s2", 1, None), ("s3", 2, 5), ("s6", 1, 0)], "lsoa string, n int, p int")
    assert rows(H.roll_up_rate(small, ladder, "lsoa", "msoa", "n", "p", "r")) == [("m2", 3, None, None), ("m3", 1, 0, None)]
