import datetime

from pyspark.sql import functions as F

from arearisk.functions import scalars as S


def col(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_country_of_codes(spark):
    got = col(spark, ["E1", "W1", "S1", "N1", "95", "K1", "", None], S.country_of("c"))
    assert got == ["England", "Wales", "Scotland", "Northern Ireland", "Northern Ireland", "", "", ""]


def test_prefix_filter_drops_missing_codes_both_ways(spark):
    df = spark.createDataFrame([("E1",), ("N1",), (None,)], "c string")
    assert df.filter(S.has_prefix("c", ["E"])).count() == 1
    assert df.filter(~S.has_prefix("c", ["E"])).count() == 1


def test_area_kinds(spark):
    got = col(spark, ["E10000003", "E11000001", "E12000009", "E92000001", "E06000001", None], S.area_kind("c"))
    assert got == ["county", "county", "region", "country", "local authority", "local authority"]


def test_code_repair(spark):
    df = spark.createDataFrame([("E01", "x E02"), ("E01", "church"), ("E01", None), (None, "E03")], "code string, d string")
    assert [r[0] for r in df.select(S.repair_code("d", "code")).collect()] == ["x E02", "E01", None, "E03"]


def test_ratings_and_loose_integers(spark):
    assert col(spark, ["#3", "3", "#x", "##3", None], S.rating("c")) == [3, 3, None, None, None]
    assert col(spark, ["3.7", "-", " 4", "1e20", None], S.to_integer("c")) == [3, None, 4, None, None]


def test_names_and_dates(spark):
    assert col(spark, ["A & B", None], S.harmonise_name("c", " CCG")) == ["A and B CCG", None]
    got = col(spark, ["31 Dec 2019", "1 Jan 2020", "Total", None], S.parse_period("c"))
    assert got == [datetime.date(2019, 12, 31), datetime.date(2020, 1, 1), None, None]


def test_deciles_scores_and_two_classes(spark):
    ints = [1, 2, 3, 9, 10, 0, 11, None]
    assert col(spark, ints, S.quintile_of_decile("c"), "int") == [1, 1, 2, 5, 5, None, None, None]
    assert col(spark, [10, 9, 1, None], S.reverse_half("c"), "int") == [1, 1, 5, None]
    assert col(spark, [0, 7, None], S.two_class("c"), "int") == [5, 1, None]


def test_settlements(spark):
    assert col(spark, ["A1", "F2", "X", None], S.settlement_of_code("c")) == ["Urban", "Rural", None, None]
    assert col(spark, [1, 2, None], S.settlement_of_fold("c"), "int") == ["Urban", "Rural", None]
    df = spark.createDataFrame([(1, 2, 1), (0, 0, 0)], "u int, m int, r int")
    assert [r[0] for r in df.select(S.mixed_share("u", "m", "r")).collect()] == [0.5, None]


def test_class_pair_labels_cover_six_combinations(spark):
    df = spark.createDataFrame([(d, s) for d in (1, 10) for s in (1, 2, 3)] + [(5, 1)], "d int, s int")
    label, order = S.class_pair_label("d", "s")
    got = dict((r[1], r[0]) for r in df.select(label, order).collect())
    assert got[1] == "Least deprived, mostly rural" and got[6] == "Most deprived, mostly urban" and got[None] is None
    assert sorted(k for k in got if k) == [1, 2, 3, 4, 5, 6]


def test_corner_labels(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "d int, u int")
    assert [r[0] for r in df.select(S.corner_label("d", "u")).collect()] == [
        "Rural, no deprivation", "Urban, no deprivation", "Rural, full deprivation", "Urban, full deprivation"]


def test_column_selectors_ignore_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "LSOA11CD int, lsoa11nm int, fires_Q int")
    assert S.columns_starting(df, "lsoa") == ["LSOA11CD", "lsoa11nm"]
    assert S.columns_ending(df, "_q") == ["fires_Q"]
    assert S.columns_first(df, "fires_Q").columns == ["fires_Q", "LSOA11CD", "lsoa11nm"]


def test_map_numeric_leaves_text_alone(spark):
    df = spark.createDataFrame([("a", 1.0, 2)], "term string, x double, `n m` int")
    r = S.map_numeric(df, lambda c: c * 12, skip=("x",)).first()
    assert tuple(r) == ("a", 1.0, 24)


def test_recode(spark):
    df = spark.createDataFrame([(99,), (1,), (None,)], "q int")
    assert [r[0] for r in S.recode(df, ["q"], 99, 0).collect()] == [0, 1, None]
