from pyspark.sql import functions as F

from arearisk.plans import datasets as D
from tests.conftest import rows


def test_displacement_takes_the_latest_date_and_fills_only_the_total(spark):
    support = spark.createDataFrame([
        ("31 Dec 2019", "E1", "Dispersed Accommodation", 5), ("31 Dec 2019", "E1", "Dispersed Accommodation", 2),
        ("31 Dec 2019", "E2", "Subsistence Only", 4), ("30 Sep 2019", "E1", "Subsistence Only", 99)],
        "date_text string, lad19cd string, support string, people int")
    lads = spark.createDataFrame([("E1",), ("E2",), ("E3",)], "lad19cd string")
    assert rows(D.displacement(support, lads)) == [("E1", 7, 0, 7), ("E2", 0, 4, 4), ("E3", None, None, 0)]


def test_destitution_by_name_without_northern_ireland(spark):
    lads = spark.createDataFrame([("E1", "Alpha"), ("E2", "Beta"), ("N1", "Gamma")], "lad17cd string, lad17nm string")
    deciles = spark.createDataFrame([("Alpha", 10, 9, 8, 7), ("Gamma", 1, 1, 1, 1)],
                                    "name string, all_destitute int, migrant int, complex_needs int, uk_other int")
    assert rows(D.destitution(lads, deciles)) == [("E1", 10, 9, 8, 7), ("E2", None, None, None, None)]


def test_england_fires_repair_codes_and_keep_areas_without_population(spark):
    kind = D.DWELLING_FIRES[0]
    inc = spark.createDataFrame([
        ("2018/19", kind, "E01", "church"), ("2018/19", kind, "x", "E01"), ("2018/19", kind, "E02", None),
        ("2018/19", "Secondary fire", "E01", "church"), ("2017/18", kind, "E01", "church"), ("2018/19", kind, "E03", "mill")],
        "financial_year string, incident_type string, lsoa_code string, lsoa_description string")
    pop = spark.createDataFrame([("E01", 100), (None, 999)], "lsoa11cd string, n_people int")
    look = spark.createDataFrame([("E01", "M1"), ("E03", "M1")], "lsoa11cd string, msoa11cd string")
    small, area = D.fires_england(inc, pop, look, "2018/19")
    assert rows(small) == [("E01", 2, 100, 0.02), ("E03", 1, None, None), (None, 1, None, None)]
    assert rows(area) == [("M1", 3, None, None), (None, 1, None, None)]


def test_flooded_people_once_per_layer_and_northern_ireland_on_both_levels(spark):
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]]]
    pts = spark.createDataFrame([("E1", 1.0, 1.1), ("W1", 1.5, 1.2), ("E9", 9.0, 9.0)], "oa11cd string, x double, y double")
    eng = spark.createDataFrame([(1, square, "Flood Zone 3"), (2, square, "Flood Zone 3"), (3, square, "Flood Zone 2")],
                                "zone_id int, rings array<array<array<double>>>, layer string")
    wal = spark.createDataFrame([(1, square, "coast"), (2, square, None)], "zone_id int, rings array<array<array<double>>>, type string")
    pop = spark.createDataFrame([("E1", "L1", 10), ("W1", "L2", 20), ("E9", "L9", 5)], "oa11cd string, lsoa11cd string, n int")
    ni = spark.createDataFrame([("N1", "95A"), ("N2", "95A")], "sa2011 string, soa2011 string")
    pop_ni = spark.createDataFrame([(2018, "N1", 3), (2018, "N2", 4), (2017, "N1", 50)], "year int, sa2011 string, n int")
    look = spark.createDataFrame([("E1", "M1"), ("W1", "M1")], "oa11cd string, msoa11cd string")
    by_lsoa, by_msoa = D.people_in_flood_zones(pts, eng, wal, pop, ni, pop_ni, look)
    # Each point is in a zone of both layers, so it counts once per layer.
    assert rows(by_lsoa) == [("95A", 7), ("L1", 20), ("L2", 40)]
    assert rows(by_msoa) == [("95A", 7), ("M1", 60)]


def test_living_alone_in_three_shapes(spark):
    cols = {"ew": ("all", "one", "lone"), "sco": ("All people", "One", "Lone: x"), "ni": ("a", "b", "c")}
    ew = spark.createDataFrame([("E1", 100, 20, 5), ("E2", 0, 0, 0)], "code string, all int, one int, lone int")
    sco = spark.createDataFrame([("d1", 10, 1, 1), ("d2", 30, 5, 1), ("d3", 7, 1, 1)], "dz string, `All people` int, One int, `Lone: x` int")
    zones = spark.createDataFrame([("d1", "S1"), ("d2", "S1"), ("d1", "S1")], "dz string, iz string")
    ni = spark.createDataFrame([("95A", 50, 10, 0)], "code string, a int, b int, c int")
    assert rows(D.living_alone(ew, sco, ni, zones, cols)) == [
        ("95A", 0.2, 50.0, 10.0, 0.0), ("E1", 0.25, 100.0, 20.0, 5.0), ("E2", None, 0.0, 0.0, 0.0), ("S1", 0.2, 40.0, 6.0, 2.0)]


def test_health_areas_match_spelled_out_names(spark):
    male = spark.createDataFrame([("NHS A & B", 60.0), ("England", 61.0)], "name string, hle double")
    female = spark.createDataFrame([("NHS A & B", 64.0)], "name string, hle double")
    areas = spark.createDataFrame([("E38", "NHS A and B CCG")], "code string, name string")
    wales = spark.createDataFrame([("HLE", "201014", "X Health Board", "W7", 60.0), ("HLE", "201014", "X Health Board", "W7", None),
                                   ("LE", "201014", "X Health Board", "W7", 1.0), ("HLE", "201014", "Town", "W8", 1.0)],
                                  "measure_code string, year_code string, area_name string, area_code string, data double")
    sco = spark.createDataFrame([("S8", "Board", 58.0), ("S8", "Board", 60.0), (None, "note", 1.0)], "code string, name string, hle double")
    assert rows(D.life_expectancy_by_health_area(male, female, areas, wales, sco), "code", "name", "hle_birth") == [
        ("E38", "NHS A and B CCG", 62.0), ("S8", "Board", 59.0), ("W7", "X Health Board", 60.0)]


def test_deprivation_shares_promote_northern_ireland(spark):
    dec = spark.createDataFrame([("E1", 1), ("E2", 3), ("E3", None), ("95A", 2), ("E4", None)], "lsoa string, imd_decile int")
    look = spark.createDataFrame([("E1", "M1"), ("E2", "M1"), ("E3", "M2"), ("E4", "M3")], "lsoa string, msoa string")
    out = D.deprivation_summary(dec, look.withColumn("msoa", F.concat(F.lit("E"), "msoa")), "lsoa", "msoa",
                                promote_ni=True, complete_only=True, label=False)
    assert rows(out, "msoa", "top", "other", "prop_top2deciles", "country", "deprivation_q") == [
        ("95A", 1, 0, 1.0, "Northern Ireland", 1), ("EM1", 1, 1, 0.5, "England", 1)]


def test_settlements_count_mixed_areas_half(spark):
    ew = spark.createDataFrame([("E1", "A1"), ("E2", "F1"), ("E3", "??")], "lsoa11cd string, ruc11cd string")
    sco = spark.createDataFrame([("S1", 1), ("S2", None)], "lsoa11cd string, ur2fold int")
    ni = spark.createDataFrame([("95A", "1", "2", "-")], "lsoa11cd string, urban string, mixed string, rural string")
    look = spark.createDataFrame([(c, c[0] + "L") for c in ("E1", "E2", "E3", "S1", "S2", "95A")], "lsoa11cd string, lad string")
    out = D.settlement_summary(D.rural_urban_uk(ew, sco, ni), look, "lsoa11cd", "lad", label=False)
    assert rows(out, "lad", "urban", "mixed", "rural", "prop_urban") == [("9L", 1, 2, 0, 2 / 3), ("EL", 1, 0, 1, 0.5), ("SL", 1, 0, 0, 1.0)]
