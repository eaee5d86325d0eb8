import pytest
from pyspark.sql import functions as F

from arearisk.plans import nations as NP
from tests.conftest import rows


@pytest.fixture(scope="module")
def result(spark):
    """Six neighbourhoods per nation with rising values; the last one lacks most data."""
    letters = {"E": "England", "W": "Wales", "S": "Scotland", "9": "Northern Ireland"}
    areas = [(f"{l}m{i}",) for l in letters for i in range(1, 7)]
    known = [a for (a,) in areas if not a.endswith("6")]
    rank = {a: int(a[-1]) for a in known}
    lad = {"9": "N"}
    lads = [f"{lad.get(l, l)}d{j}" for l in letters for j in (1, 2)]
    inp = NP.Inputs(
        areas=spark.createDataFrame(areas, "area_code string"),
        fires=spark.createDataFrame([(a, rank[a] / 10) for a in known if a[0] in "ES"], "area_code string, dens_fires double"),
        floods=spark.createDataFrame([(a, rank[a]) for a in known if a[0] != "S"], "area_code string, n_people_flood int"),
        loneliness=spark.createDataFrame([(a, float(rank[a])) for a in known], "area_code string, loneills_2018 double"),
        alone=spark.createDataFrame([(a, rank[a] / 20, 100, 3, 2) for a in known],
                                    "area_code string, prop_alone double, n_people_total int, n_one_person_hh int, n_lone_parents int"),
        deciles=spark.createDataFrame([(a + s, 2 * rank[a] - (s == "x"), 10) for a in known for s in "xy"],
                                      "lsoa string, imd_decile int, health_decile int"),
        lookup=spark.createDataFrame([(a + s, a, f"{lad.get(a[0], a[0])}d{1 if int(a[-1]) < 4 else 2}", "name") for (a,) in areas for s in "xy"],
                                     "lsoa string, area_code string, lad_code string, lad_name string"),
        lad_successor=spark.createDataFrame([(d, d + "_19") for d in lads], "lad_code string, lad19cd string"),
        displacement=spark.createDataFrame([(d if d[0] == "N" else d + "_19", 5 * i) for i, d in enumerate(lads)], "lad19cd string, sec95 int"),
        digital=spark.createDataFrame([(d, i) for i, d in enumerate(lads)], "lad_code string, digital_total_mult int"),
        life=spark.createDataFrame([(d, 60.0 + i) for i, d in enumerate(lads)], "lad_code string, hle_birth double"),
        destitution=spark.createDataFrame([(d, 10, 3) for d in lads if d[0] != "N"], "lad_code string, destitution_all int, destitution_migrant int"),
        presence=spark.createDataFrame([("Ed1_19", "Yes")], "lad19cd string, presence_services string"),
        service_lookup=spark.createDataFrame([("Wd1", "W9", "Service"), ("Wd2", "W9", "Service")], "lad_code string, service_code string, service_name string"),
        service_fires=spark.createDataFrame([("W9", 0.5)], "service_code string, dens_fires double"),
    )
    return NP.run_nations(inp)


def test_an_absent_indicator_stays_missing_and_a_gap_becomes_zero(result):
    q = {r["area_code"]: r for r in result["small"].collect()}
    assert q["Wm1"]["fires_q"] is None and q["Sm1"]["floods_q"] is None
    assert q["Em6"]["fires_q"] == 0 and q["9m6"]["lonely_q"] == 0
    assert [q[f"Em{i}"]["fires_q"] for i in range(1, 6)] == [5, 4, 3, 2, 1]


def test_labels_follow_the_order_of_the_nation(result):
    q = {r["area_code"]: r["combined_risk"] for r in result["small"].collect()}
    assert q["Em5"] == "Fires, Flooding, Loneliness, Living alone"
    assert q["Em1"] == "IMD" and q["Em3"] is None and q["Em6"] is None
    assert q["Sm5"] == "Fires, Loneliness, Living alone"


def test_missing_classes_hide_risks_only_where_the_sentinel_is_zero(result):
    """99 loses to any class under a minimum; 0 wins, so the Northern Irish authority with a gap has 0."""
    lad = {r["lad_code"]: r for r in result["lad"].collect()}
    assert lad["Ed2"]["worst_lonely_q"] == 1 and lad["Nd2"]["worst_lonely_q"] == 0
    assert "Loneliness" in lad["Ed2"]["combined_risk"] and "Loneliness" not in lad["Nd2"]["combined_risk"]


def test_authority_level_indicators(result):
    lad = {r["lad_code"]: r for r in result["lad"].collect()}
    assert lad["Nd1"]["displacement_q"] == 1  # any support at all
    assert lad["Ed1"]["destitution_q"] == 1 and lad["Ed1"]["migrant_dest_q"] == 4 and lad["Nd1"]["destitution_q"] is None
    assert (lad["Ed1"]["hle_birth_q"], lad["Ed2"]["hle_birth_q"]) == (2, 1)
    assert lad["Ed1"]["presence_services"] == "Yes" and lad["Ed2"]["presence_services"] is None
    assert lad["Ed1"]["worst_alone"] == pytest.approx(0.05) and lad["Ed1"]["median_lonely"] == 2.0


def test_service_areas(result):
    r = result["service"].first()
    assert r["service_name"] == "Service" and r["fires_q"] == 1 and r["worst_lonely_q"] == 1
    assert r["combined_risk"].startswith("Fires, Flooding, Displacement, Loneliness")


def test_report_of_one_nation(result):
    rep = NP.nation_report(result["lad"], NP.NATIONS[0])
    assert rep.columns[:3] == ["Local Authority code", "Local Authority", "Fire risk"]
    ones = [r["No. 1s"] for r in rep.collect()]
    assert ones == sorted(ones, reverse=True) and len(ones) == 2
    assert "Fire risk" not in NP.nation_report(result["lad"], NP.NATIONS[1]).columns
    assert result["lad"].filter(F.col("country") == "Wales").count() == 2
    assert rows(result["lad"].groupBy("country").count())[0] == ("England", 2)
