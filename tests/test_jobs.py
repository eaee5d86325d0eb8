"""All three steps on a small staged country set."""

import json

import pytest

from arearisk.config import Catalogue
from arearisk.plans import jobs
from tests.conftest import rows

LETTERS = "EWS"
N_AREAS, N_LADS = 12, 6


def sheet(titles, header, lines):
    return "\n".join(["Title"] * titles + [header, *lines]) + "\n"


@pytest.fixture(scope="module")
def cat(tmp_path_factory):
    root = tmp_path_factory.mktemp("staged")

    def put(path, text):
        p = root / "raw" / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text, encoding="utf-8")

    lads = [f"{l}06{j}" for l in LETTERS for j in range(N_LADS)]
    ni = [f"N09{j}" for j in range(3)]
    areas = [(f"{l}02{i}", f"{l}06{i % N_LADS}") for l in LETTERS for i in range(N_AREAS)]
    small = [(f"{a[0]}01{a[3:]}{s}", a, d) for a, d in areas for s in "abc"]
    soas = [(f"95S{i}", ni[i % 3]) for i in range(6)]
    both = lads + ni
    for year, yy in ((2017, "17"), (2019, "19")):
        put(f"lookups/lad_{year}.csv", sheet(0, f"LAD{yy}CD,LAD{yy}NM", [f"{d},Name {d}" if (d, yy) != ("E060", "19") else "E900,Merged" for d in both]))
    put("lookups/lad_exceptions.csv", "LAD17CD,LAD17NM,LAD19CD\nE060,Name E060,E900\n")
    gb = [(s, a, d) for s, a, d in small if s[0] in "EW"]
    put("lookups/lsoa_msoa_lad.csv", sheet(0, "LSOA11CD,MSOA11CD,LAD17CD,LAD17NM", [f"{s},{a},{d},Name {d}" for s, a, d in gb]))
    put("lookups/dz_iz_lad.csv", sheet(0, "DataZone,InterZone,Council,CouncilName", [f"{s},{a},{d},Name {d}" for s, a, d in small if s[0] == "S"]))
    put("lookups/sa_lgd.csv", sheet(0, "SA11CD,LSOA11CD,LAD18CD,LAD18NM", [f"N{i}{j},{s},{d},Name {d}" for i, (s, d) in enumerate(soas) for j in range(2)]))
    put("lookups/oa_msoa.csv", sheet(0, "OA11CD,MSOA11CD", [f"{s}x,{a}" for s, a, _ in gb]))
    put("lookups/services.csv", "FRA19CD,FRA19NM\nW250,North\nW251,South\n")
    wal = [d for d in lads if d[0] == "W"]
    put("lookups/lad19_service.csv", sheet(0, "LAD19NM,FRA19CD", [f"Name {d},W25{i % 2}" for i, d in enumerate(wal)]))
    put("lookups/lad_service.csv", sheet(0, "LAD17CD,FRA17CD,FRA17NM", [f"{d},W25{i % 2},{['North', 'South'][i % 2]}" for i, d in enumerate(wal)]))
    put("lookups/ccg.csv", "CCG18CD,CCG18NM\nE38,NHS A and B CCG\n")
    put("destitution/s.csv", sheet(0, "Local authority,All destitute,Migrant,Complex needs,UK - other", [f"Name {d},{i % 10 + 1},{i * 3 % 10 + 1},1,2" for i, d in enumerate(both)]))
    for m, metric in enumerate(("infrastructure", "access", "skill", "use")):
        put(f"digital-exclusion/{metric}/doc.kml", '<kml xmlns="http://x"><Document>' + "".join(
            f"<Placemark><name>{d}</name><styleUrl>#{(i * (m + 2)) % 9 + 1}</styleUrl></Placemark>" for i, d in enumerate(both)) + "</Document></kml>")
    put("displacement/d.csv", sheet(0, "Date (as at…),LAD Code,Support sub-type,People", [
        f"31 Dec 2019,{'E900' if d == 'E060' else d},{k},{(i * 37) % 50 * n}" for i, d in enumerate(both) if i % 5 for n, k in enumerate(("Dispersed Accommodation", "Subsistence Only"), 1)]))
    fires = "FINANCIAL_YEAR,INCIDENT_TYPE,LSOA_CODE,LSOA_DESCRIPTION"
    put("fires/england/county.csv", sheet(0, fires, [f"2018/19,Primary fire - dwelling,{s},church" for i, (s, *_) in enumerate(gb) if s[0] == "E" for _ in range(i % 4)]))
    put("population/lsoa/p.csv", sheet(4, "Area Codes,LSOA,All Ages", ["E060,,9999"] + [f"{s},{s},{100 + 7 * i}" for i, (s, *_) in enumerate(gb)]))
    put("fires/wales.json", "\n".join(json.dumps({"Area_Code": c, "Area_ItemName_ENG": n, "Location_ItemName_ENG": "Dwellings", "Year_Code": "2018-19",
                                                  "Count_ItemName_ENG": "Fires", "Motive_ItemName_ENG": "All motives", "Data": v}) for c, n, v in (("1", "North", 30.0), ("2", "South", 10.0), ("All", "Wales", 40.0))))
    put("dwellings/wales.json", "\n".join(json.dumps({"Year_Code": y, "Tenure_ItemName_ENG": "All tenures (Number)", "Area_ItemName_ENG": f"Name {d}", "Data": 100.0}) for y in ("201718", "201819") for d in wal))
    put("fires/scotland.csv", sheet(0, "CalendarYear,DataZone,Accidental,FireFatalities,FireCasualties_exc_precautionary_checks", [f"2018,{s},1,0,0" for i, (s, *_) in enumerate(small) if s[0] == "S" for _ in range(i % 5)]))
    put("dwellings/scotland.csv", sheet(2, "2011 Data Zone code,Occupied Dwellings", [f"{s},{50 + 3 * i}" for i, (s, *_) in enumerate(small) if s[0] == "S"]))
    put("floods/centroids.geojson", "\n".join(json.dumps({"type": "Feature", "properties": {"oa11cd": s + "x"}, "geometry": {"type": "Point", "coordinates": [i % 10 + 0.5, i // 10 + 0.5]}}) for i, (s, *_) in enumerate(gb)))

    def zone(props, x0, x1):
        return json.dumps({"type": "Feature", "properties": props, "geometry": {"type": "Polygon", "coordinates": [[[x0, 0], [x1, 0], [x1, 99], [x0, 99], [x0, 0]]]}}) + "\n"

    put("floods/england.geojson", zone({"zone_id": "1", "layer": "Flood Zone 3"}, 0, 6) + zone({"zone_id": "2", "layer": "Flood Zone 2"}, 6, 10))
    put("floods/wales.geojson", zone({"zone_id": "1", "type": "coast"}, 4, 9))
    lads19 = ["E900" if d == "E060" else d for d in both]

    def place(i, x, y):
        return json.dumps({"type": "Feature", "properties": {"id": str(i)}, "geometry": {"type": "Point", "coordinates": [x, y]}})

    put("presence/boundaries.geojson", "".join(json.dumps({"type": "Feature", "properties": {"lad19cd": d}, "geometry": {"type": "Polygon", "coordinates": [
        [[i, 50], [i + 1, 50], [i + 1, 51], [i, 51], [i, 50]]]}}) + "\n" for i, d in enumerate(lads19)))
    put("presence/services.geojson", "\n".join(place(i, i + 0.5, 50.5) for i in range(0, len(lads19), 2)))
    put("presence/shops.geojson", "\n".join(place(i, i + 0.25, 50.75) for i in range(0, len(lads19), 3)) + "\n" + place(99, 0.5, 52.0))
    put("presence/props.geojson", place(0, 100.5, 50.5))
    put("population/oa/east.csv", sheet(4, "OA11CD,LSOA11CD,All Ages", [f"{s}x,{s},{30 + 11 * i % 70}" for i, (s, *_) in enumerate(gb)]))
    put("floods/northern_ireland.csv", sheet(0, "SA2011,SOA2011", [f"N{i}0,{s}" for i, (s, _) in enumerate(soas)]))
    put("population/northern_ireland.csv", sheet(0, "Year,Area_Code,MYE", [f"{y},N{i}0,{20 + 9 * i}" for y in (2017, 2018) for i in range(6)]))
    for n in ("birth_male", "birth_female", "old_male", "old_female"):
        put(f"life/{n}.csv", sheet(3, "Area Codes,HLE", [f"{d},{'' if i % 7 == 3 else 55 + i * 13 % 17}" for i, d in enumerate(both)] + ["E12000001,60", "1 note,"]))
    for n in ("ccg_male", "ccg_female"):
        put(f"life/{n}.csv", sheet(7, '"CCG Name","HLE2,3 (years)"', ["NHS A & B,61.5"]))
    put("life/wales.json", json.dumps({"Measure_Code": "HLE", "Year_Code": "201014", "Area_ItemName_ENG": "X Health Board", "Area_AltCode1": "W7", "Data": 60.0}))
    put("life/scotland.csv", sheet(2, "Area code,Health board,Healthy Life Expectancy (HLE) (years)", ["S8,Board,59"]))
    head = jobs.CENSUS_COLUMNS
    put("census/ew.csv", sheet(0, "geography code," + ",".join(head["ew"]), [f"{a},{200 + i},{10 + i * 7 % 30},{i % 5}" for i, (a, _) in enumerate(areas) if a[0] in "EW"]))
    put("census/sco.csv", sheet(0, "DataZone," + ",".join(head["sco"]), [f"{s},{90 + i},{i * 5 % 20},{i % 4}" for i, (s, *_) in enumerate(small) if s[0] == "S"]))
    put("census/ni.csv", sheet(0, "GeographyCode,Q1,Q2,Q3", [f"{s},{80 + i},{i * 3},{i}" for i, (s, _) in enumerate(soas)]))
    put("census/ni_columns.csv", sheet(0, "ColumnVariableCode,ColumnVariableDescription", [f'Q{i},"{c}"' for i, c in enumerate(head["ni"], 1)]))
    put("loneliness/all.csv", sheet(0, "area_code,loneills_2018", [f"{a},{i * 17 % 41 / 4}" for i, (a, _) in enumerate(areas)] + [f"{s},{i / 2}" for i, (s, _) in enumerate(soas)]))
    codes = [s for s, *_ in small] + [s for s, _ in soas]
    put("deprivation.csv", sheet(0, "LSOA,Name,IMD_decile,Health_decile", [f"{s},n,{i * 7 % 10 + 1},{i * 3 % 10 + 1}" for i, s in enumerate(codes)]))
    put("rural-urban/england_wales.csv", sheet(0, "LSOA11CD,RUC11CD", [f"{s},{['A1', 'C2', 'D1', 'F2', 'B1'][i * i % 5]}" for i, (s, *_) in enumerate(gb)]))
    put("rural-urban/scotland.csv", sheet(0, "DZ_CODE,UR2FOLD", [f"{s},{i * i % 3 % 2 + 1}" for i, (s, *_) in enumerate(small) if s[0] == "S"]))
    put("rural-urban/northern_ireland.csv", sheet(0, "SOA Code,Urban,mixed urban/rural,Rural", [f"{s},{i % 3},-,{i % 2 + 1}" for i, (s, _) in enumerate(soas)]))
    return Catalogue(str(root), str(root / "out"))


def test_staged_files_to_analysis(spark, cat):
    names = jobs.prepare(spark, cat)
    assert len(names) == 16
    for name in names:
        assert spark.read.parquet(cat.processed(name)).limit(1).count() == 1, name
    assert rows(spark.read.parquet(cat.processed("fires_wales_service")), "fra19cd", "dens_fires") == [("W250", 0.1), ("W251", 10 / 300)]
    assert ("E060", "E900") in rows(spark.read.parquet(cat.processed("lad_successor")), "lad17cd", "lad19cd")

    jobs.combine(spark, cat)
    small, lad = (spark.read.parquet(cat.output(f"risks_{n}")) for n in ("small", "lad"))
    assert small.count() == 3 * N_AREAS + 6 and lad.count() == 3 * N_LADS + 3
    assert spark.read.parquet(cat.output("risks_service")).count() == 2
    assert small.filter("country = 'England' and fires_q = 1").count() > 0
    assert lad.filter("combined_risk like '%Digital exclusion%'").count() > 0

    flags = ("presence_services", "presence_shops", "presence_props")
    got = {r["lad_code"]: tuple(r[f] for f in flags) for r in lad.collect()}
    order = [f"{l}06{j}" for l in LETTERS for j in range(N_LADS)] + [f"N09{j}" for j in range(3)]
    assert got == {d: ("No" if i % 2 else "Yes", "No" if i % 3 else "Yes", "No") for i, d in enumerate(order)}
    shown = spark.read.option("header", True).csv(cat.output("report"))
    assert {"Services present?", "Shops present?", "Properties present?"} <= set(shown.columns)

    done = jobs.analyse(spark, cat, outcomes=["life"])
    assert {"inequality_summary", "life_comparison", "life_deprivation_band"} <= set(done)
    services = spark.read.option("header", True).csv(cat.output("analysis", "deprivation_services"))
    assert sorted((r["fra17cd"], int(r["top"]) + int(r["other"]), r["country"]) for r in services.collect()) == [
        ("W250", 3 * N_AREAS // 2, "Wales"), ("W251", 3 * N_AREAS // 2, "Wales")]
    classes = spark.read.option("header", True).csv(cat.output("analysis", "settlement_classes"))
    assert {r["country"] for r in classes.collect()} == {"England", "Wales", "Scotland", "Northern Ireland"}
    assert classes.filter("settlement_q_name rlike '^[(\\\\[].*, .*\\\\]$'").count() == classes.count()
    band = spark.read.option("header", True).csv(cat.output("analysis", "life_deprivation_band"))
    assert band.count() == 4 * 101
