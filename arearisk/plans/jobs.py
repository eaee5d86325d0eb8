"""The three batch steps: staged inputs to processed tables, combined risks, analysis.

Each step reads the files of the step before from the catalogue's folders and
ends in writes. Staged layouts are listed in the README.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.config import Catalogue
from arearisk.operators.classify import class_intervals
from arearisk.operators.joins import successors, union_filled, without_successor
from arearisk.operators.spatial import polygon_flags
from arearisk.plans import analysis as A
from arearisk.plans import datasets as D
from arearisk.plans import nations as NP
from arearisk.sources import readers as R
from arearisk.sources import writers as W

TEXT, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

# Column names of the census tables (people, one person, lone parent).
CENSUS_COLUMNS = {
    "ew": (
        "Household Composition: All categories: Household composition; measures: Value",
        "Household Composition: One person household: Total; measures: Value",
        "Household Composition: One family only: Lone parent: Total; measures: Value",
    ),
    "sco": ("All people in households", "One person household", "One family household: Lone parent family"),
    "ni": (
        "All usual residents in households",
        "One person household: Total",
        "One family and no other people: Lone parent: Total",
    ),
}


class Staged:
    """Readers for one catalogue."""

    def __init__(self, spark: SparkSession, cat: Catalogue):
        self.spark, self.cat = spark, cat

    def lookup(self, file: str, /, **columns: str) -> DataFrame:
        """Text columns of a lookup, `new=old`."""
        return self.sheet(f"lookups/{file}.csv", {old: (new, TEXT) for new, old in columns.items()})

    def sheet(self, path: str, columns: dict[str, tuple[str, T.DataType]], skip: int = 0) -> DataFrame:
        return R.read_sheets(self.spark, self.cat.raw(path), columns, skip).drop("sheet", "row_no")

    def rows(self, path: str, columns: dict[str, tuple[str, T.DataType]], skip: int = 0) -> DataFrame:
        return R.read_sheets(self.spark, self.cat.raw(path), columns, skip)

    def records(self, path: str, columns: dict[str, tuple[str, T.DataType]]) -> DataFrame:
        schema = T.StructType([T.StructField(old, kind) for old, (_, kind) in columns.items()])
        return R.read_records(self.spark, self.cat.raw(path), schema).select(
            *[F.col(old).alias(new) for old, (new, _) in columns.items()])

    def has(self, path: str) -> bool:
        """Whether a staged file is there."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.cat.raw(path))
        return bool(at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.cat.processed(name))


def _lads(s: Staged, year: int) -> DataFrame:
    yy = f"{year % 100:02d}"
    return s.lookup(f"lad_{year}", **{f"lad{yy}cd": f"LAD{yy}CD", f"lad{yy}nm": f"LAD{yy}NM"})


def _zones(s: Staged) -> DataFrame:
    return s.lookup("dz_iz_lad", dz="DataZone", iz="InterZone", council="Council").distinct()


def prepare(spark: SparkSession, cat: Catalogue, fire_year: str = "2018/19", fire_year_wales: str = "2018-19",
            fire_year_scotland: int = 2018) -> list[str]:
    """Build every processed table; returns their names."""
    s = Staged(spark, cat)
    lads17, lads19 = _lads(s, 2017), _lads(s, 2019)
    out: dict[str, DataFrame] = {}

    manual = s.lookup("lad_exceptions", lad17cd="LAD17CD", lad19cd="LAD19CD")
    out["lad_successor"] = successors(lads17, lads19, manual, "lad17cd", "lad17nm", "lad19cd", "lad19nm")
    out["lad_without_successor"] = without_successor(lads17, lads19, "lad17nm", "lad19nm").select("lad17cd", "lad17nm")

    out["destitution"] = D.destitution(lads17, s.sheet("destitution", {
        "Local authority": ("name", TEXT), "All destitute": ("all_destitute", LONG), "Migrant": ("migrant", LONG),
        "Complex needs": ("complex_needs", LONG), "UK - other": ("uk_other", LONG)}))
    out["digital"] = D.digital_exclusion(R.read_placemarks(
        spark, {m: cat.raw("digital-exclusion", m, "doc.kml") for m in D.DIGITAL_METRICS}))
    out["displacement"] = D.displacement(s.sheet("displacement", {
        "Date (as at…)": ("date_text", TEXT), "LAD Code": ("lad19cd", TEXT), "Support sub-type": ("support", TEXT),
        "People": ("people", LONG)}), lads19)

    lsoa_msoa = s.lookup("lsoa_msoa_lad", lsoa11cd="LSOA11CD", msoa11cd="MSOA11CD").distinct()
    small, area = D.fires_england(
        s.sheet("fires/england", {"FINANCIAL_YEAR": ("financial_year", TEXT), "INCIDENT_TYPE": ("incident_type", TEXT),
                                  "LSOA_CODE": ("lsoa_code", TEXT), "LSOA_DESCRIPTION": ("lsoa_description", TEXT)}),
        s.sheet("population/lsoa", {"Area Codes": ("lsoa11cd", TEXT), "LSOA": ("lsoa", TEXT), "All Ages": ("n_people", LONG)}, skip=4)
        .filter(F.col("lsoa").isNotNull()), lsoa_msoa, fire_year)
    out["fires_england_small"], out["fires_england_area"] = small, area
    out["fires_wales_service"] = D.fires_wales(
        s.records("fires/wales.json", {
            "Area_Code": ("area_code", TEXT), "Area_ItemName_ENG": ("area_name", TEXT), "Location_ItemName_ENG": ("location", TEXT),
            "Year_Code": ("year_code", TEXT), "Count_ItemName_ENG": ("count_name", TEXT), "Motive_ItemName_ENG": ("motive", TEXT),
            "Data": ("data", DOUBLE)}),
        s.records("dwellings/wales.json", {
            "Year_Code": ("year_code", TEXT), "Tenure_ItemName_ENG": ("tenure", TEXT), "Area_ItemName_ENG": ("area_name", TEXT),
            "Data": ("data", DOUBLE)}),
        s.lookup("services", fra19cd="FRA19CD", fra19nm="FRA19NM"),
        s.lookup("lad19_service", lad19nm="LAD19NM", fra19cd="FRA19CD"), fire_year_wales)
    dz, iz, council = D.fires_scotland(
        s.sheet("fires/scotland.csv", {
            "CalendarYear": ("calendar_year", LONG), "DataZone": ("dz", TEXT), "Accidental": ("accidental", LONG),
            "FireFatalities": ("fatalities", LONG), "FireCasualties_exc_precautionary_checks": ("casualties", LONG)}),
        s.sheet("dwellings/scotland.csv", {"2011 Data Zone code": ("dz", TEXT), "Occupied Dwellings": ("n_dwellings", LONG)}, skip=2),
        _zones(s), fire_year_scotland)
    out["fires_scotland_small"], out["fires_scotland_area"], out["fires_scotland_council"] = dz, iz, council

    flood_small, flood_area = D.people_in_flood_zones(
        R.read_points(spark, cat.raw("floods", "centroids.geojson"), R.typed_schema(["oa11cd"], TEXT)),
        R.read_polygons(spark, cat.raw("floods", "england.geojson"), R.typed_schema(["zone_id", "layer"], TEXT)),
        R.read_polygons(spark, cat.raw("floods", "wales.geojson"), R.typed_schema(["zone_id", "type"], TEXT)),
        D.read_region_populations(s.sheet("population/oa", {
            "OA11CD": ("oa11cd", TEXT), "LSOA11CD": ("lsoa11cd", TEXT), "All Ages": ("all_ages", LONG)}, skip=4)),
        s.sheet("floods/northern_ireland.csv", {"SA2011": ("sa2011", TEXT), "SOA2011": ("soa2011", TEXT)}),
        s.sheet("population/northern_ireland.csv", {"Year": ("year", LONG), "Area_Code": ("sa2011", TEXT), "MYE": ("n", LONG)}),
        s.lookup("oa_msoa", oa11cd="OA11CD", msoa11cd="MSOA11CD"))
    out["floods_small"], out["floods_area"] = flood_small, flood_area

    hle = {"Area Codes": ("code", TEXT), "HLE": ("hle", DOUBLE)}
    out["life_expectancy"] = D.healthy_life_expectancy(*[
        s.rows(f"life/{n}.csv", hle, skip=3) for n in ("birth_male", "birth_female", "old_male", "old_female")])
    ccg = {"CCG Name": ("name", TEXT), "HLE2,3 (years)": ("hle", DOUBLE)}
    out["life_expectancy_health_areas"] = D.life_expectancy_by_health_area(
        s.sheet("life/ccg_male.csv", ccg, skip=7), s.sheet("life/ccg_female.csv", ccg, skip=7),
        s.lookup("ccg", code="CCG18CD", name="CCG18NM"),
        s.records("life/wales.json", {
            "Measure_Code": ("measure_code", TEXT), "Year_Code": ("year_code", TEXT), "Area_ItemName_ENG": ("area_name", TEXT),
            "Area_AltCode1": ("area_code", TEXT), "Data": ("data", DOUBLE)}),
        s.sheet("life/scotland.csv", {"Area code": ("code", TEXT), "Health board": ("name", TEXT),
                                      "Healthy Life Expectancy (HLE) (years)": ("hle", DOUBLE)}, skip=2))

    def census(key: str, code: str, name: str = "code") -> DataFrame:
        return s.sheet(f"census/{key}.csv", {code: (name, TEXT), **{c: (c, LONG) for c in CENSUS_COLUMNS[key]}})

    names = s.sheet("census/ni_columns.csv", {"ColumnVariableCode": ("code", TEXT), "ColumnVariableDescription": ("text", TEXT)})
    codes = {r["text"]: r["code"] for r in names.filter(F.col("text").isin(*CENSUS_COLUMNS["ni"])).collect()}
    ni = R.rename_from_descriptions(
        s.sheet("census/ni.csv", {"GeographyCode": ("code", TEXT), **{codes[c]: (codes[c], LONG) for c in CENSUS_COLUMNS["ni"]}}),
        names, "code", "text")
    out["living_alone"] = D.living_alone(census("ew", "geography code"), census("sco", "DataZone", "dz"), ni, _zones(s), CENSUS_COLUMNS)

    for name, df in out.items():
        W.write_table(df, cat.processed(name))
    return sorted(out)


def area_lookup(s: Staged) -> DataFrame:
    """lsoa, area_code, lad_code, lad_name of all nations, one row per smallest area."""
    gb = s.lookup("lsoa_msoa_lad", lsoa="LSOA11CD", area_code="MSOA11CD", lad_code="LAD17CD", lad_name="LAD17NM").distinct()
    sco = s.lookup("dz_iz_lad", lsoa="DataZone", area_code="InterZone", lad_code="Council", lad_name="CouncilName").distinct()
    ni = s.lookup("sa_lgd", lsoa="LSOA11CD", lad_code="LAD18CD", lad_name="LAD18NM").withColumn("area_code", F.col("lsoa"))
    return union_filled(gb.filter(~F.col("area_code").startswith("S")), sco, ni)


# The staged point layers behind the presence flags.
PRESENCE_LAYERS = {"presence_services": "services", "presence_shops": "shops", "presence_props": "props"}


def presence(s: Staged) -> DataFrame | None:
    """Yes/No per local authority of 2019 and kind of place, from its boundary and the staged points; None if not staged."""
    if not s.has("presence/boundaries.geojson"):
        return None
    lads = R.read_polygons(s.spark, s.cat.raw("presence", "boundaries.geojson"), R.typed_schema(["lad19cd"], TEXT))
    points = {
        flag: (R.read_points(s.spark, s.cat.raw("presence", f"{name}.geojson"), R.typed_schema(["id"], TEXT)), "id", "x", "y")
        for flag, name in PRESENCE_LAYERS.items()}
    return polygon_flags(lads, "lad19cd", "rings", points)


def combine(spark: SparkSession, cat: Catalogue, k: int = 5, weight: str = "children") -> dict[str, DataFrame]:
    """Combined risks of all nations, written as tables, CSV and the report."""
    s = Staged(spark, cat)
    look = area_lookup(s)
    fires = union_filled(
        s.table("fires_england_area").select(F.col("msoa11cd").alias("area_code"), "n_fires", "dens_fires"),
        s.table("fires_scotland_area").select(F.col("iz").alias("area_code"), "n_fires", "dens_fires"))
    deciles = s.sheet("deprivation.csv", {"LSOA": ("lsoa", TEXT), "IMD_decile": ("imd_decile", LONG), "Health_decile": ("health_decile", LONG)})
    inp = NP.Inputs(
        areas=look.select("area_code").distinct(), fires=fires.filter(F.col("area_code").isNotNull()),
        floods=s.table("floods_area").filter(F.col("msoa11cd").isNotNull()).select(
            F.col("msoa11cd").alias("area_code"), F.col("n").alias("n_people_flood")),
        loneliness=s.sheet("loneliness", {"area_code": ("area_code", TEXT), "loneills_2018": ("loneills_2018", DOUBLE)}),
        alone=s.table("living_alone").withColumnRenamed("code", "area_code"), deciles=deciles, lookup=look,
        lad_successor=s.table("lad_successor").withColumnRenamed("lad17cd", "lad_code"),
        displacement=s.table("displacement").select("lad19cd", "sec95"),
        digital=s.table("digital").select(F.col("la_code").alias("lad_code"), "digital_total_mult"),
        life=s.table("life_expectancy").filter("area_kind = 'local authority'").select(F.col("code").alias("lad_code"), "hle_birth"),
        destitution=s.table("destitution").select(F.col("lad17cd").alias("lad_code"), "destitution_all", "destitution_migrant"),
        presence=presence(s),
        service_lookup=s.lookup("lad_service", lad_code="LAD17CD", service_code="FRA17CD", service_name="FRA17NM"),
        service_fires=s.table("fires_wales_service").select(F.col("fra19cd").alias("service_code"), "dens_fires"),
    )
    out = NP.run_nations(inp, k, weight)
    for level, df in out.items():
        W.write_table(df, cat.output(f"risks_{level}"), "country")
        W.write_csv(df, cat.output(f"csv/risks_{level}"))
    W.write_report({spec.country: NP.nation_report(out["lad"], spec) for spec in inp.specs}, cat.output("report"))
    return out


def analyse(spark: SparkSession, cat: Catalogue, outcomes: list[str] | None = None) -> list[str]:
    """Inequality and model tables from the combined risks; returns their names."""
    s = Staged(spark, cat)
    look = area_lookup(s).select(F.col("lsoa").alias("lsoa11cd"), F.col("area_code"), F.col("lad_code")).distinct()
    deciles = s.sheet("deprivation.csv", {"LSOA": ("lsoa11cd", TEXT), "IMD_decile": ("imd_decile", LONG)})
    ruc = D.rural_urban_uk(
        s.sheet("rural-urban/england_wales.csv", {"LSOA11CD": ("lsoa11cd", TEXT), "RUC11CD": ("ruc11cd", TEXT)}),
        s.sheet("rural-urban/scotland.csv", {"DZ_CODE": ("lsoa11cd", TEXT), "UR2FOLD": ("ur2fold", LONG)}),
        s.sheet("rural-urban/northern_ireland.csv", {"SOA Code": ("lsoa11cd", TEXT), "Urban": ("urban", TEXT),
                                                     "mixed urban/rural": ("mixed", TEXT), "Rural": ("rural", TEXT)}))
    tables, settlements = {}, {}
    for level, code, indicators in (
        ("lad", "lad_code", [c for c, _ in A.INDICATORS.values()]),
        ("small", "area_code", ["n_fires", "n_people_flood", "loneills_2018", "prop_alone"]),
    ):
        pairs = look.select("lsoa11cd", code).distinct()
        dep = D.deprivation_summary(deciles, pairs, "lsoa11cd", code, label=False, complete_only=level == "small")
        setl = D.settlement_summary(ruc, pairs, "lsoa11cd", code)
        settlements[level] = class_intervals(setl, "settlement", ["country"])
        risks = spark.read.parquet(cat.output(f"risks_{level}")).drop("country")
        tables[level] = D.indicator_table([risks], code, indicators, dep, setl)
    out = A.nation_analysis(tables["lad"], tables["small"], outcomes)
    out["settlement_classes"] = settlements["lad"]
    # Fire indicators of service areas exist for Wales only.
    services = D.service_lookup(look.select("lsoa11cd", F.col("lad_code").alias("lad17cd")),
                                s.lookup("lad_service", lad17cd="LAD17CD", fra17cd="FRA17CD"))
    out["deprivation_services"] = D.deprivation_summary(deciles, services, "lsoa11cd", "fra17cd", countries=["Wales"])
    for name, df in out.items():
        W.write_csv(df, cat.output("analysis", name))
    return sorted(out)
