"""Indicator tables: one pure function per data product, inputs are DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.functions.nulls import ratio, row_mean, strict_sum
from arearisk.functions.scalars import (
    area_kind, country_of, harmonise_name, has_prefix, looks_like_code, mixed_share, parse_period,
    rating, repair_code, settlement_of_code, settlement_of_fold, to_integer,
)
from arearisk.operators.classify import classify
from arearisk.operators.hierarchy import event_rate, roll_up_rate
from arearisk.operators.joins import attach, compose, distinct_pairs, latest, star, union_filled
from arearisk.operators.reshape import crosstab, fill_down, pivot_sum, share, sum_all
from arearisk.operators.spatial import points_in_polygons
from arearisk.scratch import materialize

# What counts as a dwelling fire in the incident data.
DWELLING_FIRES = [
    "Primary fire - dwelling",
    "Primary fire - dwelling or other building",
    "Primary fire - other buildings - Student Hall of Residence",
    "Primary fire - other buildings - Other Residential Home",
]

# The four digital ratings and the two kinds of support.
DIGITAL_METRICS = ["infrastructure", "access", "skill", "use"]
SUPPORT_KINDS = {"Dispersed Accommodation": "dispersed_accommodation", "Subsistence Only": "subsistence_only"}


def destitution(lads: DataFrame, deciles: DataFrame) -> DataFrame:
    """Destitution deciles by local authority, matched by name; Northern Ireland has none.

    lads: lad17cd, lad17nm. deciles: name, all_destitute, migrant, complex_needs, uk_other.
    """
    joined = attach(lads, deciles, {"lad17nm": "name"}).filter(~has_prefix("lad17cd", ["N"]))
    return joined.select(
        "lad17cd", F.col("all_destitute").alias("destitution_all"), F.col("migrant").alias("destitution_migrant"),
        F.col("complex_needs").alias("destitution_complex"), F.col("uk_other").alias("destitution_uk_other"))


def digital_exclusion(placemarks: DataFrame, metrics: Sequence[str] = tuple(DIGITAL_METRICS)) -> DataFrame:
    """Ratings per area from long (metric, name, style_url) rows, with their sum and product."""
    wide = placemarks.groupBy(F.col("name").alias("la_code")).agg(
        *[F.max(F.when(F.col("metric") == m, rating("style_url"))).alias(m) for m in metrics])
    total, product = F.col(metrics[0]), F.col(metrics[0])
    for m in metrics[1:]:
        total, product = total + F.col(m), product * F.col(m)
    return wide.withColumns({"digital_total_sum": total, "digital_total_mult": product})


def displacement(support: DataFrame, lads: DataFrame) -> DataFrame:
    """People on support by local authority at the latest date; areas without any have 0.

    support: date_text, lad19cd, support, people. lads: lad19cd.
    """
    now = latest(support.withColumn("date", parse_period("date_text")), "date")
    wide = pivot_sum(now, ["lad19cd"], "support", "people", list(SUPPORT_KINDS))
    kinds = list(SUPPORT_KINDS.values())
    wide = wide.select("lad19cd", *[F.col(k).alias(v) for k, v in SUPPORT_KINDS.items()])
    wide = wide.withColumn("sec95", F.col(kinds[0]) + F.col(kinds[1]))
    return attach(lads.select("lad19cd"), wide, "lad19cd").withColumn("sec95", F.coalesce("sec95", F.lit(0)))


def fires_england(incidents: DataFrame, population: DataFrame, lookup: DataFrame, year: str,
                  denominator: str = "areas_with_events") -> tuple[DataFrame, DataFrame]:
    """Dwelling fires per person by small area and by neighbourhood.

    incidents: financial_year, incident_type, lsoa_code, lsoa_description.
    population: lsoa11cd, n_people. lookup: lsoa11cd, msoa11cd.
    """
    kept = incidents.filter((F.col("financial_year") == year) & F.col("incident_type").isin(DWELLING_FIRES))
    coded = kept.select(repair_code("lsoa_description", "lsoa_code").alias("lsoa11cd"))
    # Stored, so that the incidents are read once for both levels.
    small = materialize(event_rate(coded, population.filter(F.col("lsoa11cd").isNotNull()), "lsoa11cd",
                                   "n_fires", "n_people", "dens_fires", denominator), "fires-england")
    return small, roll_up_rate(small, lookup, "lsoa11cd", "msoa11cd", "n_fires", "n_people", "dens_fires")


def fires_wales(records: DataFrame, dwellings: DataFrame, services: DataFrame, lad_to_service: DataFrame,
                year: str) -> DataFrame:
    """Dwelling fires per dwelling by fire service area.

    records: area_code, area_name, location, year_code, count_name, motive, data.
    dwellings: year_code, tenure, area_name, data. services: fra19cd, fra19nm.
    lad_to_service: lad19nm, fra19cd.
    """
    fires = (
        records.filter(
            (F.col("area_code") != "All") & F.col("location").isin("Dwellings") & (F.col("year_code") == year)
            & (F.col("count_name") == "Fires") & (F.col("motive") == "All motives"))
        .groupBy(F.col("area_name").alias("fra19nm")).agg(strict_sum("data").alias("n_fires"))
    )
    fires = attach(fires, services.select("fra19cd", "fra19nm"), "fra19nm").drop("fra19nm")
    stock = latest(dwellings, "year_code").filter(F.col("tenure") == "All tenures (Number)").select(
        F.col("area_name").alias("lad19nm"), F.col("data").alias("n"))
    stock = attach(stock, lad_to_service.select("lad19nm", "fra19cd"), "lad19nm").dropna("any")
    stock = stock.groupBy("fra19cd").agg(strict_sum("n").alias("n_dwellings")).dropna("any")
    return attach(fires, stock, "fra19cd").select(
        "fra19cd", "n_fires", "n_dwellings", ratio("n_fires", "n_dwellings").alias("dens_fires"))


def fires_scotland(incidents: DataFrame, dwellings: DataFrame, lookup: DataFrame,
                   year: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dwelling fires per dwelling by data zone, intermediate zone and council.

    incidents: calendar_year, dz, accidental, fatalities, casualties.
    dwellings: dz, n_dwellings. lookup: dz, iz, council.
    """
    small = (
        incidents.filter(F.col("calendar_year") == year).groupBy("dz")
        .agg(F.count(F.lit(1)).alias("n_fires"), strict_sum("accidental").alias("n_accidental"),
             strict_sum("fatalities").alias("n_fatalities"), strict_sum("casualties").alias("n_casualties"))
    )
    small = attach(small, dwellings.dropna("any").select("dz", "n_dwellings"), "dz")
    # Stored, so that the incidents are read once for all three levels.
    small = materialize(small.withColumn("dens_fires", ratio("n_fires", "n_dwellings")), "fires-scotland")
    up = [roll_up_rate(small, lookup, "dz", p, "n_fires", "n_dwellings", "dens_fires") for p in ("iz", "council")]
    return small, up[0], up[1]


def read_region_populations(sheets: DataFrame) -> DataFrame:
    """Population per output area from all region sheets in one read."""
    return sheets.select("oa11cd", "lsoa11cd", F.col("all_ages").alias("n"))


def people_in_flood_zones(centroids: DataFrame, zones_england: DataFrame, zones_wales: DataFrame,
                          population: DataFrame, small_areas_ni: DataFrame, population_ni: DataFrame,
                          oa_lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """People whose output area's centre lies in a flood zone, by small area and neighbourhood.

    centroids: oa11cd, x, y. zones: zone_id, rings and `layer` (England) or `type` (Wales).
    population: oa11cd, lsoa11cd, n. small_areas_ni: sa2011, soa2011.
    population_ni: year, sa2011, n. oa_lookup: oa11cd, msoa11cd.
    """
    zones = union_filled(
        zones_england.filter(F.col("layer") == "Flood Zone 3").select(F.concat(F.lit("e"), F.col("zone_id").cast("string")).alias("zone"), F.lit("e").alias("part"), "rings"),
        zones_wales.filter(F.col("type").isNotNull()).select(F.concat(F.lit("w"), F.col("zone_id").cast("string")).alias("zone"), F.lit("w").alias("part"), "rings"),
    )
    inside = points_in_polygons(centroids, "oa11cd", "x", "y", zones, "zone", "rings")
    # Once per layer, as each nation's layer is matched on its own and gives a point one polygon at most.
    # Stored, so that points meet polygons once for both levels.
    flooded = materialize(inside.select("oa11cd", F.substring("zone", 1, 1).alias("part")).distinct(), "flooded")
    gb = attach(flooded.select("oa11cd"), population.select("oa11cd", "lsoa11cd", "n"), "oa11cd")
    ni = attach(small_areas_ni.select("sa2011", "soa2011"), latest(population_ni, "year").select("sa2011", "n"), "sa2011")
    people = gb.unionByName(ni.select(F.col("sa2011").alias("oa11cd"), F.col("soa2011").alias("lsoa11cd"), "n"))
    by_lsoa = people.groupBy("lsoa11cd").agg(strict_sum("n").alias("n"))
    gb_people = attach(people.filter(~has_prefix("oa11cd", ["N"])), oa_lookup.select("oa11cd", "msoa11cd"), "oa11cd")
    by_msoa = gb_people.groupBy("msoa11cd").agg(strict_sum("n").alias("n"))
    ni_as_msoa = by_lsoa.filter(F.substring("lsoa11cd", 1, 1) == "9").withColumnRenamed("lsoa11cd", "msoa11cd")
    return by_lsoa, by_msoa.unionByName(ni_as_msoa)


def _filled_sheet(sheet: DataFrame, name: str) -> DataFrame:
    """sheet: sheet, row_no, code, hle. Gaps take the value above; rows without a code go."""
    return fill_down(sheet, ["sheet"], "row_no", "hle", name).select("code", name).dropna("any")


def healthy_life_expectancy(birth_male: DataFrame, birth_female: DataFrame, old_male: DataFrame,
                            old_female: DataFrame) -> DataFrame:
    """Healthy life expectancy per area with the mean of both sexes and `area_kind`."""
    joined = star(
        _filled_sheet(birth_male, "hle_birth_male"),
        (_filled_sheet(birth_female, "hle_birth_female"), "code"),
        (_filled_sheet(old_male, "hle_65_male"), "code"),
        (_filled_sheet(old_female, "hle_65_female"), "code"),
    )
    return joined.filter(looks_like_code("code")).withColumns({
        "hle_birth": row_mean("hle_birth_male", "hle_birth_female"),
        "hle_65": row_mean("hle_65_male", "hle_65_female"),
        "area_kind": area_kind("code"),
    })


def life_expectancy_by_health_area(england_male: DataFrame, england_female: DataFrame, areas: DataFrame,
                                   wales: DataFrame, scotland: DataFrame) -> DataFrame:
    """Healthy life expectancy at birth by health area, England, Wales and Scotland.

    england_*: name, hle. areas: code, name. wales: measure_code, year_code,
    area_name, area_code, data. scotland: code, name, hle.
    """
    eng = attach(
        england_male.select("name", F.col("hle").alias("hle_birth_male")),
        england_female.select("name", F.col("hle").alias("hle_birth_female")), "name",
    ).withColumn("name", harmonise_name("name", " CCG"))
    eng = attach(eng, areas.select("name", "code"), "name").filter(F.col("name").rlike("NHS")).withColumn(
        "hle_birth", row_mean("hle_birth_male", "hle_birth_female"))
    wal = wales.filter(
        (F.col("measure_code") == "HLE") & (F.col("year_code") == "201014") & F.col("area_name").rlike("Health Board")
    ).groupBy(F.col("area_code").alias("code"), F.col("area_name").alias("name")).agg(F.avg("data").alias("hle_birth"))
    sco = scotland.groupBy("code", "name").agg(F.avg("hle").alias("hle_birth")).dropna("any")
    return union_filled(eng.select("code", "name", "hle_birth_male", "hle_birth_female", "hle_birth"), wal, sco)


def living_alone(england_wales: DataFrame, scotland: DataFrame, northern_ireland: DataFrame, zones: DataFrame,
                 columns: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """Share of people living alone or as lone parents, three censuses in one shape.

    `columns` gives (people, one person, lone parent) column names under the
    keys ew, sco and ni. Area codes are in `code` (Scotland: `dz`, summed to
    zones by `zones`: dz, iz).
    """
    summed = attach(scotland, distinct_pairs(zones, "dz", "iz"), "dz").filter(F.col("iz").isNotNull()).drop("dz")
    frames = {"ew": england_wales, "sco": sum_all(summed, "iz").withColumnRenamed("iz", "code"), "ni": northern_ireland}
    parts = []
    for key, df in frames.items():
        people, one, lone = (F.col(f"`{c}`") for c in columns[key])
        parts.append(df.select(
            "code", ratio(one + lone, people).alias("prop_alone"), people.cast("double").alias("n_people_total"),
            one.cast("double").alias("n_one_person_hh"), lone.cast("double").alias("n_lone_parents")))
    return union_filled(*parts)


def deprivation_summary(deciles: DataFrame, lookup: DataFrame, child: str, parent: str, classes: int = 10,
                        promote_ni: bool = False, complete_only: bool = False,
                        countries: Sequence[str] | None = None, **kw) -> DataFrame:
    """Share of small areas in the two most deprived deciles per parent, and its class per country.

    deciles: `child`, imd_decile. `promote_ni` lets codes that start with 9
    stand for themselves, for levels Northern Ireland lacks.
    """
    joined = attach(deciles.select(child, "imd_decile"), lookup.select(child, parent), child)
    if promote_ni:
        own = deciles.filter(has_prefix(child, ["9"])).select(child, "imd_decile", F.col(child).alias(parent))
        joined = joined.unionByName(own)
    top = F.when(F.col("imd_decile").isNull(), F.lit(None)).when(F.col("imd_decile") <= 2, "top").otherwise("other")
    counts = crosstab(joined.withColumn("__band", top), parent, "__band", ["top", "other"], missing=None)
    out = share(counts, "top", ["other"], "prop_top2deciles").withColumn("country", country_of(parent))
    if complete_only:
        out = out.dropna("any")
    if countries:
        out = out.filter(F.col("country").isin(list(countries)))
    return classify(out, "prop_top2deciles", "deprivation", classes, ["country"], **kw)


def settlement_summary(rural_urban: DataFrame, lookup: DataFrame | None, child: str, parent: str, classes: int = 3,
                       **kw) -> DataFrame:
    """Urban share per parent and its class per country.

    rural_urban: `child`, settlement (Urban / Rural / NULL) and, where areas
    are counted instead of labelled, n_urban, n_mixed, n_rural.
    """
    joined = rural_urban if lookup is None else attach(rural_urban, lookup.select(child, parent), child)
    parent = child if lookup is None else parent
    u, m, r = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_urban", "n_mixed", "n_rural"))
    sums = joined.withColumn("country", country_of(child)).groupBy("country", parent).agg(
        F.sum(F.when(F.col("settlement") == "Urban", 1).otherwise(0) + u).alias("urban"),
        F.sum(m).alias("mixed"),
        F.sum(F.when(F.col("settlement") == "Rural", 1).otherwise(0) + r).alias("rural"),
    )
    out = sums.withColumn("prop_urban", mixed_share("urban", "mixed", "rural"))
    return classify(out, "prop_urban", "settlement", classes, ["country"], **kw)


def rural_urban_uk(england_wales: DataFrame, scotland: DataFrame, northern_ireland: DataFrame) -> DataFrame:
    """Three settlement classifications in one shape.

    england_wales: lsoa11cd, ruc11cd. scotland: lsoa11cd, ur2fold.
    northern_ireland: lsoa11cd, urban, mixed, rural as text counts.
    """
    def number(c: str):
        return F.coalesce(to_integer(c), F.lit(0))

    return union_filled(
        england_wales.select("lsoa11cd", settlement_of_code("ruc11cd").alias("settlement"), F.lit(None).cast("int").alias("n_urban"),
                             F.lit(None).cast("int").alias("n_mixed"), F.lit(None).cast("int").alias("n_rural")),
        scotland.select("lsoa11cd", settlement_of_fold("ur2fold").alias("settlement")),
        northern_ireland.select("lsoa11cd", number("urban").alias("n_urban"), number("mixed").alias("n_mixed"),
                                number("rural").alias("n_rural")),
    )


def indicator_table(parts: Sequence[DataFrame], code: str, indicators: Sequence[str], deprivation: DataFrame,
                    settlement: DataFrame) -> DataFrame:
    """All nations' areas with their indicators, deprivation and settlement summaries."""
    picked = [p.select(code, *[c for c in indicators if c in p.columns]) for p in parts]
    dep = deprivation.select(code, "country", "prop_top2deciles", "deprivation_q")
    setl = settlement.select(code, "prop_urban", "settlement_q")
    return star(union_filled(*picked), (dep, code), (setl, code))


def service_lookup(lsoa_to_lad: DataFrame, lad_to_service: DataFrame) -> DataFrame:
    """Small area (lsoa11cd) to fire service area (fra17cd) through local authorities (lad17cd)."""
    return compose(lsoa_to_lad, lad_to_service, "lsoa11cd", "lad17cd", "fra17cd")
