"""Combined risk for all nations in one plan.

The nations differ in which indicators exist, how labels are ordered and what
stands for a missing class. Those differences are data (`NationSpec`); the
plan carries `country` as a key, so each table is read, classified and rolled
up once for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.functions.nulls import strict_min
from arearisk.functions.scalars import country_of, quintile_of_decile, reverse_half, two_class
from arearisk.operators.classify import class_of, natural_breaks, pivot_limits
from arearisk.operators.combine import NO_CLASS, clear_sentinel, combined_label, report
from arearisk.operators.hierarchy import Measure, roll_up_worst, worst_of
from arearisk.operators.joins import attach, star, union_filled
from arearisk.scratch import materialize

# Labels and report titles of the indicators.
LABELS = {
    "fires": "Fires",
    "floods": "Flooding",
    "displacement": "Displacement",
    "migrant_dest": "Migrant destitution",
    "lonely": "Loneliness",
    "health": "Health deprivation",
    "hle_birth": "Healthy life expectancy",
    "digital": "Digital exclusion",
    "alone": "Living alone",
    "imd": "IMD",
    "destitution": "All destitution",
}
TITLES = {
    "fires": "Fire risk",
    "floods": "Flooding risk",
    "displacement": "Displacement risk",
    "migrant_dest": "Migrant destitution risk",
    "lonely": "Loneliness risk",
    "health": "Health deprivation risk",
    "hle_birth": "Healthy life expectancy risk",
    "digital": "Digital exclusion risk",
    "alone": "Living alone risk",
    "imd": "Multiple deprivation risk",
    "destitution": "All destitution risk",
}
PRESENCE_TITLES = {
    "presence_services": "Services present?",
    "presence_shops": "Shops present?",
    "presence_props": "Properties present?",
}

# Raw column behind each indicator that is classified by natural breaks.
SMALL_VALUES = {"fires": "dens_fires", "floods": "n_people_flood", "lonely": "loneills_2018", "alone": "prop_alone"}
LAD_VALUES = {"displacement": "sec95", "hle_birth": "hle_birth", "digital": "digital_total_mult"}
ROLLED = ("fires", "floods", "lonely", "health", "alone", "imd")

MEASURES = (
    Measure("fires", "dens_fires", "fires_q", "max"),
    Measure("floods", "n_people_flood", "floods_q", "max"),
    Measure("lonely", "loneills_2018", "lonely_q", "max"),
    Measure("health", "worst_health_decile", "health_q", "min"),
    Measure("alone", "prop_alone", "alone_q", "ratio", ("n_one_person_hh", "n_lone_parents"), "n_people_total"),
    Measure("imd", "worst_imd_decile", "imd_q", "min"),
)


@dataclass(frozen=True)
class NationSpec:
    """What one nation has. Orders are those of its labels."""

    country: str
    small: tuple[str, ...]
    lad: tuple[str, ...]
    service: tuple[str, ...] = ()
    sentinel: int = NO_CLASS
    two_class_displacement: bool = False


# Indicator sets and label orders of the nations.
NATIONS = (
    NationSpec(
        "England",
        small=("fires", "floods", "lonely", "health", "alone", "imd"),
        lad=("fires", "floods", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
    ),
    NationSpec(
        "Wales",
        small=("floods", "lonely", "health", "alone", "imd"),
        lad=("floods", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
        service=("fires", "floods", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
    ),
    NationSpec(
        "Scotland",
        small=("fires", "lonely", "health", "alone", "imd"),
        lad=("fires", "displacement", "migrant_dest", "lonely", "health", "hle_birth", "digital", "alone", "imd", "destitution"),
    ),
    NationSpec(
        "Northern Ireland",
        small=("floods", "lonely", "health", "alone", "imd"),
        lad=("floods", "displacement", "health", "lonely", "hle_birth", "digital", "alone", "imd"),
        sentinel=0,
        two_class_displacement=True,
    ),
)


def _by_country(specs: Sequence[NationSpec], pick: Callable[[NationSpec], Column]) -> Column:
    out = None
    for s in specs:
        out = (F if out is None else out).when(F.col("country") == s.country, pick(s))
    return out


def _classes(df: DataFrame, limits: DataFrame, values: Mapping[str, tuple[str, str]], k: int) -> DataFrame:
    """Add `<name>_q` to `df`; `values` maps names to the indicator in `limits` and the column that is classified."""
    indicators = [i for i, _ in values.values()]
    out = attach(df, pivot_limits(limits.filter(F.col("indicator").isin(indicators)), "indicator", indicators, ["country"]), "country")
    for name, (i, col) in values.items():
        out = out.withColumn(f"{name}_q", class_of(F.col(col).cast("double"), F.col(f"{i}__n"), F.col(f"{i}__u"), k))
    return out.drop(*[f"{i}__{s}" for i in indicators for s in ("n", "u")])


def _long(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(country, indicator, value) rows of every table, the country read off its code."""
    return union_filled(*[
        t.select(country_of(code).alias("country"), F.lit(name).alias("indicator"), F.col(value).cast("double").alias("value"))
        for name, (t, code, value) in tables.items()
    ])


def deciles_by_area(deciles: DataFrame, lookup: DataFrame) -> DataFrame:
    """Most deprived small area of each neighbourhood, and its quintiles.

    deciles: lsoa, imd_decile, health_decile. lookup: lsoa, area_code.
    """
    joined = attach(deciles, lookup.select("lsoa", "area_code").distinct(), "lsoa")
    worst = joined.groupBy("area_code").agg(
        strict_min("health_decile").alias("worst_health_decile"), strict_min("imd_decile").alias("worst_imd_decile"))
    return worst.withColumns({
        "health_q": quintile_of_decile("worst_health_decile"), "imd_q": quintile_of_decile("worst_imd_decile")})


@dataclass
class Inputs:
    """Processed tables of all nations together.

    areas: area_code. fires: area_code, n_fires, n_people, dens_fires.
    floods: area_code, n_people_flood. loneliness: area_code, loneills_2018.
    alone: area_code, prop_alone, n_people_total, n_one_person_hh, n_lone_parents.
    deciles: lsoa, imd_decile, health_decile. lookup: lsoa, area_code,
    lad_code, lad_name, one row per smallest area. lad_successor: lad_code,
    lad19cd. displacement: lad19cd, sec95. digital: lad_code,
    digital_total_mult. life: lad_code, hle_birth. destitution: lad_code,
    destitution_all, destitution_migrant. presence: lad19cd, presence_*.
    service_lookup: lad_code, service_code, service_name.
    service_fires: service_code, dens_fires.
    """

    areas: DataFrame
    fires: DataFrame
    floods: DataFrame
    loneliness: DataFrame
    alone: DataFrame
    deciles: DataFrame
    lookup: DataFrame
    lad_successor: DataFrame
    displacement: DataFrame
    digital: DataFrame
    life: DataFrame
    destitution: DataFrame
    presence: DataFrame | None = None
    service_lookup: DataFrame | None = None
    service_fires: DataFrame | None = None
    specs: Sequence[NationSpec] = field(default=NATIONS)


def class_limits(inp: Inputs, k: int = 5, finder: Callable[..., DataFrame] = natural_breaks) -> DataFrame:
    """Class limits per (country, indicator) of all levels, found by one search and stored.

    No level's limits depend on another's results. The fire classes of service areas are `service_fires`.
    """
    specs = inp.specs
    tables = {
        "fires": (inp.fires, "area_code", "dens_fires"), "floods": (inp.floods, "area_code", "n_people_flood"),
        "lonely": (inp.loneliness, "area_code", "loneills_2018"), "alone": (inp.alone, "area_code", "prop_alone"),
        "displacement": (inp.displacement, "lad19cd", "sec95"), "hle_birth": (inp.life, "lad_code", "hle_birth"),
        "digital": (inp.digital, "lad_code", "digital_total_mult"),
    }
    wanted = {(s.country, i) for s in specs for i in s.small if i in SMALL_VALUES}
    wanted |= {(s.country, i) for s in specs for i in s.lad
               if i in LAD_VALUES and not (i == "displacement" and s.two_class_displacement)}
    if inp.service_fires is not None:
        tables["service_fires"] = (inp.service_fires, "service_code", "dens_fires")
        wanted |= {(s.country, "service_fires") for s in specs if s.service}
    pairs = F.concat_ws("|", "country", "indicator").isin(sorted(f"{c}|{i}" for c, i in wanted))
    return materialize(finder(_long(tables).filter(pairs), "value", k, ["country", "indicator"]), "class-limits")


def small_area_risks(inp: Inputs, k: int = 5, limits: DataFrame | None = None) -> DataFrame:
    """Indicators, classes (sentinel where missing) and combined label per neighbourhood."""
    specs = inp.specs
    limits = class_limits(inp, k) if limits is None else limits
    wide = star(
        inp.areas.select("area_code").withColumn("country", country_of("area_code")),
        (inp.fires, "area_code"), (inp.floods, "area_code"), (inp.loneliness, "area_code"),
        (inp.alone, "area_code"), (deciles_by_area(inp.deciles, inp.lookup), "area_code"),
    )
    out = _classes(wide, limits, {i: (i, c) for i, c in SMALL_VALUES.items()}, k)
    # An indicator a nation lacks stays missing; one it has gets the nation's sentinel.
    out = out.withColumns({
        f"{i}_q": _by_country(specs, lambda s, i=i: F.coalesce(F.col(f"{i}_q"), F.lit(s.sentinel)) if i in s.small
                              else F.lit(None).cast("int"))
        for i in ROLLED
    })
    label = _by_country(specs, lambda s: combined_label([(f"{i}_q", LABELS[i]) for i in s.small]))
    return out.withColumn("combined_risk", label)


def _lad_class(i: str) -> str:
    return f"worst_{i}_q" if i in ROLLED else f"{i}_q"


def lad_risks(small: DataFrame, inp: Inputs, k: int = 5, weight: str = "children", limits: DataFrame | None = None) -> DataFrame:
    """Worst neighbourhoods per local authority with the authority-level indicators and label."""
    specs = inp.specs
    rolled = roll_up_worst(small, inp.lookup, "area_code", "lad_code", MEASURES, weight, keep=["country"])
    joined = attach(rolled, inp.lad_successor.select("lad_code", "lad19cd"), "lad_code")
    joined = joined.withColumn("join19", F.when(F.col("country") == "Northern Ireland", F.col("lad_code")).otherwise(F.col("lad19cd")))
    reversed_ = inp.destitution.withColumns({
        "destitution_q": reverse_half("destitution_all", k), "migrant_dest_q": reverse_half("destitution_migrant", k)})
    wide = star(joined, (inp.displacement, {"join19": "lad19cd"}), (inp.digital, "lad_code"), (inp.life, "lad_code"),
                (reversed_, "lad_code"))
    limits = class_limits(inp, k) if limits is None else limits
    out = _classes(wide, limits, {i: (i, c) for i, c in LAD_VALUES.items()}, k)
    out = out.withColumn("displacement_q", _by_country(
        specs, lambda s: two_class("sec95") if s.two_class_displacement else F.col("displacement_q")))
    label = _by_country(specs, lambda s: combined_label([(_lad_class(i), LABELS[i]) for i in s.lad]))
    out = out.withColumn("combined_risk", label)
    out = attach(out, inp.lookup.select("lad_code", "lad_name").distinct(), "lad_code")
    if inp.presence is not None:
        out = attach(out, inp.presence, {"join19": "lad19cd"})
    return out.drop("join19")


def service_risks(lads: DataFrame, inp: Inputs, k: int = 5, limits: DataFrame | None = None) -> DataFrame:
    """Worst local authority classes per fire service area, with the service's own fire class."""
    specs = [s for s in inp.specs if s.service]
    own = [i for i in specs[0].service if i != "fires"]
    measures = [Measure(i, None, _lad_class(i)) for i in own]
    joined = attach(lads.filter(F.col("country").isin([s.country for s in specs])),
                    inp.service_lookup.select("lad_code", "service_code"), "lad_code")
    rolled = worst_of(joined, ["country", "service_code"], measures, with_medians=False)
    wide = attach(rolled, inp.service_fires.select("service_code", "dens_fires"), "service_code")
    limits = class_limits(inp, k) if limits is None else limits
    out = _classes(wide, limits, {"fires": ("service_fires", "dens_fires")}, k)
    label = _by_country(specs, lambda s: combined_label(
        [("fires_q" if i == "fires" else f"worst_{i}_q", LABELS[i]) for i in s.service]))
    out = out.withColumn("combined_risk", label)
    return attach(out, inp.service_lookup.select("service_code", "service_name").distinct(), "service_code")


def nation_report(lads: DataFrame, spec: NationSpec, skip_zero: bool = False) -> DataFrame:
    """Readable, ordered table of one nation's local authorities."""
    flags = [(c, t) for c, t in PRESENCE_TITLES.items() if c in lads.columns]
    columns = [("lad_code", "Local Authority code"), ("lad_name", "Local Authority"),
               *[(_lad_class(i), TITLES[i]) for i in spec.lad], *flags, ("combined_risk", "Combined risk")]
    return report(lads.filter(F.col("country") == spec.country), columns, [_lad_class(i) for i in spec.lad], skip_zero)


def run_nations(inp: Inputs, k: int = 5, weight: str = "children") -> dict[str, DataFrame]:
    """All levels with the sentinel cleared: `small`, `lad` and, where given, `service`."""
    limits = class_limits(inp, k)
    small = materialize(small_area_risks(inp, k, limits), "small-area-risks")
    lad = materialize(lad_risks(small, inp, k, weight, limits), "lad-risks")
    out = {"small": clear_sentinel(small), "lad": clear_sentinel(lad)}
    if inp.service_lookup is not None and inp.service_fires is not None:
        out["service"] = clear_sentinel(service_risks(lad, inp, k, limits))
    return out
