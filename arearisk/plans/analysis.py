"""Inequality tables and models over the nations' combined risks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.functions.scalars import class_pair_label, corner_label
from arearisk.operators import inequality as I
from arearisk.operators import models as M
from arearisk.operators import profile as P
from arearisk.operators.joins import grid
from arearisk.operators.reshape import top_n
from arearisk.scratch import materialize

# Reported indicators, their columns and which end is bad.
INDICATORS = {
    "Asylum seekers receiving support": ("sec95", "max"),
    "Migrant destitution": ("destitution_migrant", "max"),
    "Healthy life expectancy": ("hle_birth", "min"),
    "Digital exclusion": ("digital_total_mult", "max"),
    "Destitution": ("destitution_all", "max"),
    "Dwelling fires": ("worst_fires", "max"),
    "Flooding": ("worst_floods", "max"),
    "Loneliness": ("worst_lonely", "max"),
    "Living alone": ("worst_alone", "max"),
}
DOMAINS = {"Deprivation": "deprivation_q", "Rural-urban classification": "settlement_q"}
ENDS = [("Deprivation", 1, 10), ("Rural-urban classification", 1, 3)]
PRIOR_SD = 5.0


def inequality_tables(uk_lad: DataFrame) -> dict[str, DataFrame]:
    """Worst values per class, their ranges with end-to-end gaps, and the list of indicators."""
    long = materialize(I.extremes(uk_lad, "country", DOMAINS, INDICATORS), "inequality")
    return {
        "extremes": long.orderBy("country", "domain", "domain_value"),
        "summary": I.summary(long, ENDS),
        "indicators": I.indicator_list(long),
    }


def outcome_frame(areas: DataFrame, code: str, y: str) -> DataFrame:
    """Complete rows of one outcome with its two explanations."""
    cols = ["country", code, "deprivation_q", "prop_top2deciles", "settlement_q", "prop_urban", y]
    return areas.select(*cols).dropna("any")


def describe(df: DataFrame, y: str, width: float, centre: str = "median") -> dict[str, DataFrame]:
    """Distribution tables by country, and by country and deprivation class."""
    label, order = class_pair_label("deprivation_q", "settlement_q")
    ends = df.filter(F.col("deprivation_q").isin(1, 10)).withColumns({"label": label, "label_order": order})
    return {
        "histogram": P.histogram(df, y, width, ["country"]),
        **{f"summary_{c}": P.six_numbers(df, c, ["country"]) for c in (y, "prop_top2deciles", "prop_urban")},
        "box": P.box(df, y, ["country", "deprivation_q"]),
        "spread": P.spread(df, y, ["country"], centre),
        "spread_by_class": P.spread(ends, y, ["country", "label", "label_order"], centre),
        "total": P.totals(df, y, ["country"]),
        "largest": top_n(df, ["country"], y, 1),
    }


def _crossed(df: DataFrame, *numeric: str) -> M.Terms:
    terms = M.numeric_term(numeric[0])
    for n in numeric[1:]:
        terms = M.crossed(terms, M.numeric_term(n))
    return M.crossed(terms, M.factor_terms("country", M.levels_of(df, "country")))


def linear_models(df: DataFrame, y: str, both: bool = False) -> dict[str, DataFrame]:
    """Country means, share x country models with priors, their bands, and with `both` the joint model."""
    spark, df = df.sparkSession, materialize(df, "model-rows")
    models = {"by_country": M.factor_terms("country", M.levels_of(df, "country")),
              "deprivation": _crossed(df, "prop_top2deciles"), "settlement": _crossed(df, "prop_urban")}
    if both:
        models["both"] = _crossed(df, "prop_top2deciles", "prop_urban")
    # One scan for all models; outcome frames are complete, so all have the same rows anyhow.
    sums = M.gram(df, y, {t: c for terms in models.values() for t, c in terms.items()})
    plain = {name: M.solve_linear(sums.pick(list(terms))) for name, terms in models.items()}
    out = {"by_country": plain["by_country"].coefficients(spark)}
    for name, x in (("deprivation", "prop_top2deciles"), ("settlement", "prop_urban")):
        fit = M.solve_linear(sums.pick(list(models[name])), PRIOR_SD)
        out[f"{name}_least_squares"] = plain[name].coefficients(spark)
        out[f"{name}_fit"] = plain[name].glance(spark)
        out[f"{name}_posterior"] = fit.coefficients(spark)
        out[f"{name}_band"] = M.predict_band(fit, grid(df.select("country"), x), models[name])
    if both:
        corners = grid(grid(df.select("country"), "prop_urban", 1), "prop_top2deciles", 1)
        fit = M.solve_linear(sums.pick(list(models["both"])), PRIOR_SD)
        out["both_band"] = M.predict_band(fit, corners, models["both"]).withColumn(
            "label", corner_label("prop_top2deciles", "prop_urban"))
        out["comparison"] = M.compare_loo(df, y, {name: models[name] for name in ("deprivation", "settlement", "both")})
    return out


def count_models(df: DataFrame, y: str) -> dict[str, DataFrame]:
    """Rate ratios between countries, and share x country models of the counts."""
    spark, df = df.sparkSession, materialize(df, "model-rows")
    country = M.factor_terms("country", M.levels_of(df, "country"))
    by_country = M.fit_negative_binomial(df, y, country)
    out = {
        "poisson_by_country": M.fit_poisson(df, y, country).coefficients(spark),
        "by_country": by_country.coefficients(spark),
        "zeros": M.zero_share(df, y, country, by_country),
    }
    for name, x in (("deprivation", "prop_top2deciles"), ("settlement", "prop_urban")):
        terms = _crossed(df, x)
        fit = M.fit_negative_binomial(df, y, terms)
        out[name] = fit.coefficients(spark)
        out[f"{name}_band"] = M.count_band(fit, grid(df.select("country"), x), terms)
    return out


def nation_analysis(uk_lad: DataFrame, uk_areas: DataFrame, outcomes: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Every table of the analysis by name; `outcomes` limits the modelled ones."""
    out = {f"inequality_{k}": v for k, v in inequality_tables(uk_lad).items()}
    plans = {
        "life": (uk_lad, "lad_code", "hle_birth", 1.0, "median"),
        "flood": (uk_areas, "area_code", "n_people_flood", 100.0, "median"),
        "support": (uk_lad, "lad_code", "sec95", 20.0, "median"),
        "lonely": (uk_areas, "area_code", "loneills_2018", 1.0, "mean"),
    }
    for name, (areas, code, y, width, centre) in plans.items():
        if outcomes is not None and name not in outcomes:
            continue
        rows = materialize(outcome_frame(areas, code, y), f"outcome-{name}")
        parts = describe(rows, y, width, centre)
        parts |= count_models(rows, y) if name == "support" else linear_models(rows, y, both=name == "life")
        out |= {f"{name}_{k}": v for k, v in parts.items()}
    return out
