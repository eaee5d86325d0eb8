"""Scalar expressions on codes, names, dates, ratings and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.functions.nulls import _col, is_member, ratio

# Country by the first letter of an area code.
COUNTRY_LETTERS = {
    "England": ["E"],
    "Wales": ["W"],
    "Scotland": ["S"],
    "Northern Ireland": ["N", "9"],
}

# Settlement codes counted as urban and as rural.
URBAN_CODES = ["A1", "B1", "C1", "C2"]
RURAL_CODES = ["D1", "D2", "E1", "E2", "F1", "F2"]

# Prefixes and codes of areas that are not local authorities.
COUNTY_PREFIXES = ["E10", "E11"]
REGION_PREFIXES = ["E12"]
COUNTRY_CODES = ["K02000001", "E92000001", "W92000004", "S92000003", "N92000002"]


def country_of(code: Column | str) -> Column:
    """Country name from an area code; empty text for anything unknown or missing."""
    first = F.substring(_col(code), 1, 1)
    out = None
    for name, letters in COUNTRY_LETTERS.items():
        out = (F if out is None else out).when(first.isin(letters), F.lit(name))
    return out.otherwise(F.lit(""))


def has_prefix(code: Column | str, prefixes: list[str]) -> Column:
    """True where the code starts with one of the prefixes; missing codes stay missing."""
    cond = None
    for p in prefixes:
        one = _col(code).startswith(p)
        cond = one if cond is None else cond | one
    return cond


def area_kind(code: Column | str) -> Column:
    """county / region / country / local authority, so that one table can be split by kind."""
    head = F.substring(_col(code), 1, 3)
    return (
        F.when(is_member(head, COUNTY_PREFIXES), "county")
        .when(is_member(head, REGION_PREFIXES), "region")
        .when(is_member(code, COUNTRY_CODES), "country")
        .otherwise("local authority")
    )


def looks_like_code(text: Column | str, pattern: str = "[A-Z][0-9]+") -> Column:
    """Unanchored pattern test: footnotes and titles fail it."""
    return _col(text).rlike(pattern)


def repair_code(description: Column | str, code: Column | str, pattern: str = "E[0-9]+") -> Column:
    """Take the description where it holds the code; a missing description loses the code."""
    d, c = _col(description), _col(code)
    return F.when(d.isNull(), F.lit(None)).when(d.rlike(pattern), d).otherwise(c)


def to_integer(text: Column | str) -> Column:
    """Integer from text: '3.7' gives 3, anything unreadable gives NULL."""
    return _col(text).cast("string").try_cast("double").try_cast("int")


def rating(text: Column | str, marker: str = "#") -> Column:
    """Integer rating written as marker + number; only a leading marker is removed."""
    return to_integer(F.regexp_replace(_col(text), f"^{marker}", ""))


def harmonise_name(name: Column | str, suffix: str) -> Column:
    """Spell names as the lookup does: add its suffix and write '&' as 'and'."""
    return F.regexp_replace(F.concat(_col(name), F.lit(suffix)), "&", "and")


def parse_period(text: Column | str, pattern: str = "d MMM yyyy") -> Column:
    """Date from text; unreadable text gives NULL."""
    return F.try_to_timestamp(_col(text), F.lit(pattern)).cast("date")


def quintile_of_decile(decile: Column | str) -> Column:
    """{1,2} -> 1 ... {9,10} -> 5; anything else is missing."""
    d = _col(decile)
    return F.when(d.isin(list(range(1, 11))), F.ceil(d / 2).cast("int"))


def reverse_half(score: Column | str, classes: int = 5) -> Column:
    """Halve, round up and reverse, so that the highest score becomes class 1."""
    return (F.lit(classes + 1) - F.ceil(_col(score) / 2)).cast("int")


def two_class(value: Column | str, low: int = 5, high: int = 1) -> Column:
    """Class `high` for any positive value, `low` for zero."""
    v = _col(value)
    return F.when(v.isNull(), F.lit(None).cast("int")).when(v > 0, F.lit(high)).otherwise(F.lit(low))


def settlement_of_code(code: Column | str) -> Column:
    """Urban / Rural from a ten-way settlement code."""
    return F.when(_col(code).isin(URBAN_CODES), "Urban").when(_col(code).isin(RURAL_CODES), "Rural")


def settlement_of_fold(fold: Column | str) -> Column:
    """Urban / Rural from a two-fold classification (1 = urban)."""
    f = _col(fold)
    return F.when(f.isNull(), F.lit(None)).when(f == 1, "Urban").otherwise("Rural")


def mixed_share(urban: Column | str, mixed: Column | str, rural: Column | str) -> Column:
    """Urban share when mixed areas count half."""
    u, m, r = _col(urban), _col(mixed), _col(rural)
    return ratio(u + m / 2, u + m + r)


# Text and order of the labels built from two classes.
DEPRIVATION_WORDS = {10: "Least deprived", 1: "Most deprived"}
SETTLEMENT_WORDS = {3: "mostly rural", 2: "mixed rural/urban", 1: "mostly urban"}
CORNER_WORDS = {0: "no deprivation", 1: "full deprivation"}


def class_pair_label(deprivation: Column | str, settlement: Column | str) -> tuple[Column, Column]:
    """Label for (deprivation class, settlement class) and its sort position."""
    d, s = _col(deprivation), _col(settlement)
    label, order, pos = None, None, 0
    for dk, dw in DEPRIVATION_WORDS.items():
        for sk, sw in SETTLEMENT_WORDS.items():
            pos += 1
            hit = (d == dk) & (s == sk)
            label = (F if label is None else label).when(hit, f"{dw}, {sw}")
            order = (F if order is None else order).when(hit, F.lit(pos))
    return label, order


def corner_label(deprived_share: Column | str, urban_share: Column | str) -> Column:
    """Label of the four corners of a deprivation x settlement grid."""
    d, u = _col(deprived_share), _col(urban_share)
    out = None
    for dk, dw in CORNER_WORDS.items():
        for uk, uw in ((0, "Rural"), (1, "Urban")):
            out = (F if out is None else out).when((d == dk) & (u == uk), f"{uw}, {dw}")
    return out


def map_numeric(df: DataFrame, fn, skip: tuple[str, ...] = ()) -> DataFrame:
    """Apply a column function to every numeric column."""
    return df.select(*[
        fn(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.NumericType) and f.name not in skip else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def columns_starting(df: DataFrame, *prefixes: str) -> list[str]:
    """Column names by prefix, ignoring case."""
    return [c for c in df.columns if c.lower().startswith(tuple(p.lower() for p in prefixes))]


def columns_ending(df: DataFrame, *suffixes: str) -> list[str]:
    """Column names by suffix, ignoring case."""
    return [c for c in df.columns if c.lower().endswith(tuple(s.lower() for s in suffixes))]


def recode(df: DataFrame, cols: list[str], old, new) -> DataFrame:
    """Replace one value by another in several columns."""
    return df.withColumns({c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)) for c in cols})


def columns_first(df: DataFrame, *first: str) -> DataFrame:
    """Move columns to the front, keep the rest in order."""
    return df.select(*first, *[c for c in df.columns if c not in first])
