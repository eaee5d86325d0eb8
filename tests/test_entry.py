"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUICK = [
    "area_rate_rollup", "strict_vs_skip_aggs", "median_weighted", "code_repair", "latest_period", "code_succession", "code_audit",
    "fill_down", "top_n_ties", "crosstab_share", "natural_breaks_grouped", "combined_label", "inequality_summary",
    "point_in_polygon", "ols_interaction", "fires_england_area", "geojson_polygons",
]


def norm(v):
    return v + 0.0 if isinstance(v, float) else v


def ordered(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return c


def test_every_sql_text_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUICK) <= set(entry.oracle_sql())


def test_flagship_query_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_sql(spark, con, sf, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = ordered([tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()])
    assert ordered([tuple(norm(r[c]) for c in cols) for r in df.collect()]) == want


def test_scans_read_only_what_is_needed(spark, sf):
    """Column pruning and filters reach the scans of the flagship query."""
    plan = entry.queries()["area_rate_rollup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
