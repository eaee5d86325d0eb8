import csv
import io
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from arearisk.config import Catalogue
from arearisk.plans.datasets import digital_exclusion, healthy_life_expectancy
from arearisk.scratch import materialize, release
from arearisk.sources import readers as R
from arearisk.sources import writers as W
from tests.conftest import rows


def test_csv_reads_na_and_blanks_as_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,name,x\nE1,NA,1.5\nE2,,NA\n")
    schema = R.typed_schema(["code", "name", "x"], overrides={"code": T.StringType(), "name": T.StringType()})
    assert rows(R.read_csv(spark, str(tmp_path / "a.csv"), schema)) == [("E1", None, 1.5), ("E2", None, None)]


def test_csv_writes_missing_as_na(spark, tmp_path):
    W.write_csv(spark.createDataFrame([("E1", None)], "code string, `Combined risk` string").coalesce(1), str(tmp_path / "o"))
    text = "".join(p.read_text() for p in (tmp_path / "o").glob("*.csv"))
    assert text.split() == ["code,Combined", "risk", "E1,NA"]


def test_sheets_skip_titles_keep_order_and_take_columns_by_header(spark, tmp_path):
    (tmp_path / "north.csv").write_text('Title\n\n"Area Codes",Notes,HLE\nE1,"a, b",60.5\nE2,,\n\n1 footnote,,\n')
    (tmp_path / "south.csv").write_text("Title\r\n\r\nArea Codes,Notes,HLE\r\nS1,x,NA\r\nS2,x,7\r\n")
    got = rows(R.read_sheets(spark, str(tmp_path), {"HLE": ("hle", T.DoubleType()), "Area Codes": ("code", T.StringType())}, skip=2))
    assert got == [("north", 1, 60.5, "E1"), ("north", 2, None, "E2"), ("north", 4, None, "1 footnote"),
                   ("south", 1, None, "S1"), ("south", 2, 7.0, "S2")]
    with pytest.raises(ValueError, match="not in the sheet header"):
        R.read_sheets(spark, str(tmp_path), {"Nope": ("n", T.StringType())}, skip=2)


def plain_sheet(text, skip, separator=","):
    """(row number, cells) of a file read as a whole."""
    lines = io.StringIO(text.removeprefix("\ufeff"), newline="\n").readlines()[skip:]
    table = list(csv.reader(lines, delimiter=separator))
    return table[0], [(i, r) for i, r in enumerate(table[1:], 1) if any(c.strip() for c in r)]


@pytest.mark.parametrize("split", [64, 300, 1 << 20])
def test_a_sheet_is_read_by_many_tasks(spark, tmp_path, split):
    """Line ends, quotes and separators in cells across splits, stray quotes, an open cell at the end."""
    rng = random.Random(7)
    cells = ["", "plain", "a, b", 'two "" quotes', "line\nend", "crlf\r\nend", '5" pipe', "x" * 90, "é\n\n" * 30, " ", '"', "\n"]
    for name, order in (("a", [0, 1, 2]), ("b", [2, 0, 1])):
        out = ["Title", ""]
        out.append(",".join(['"Area, Code"', "Notes", "HLE"][i] for i in order))
        for i in range(150):
            row = [f"E{i}", rng.choice(cells), str(i / 4)]
            row = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',\n"') and c != '5" pipe' else c for c in row]
            out.append("" if i % 17 == 3 else ",".join(row[j] for j in order))
        text = ("\ufeff" if name == "a" else "") + "\n".join(out) + ('\nE9,"open, to the\nend' if name == "a" else "\n")
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = R.read_sheets(spark, str(tmp_path), {"Area, Code": ("code", T.StringType()), "Notes": ("notes", T.StringType()),
                                                  "HLE": ("hle", T.DoubleType())}, skip=2)
        assert split > 1000 or df.rdd.getNumPartitions() > 30
        got = sorted((r["sheet"], r["row_no"], r["code"], r["notes"], r["hle"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for name in "ab":
        head, table = plain_sheet((tmp_path / f"{name}.csv").read_bytes().decode(), 2)
        at = [head.index(c) for c in ("Area, Code", "Notes", "HLE")]
        for i, r in table:
            code, notes, hle = (r[p] if p < len(r) and r[p] else None for p in at)
            want.append((name, i, code, notes, float(hle) if hle else None))
    assert got == sorted(want)


@given(st.lists(st.sampled_from(['"', ",", "a", "\r"]), max_size=12), st.booleans())
def test_cells_open_and_close_as_the_parser_says(line, inside):
    """An open cell takes the next line into its record."""
    text = ('"' if inside else "") + "".join(line).replace("\r", "x") + "\n"
    ends = len(list(csv.reader([text, "z\n"]))) == 1
    assert R._ends_open("".join(line).replace("\r", "x"), inside, ",") == ends


def test_a_sheet_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Title\n\n")
    with pytest.raises(ValueError, match="no header row"):
        R.read_sheets(spark, str(tmp_path), {"HLE": ("hle", T.DoubleType())}, skip=2)


def test_filled_sheets_to_life_expectancy(spark, tmp_path):
    (tmp_path / "m.csv").write_text("code,HLE\nE06000001,60\nE06000002,\nE10000001,64\n,\n1 note,\n")
    (tmp_path / "f.csv").write_text("code,HLE\nE06000001,62\nE10000001,66\n")
    cols = {"code": ("code", T.StringType()), "HLE": ("hle", T.DoubleType())}
    m, f = (R.read_sheets(spark, str(tmp_path / n), cols) for n in ("m.csv", "f.csv"))
    got = rows(healthy_life_expectancy(m, f, m, f), "code", "hle_birth", "hle_65", "area_kind")
    assert got == [("E06000001", 61.0, 61.0, "local authority"), ("E06000002", None, None, "local authority"), ("E10000001", 65.0, 65.0, "county")]


def test_placemarks_with_namespace_join_on_name_not_position(spark, tmp_path):
    def kml(pairs):
        marks = "".join(f"<Placemark><name>{n}</name><styleUrl>{s}</styleUrl></Placemark>" for n, s in pairs)
        return f'<?xml version="1.0"?><kml xmlns="http://example.org/kml"><Document><Folder><name>folder</name>{marks}</Folder></Document></kml>'

    paths = {}
    for metric, pairs in {"infrastructure": [("A", "#3"), ("B", "#1")], "access": [("B", "#2"), ("A", "#4")],
                          "skill": [("A", "#5"), ("B", "#x")], "use": [("A", "#1"), ("B", "#1")]}.items():
        paths[metric] = str(tmp_path / f"{metric}.xml")
        (tmp_path / f"{metric}.xml").write_text(kml(pairs))
    got = rows(digital_exclusion(R.read_placemarks(spark, paths)))
    assert got == [("A", 3, 4, 5, 1, 13, 60), ("B", 1, 2, None, 1, None, None)]


FEATURES = [
    {"type": "Feature", "properties": {"lad": "E1"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
    {"type": "Feature", "properties": {"lad": "E2"}, "geometry": {"type": "MultiPolygon", "coordinates": [
        [[[0, 0], [2, 0], [2, 2], [0, 0]], [[0.5, 0.1], [1, 0.1], [1, 0.5], [0.5, 0.1]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
]


@pytest.mark.parametrize("layout", ["lines", "document"])
def test_geojson_layers(spark, tmp_path, layout):
    body = ",\n".join(json.dumps(f) for f in FEATURES)
    text = '{"type": "FeatureCollection",\n"features": [\n' + body + "\n]}\n"
    if layout == "document":
        text = json.dumps(json.loads(text), indent=1)
    (tmp_path / "l.geojson").write_text(text)
    got = {r["lad"]: r["rings"] for r in R.read_polygons(spark, str(tmp_path / "l.geojson"), R.typed_schema(["lad"], T.StringType()), layout).collect()}
    assert [len(r) for r in got["E1"]] == [4] and [len(r) for r in got["E2"]] == [4, 4, 4]
    assert got["E2"][2][1] == [6.0, 5.0]


def test_geojson_points(spark, tmp_path):
    f = {"type": "Feature", "properties": {"FID": 7}, "geometry": {"type": "Point", "coordinates": [-1.5, 53.25]}}
    (tmp_path / "p.geojson").write_text('{"type": "FeatureCollection", "features": [\n' + json.dumps(f) + "\n]}")
    assert rows(R.read_points(spark, str(tmp_path / "p.geojson"), R.typed_schema(["FID"], T.LongType()))) == [(7, -1.5, 53.25)]


def test_portal_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"Area_Code": "W1", "Data": 3.0, "Other": "x"}\n{"Area_Code": "W2"}\n')
    got = rows(R.read_records(spark, str(tmp_path / "r.json"), R.typed_schema(["Area_Code", "Data"], overrides={"Area_Code": T.StringType()})))
    assert got == [("W1", 3.0), ("W2", None)]


def test_columns_named_from_a_description_table(spark):
    data = spark.createDataFrame([("95AA01", 10, 3)], "code string, QS0001 int, QS0002 int")
    names = spark.createDataFrame([("QS0001", "All usual residents in households"), ("QS0002", "One person household: Total")], "c string, d string")
    assert R.rename_from_descriptions(data, names, "c", "d").columns == ["code", "All usual residents in households", "One person household: Total"]


def test_report_has_one_sheet_per_nation(spark, tmp_path):
    a, b = spark.createDataFrame([("E1", 1)], "a string, q int"), spark.createDataFrame([("W1",)], "a string")
    W.write_report({"England": a, "Wales": b}, str(tmp_path / "r"))
    W.write_report({"England": a, "Wales": b}, str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("sheet=*")) == ["sheet=England", "sheet=Wales"]
    assert sum(len(list(p.glob("*.csv"))) for p in (tmp_path / "r").glob("sheet=*")) == 2


def test_stored_tables_are_released(spark):
    stored = materialize(spark.range(5).toDF("x"), "probe")
    assert stored.count() == 5 and release(spark) >= 1 and release(spark) == 0


def test_catalogue_paths():
    c = Catalogue("/d/", "/o")
    assert (c.raw("census", "x.csv"), c.processed("f"), c.output("r")) == ("/d/raw/census/x.csv", "/d/processed/f", "/o/r")


def test_sheets_with_other_column_orders_and_quoted_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text('code,n\nE1,1\n"E\n2",2\n')
    (tmp_path / "b.csv").write_text("n,extra,code\n7,x,S1\n")
    cols = {"code": ("code", T.StringType()), "n": ("n", T.LongType())}
    assert rows(R.read_sheets(spark, str(tmp_path), cols), "sheet", "code", "n") == [("a", "E\n2", 2), ("a", "E1", 1), ("b", "S1", 7)]
    (tmp_path / "c.csv").write_text("code,other\nW1,1\n")
    with pytest.raises(ValueError, match="not in the sheet header"):
        R.read_sheets(spark, str(tmp_path), cols)


def test_a_collection_is_not_read_as_lines(spark, tmp_path):
    one = '{"type": "Feature", "properties": {"id": "%s"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}'
    schema = T.StructType([T.StructField("id", T.StringType())])
    good = tmp_path / "good.geojson"
    good.write_text('{\n"type": "FeatureCollection",\n"features": [\n' + one % "a" + ",\n" + one % "b" + "\n]\n}\n")
    assert rows(R.read_points(spark, str(good), schema)) == [("a", 1.0, 2.0), ("b", 1.0, 2.0)]
    whole = tmp_path / "whole.geojson"
    whole.write_text('{"type": "FeatureCollection", "features": [' + one % "a" + ", " + one % "b" + "]}\n")
    assert rows(R.read_points(spark, str(whole), schema, "document")) == [("a", 1.0, 2.0), ("b", 1.0, 2.0)]
    with pytest.raises(Exception, match="not a feature"):
        R.read_points(spark, str(whole), schema).collect()
    broken = tmp_path / "broken.geojson"
    broken.write_text(one % "a" + "\n" + (one % "b")[:-20] + "\n")
    with pytest.raises(Exception, match="not a feature"):
        R.read_points(spark, str(broken), schema).collect()


def test_every_description_counts(spark):
    df = spark.createDataFrame([(1, 2)], "c11999 int, c2 int")
    named = spark.range(12_000).selectExpr("concat('c', id) AS code", "concat('name ', id) AS label")
    assert R.rename_from_descriptions(df, named, "code", "label").columns == ["name 11999", "name 2"]
    twice = named.union(spark.createDataFrame([("c2", "other")], "code string, label string"))
    with pytest.raises(ValueError, match="more than one description"):
        R.rename_from_descriptions(df, twice, "code", "label")
