"""Readers for staged inputs: CSV, worksheets, XML placemarks, GeoJSON layers, portal records.

Schemas are always declared; nothing is inferred from data.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA = "NA"


def typed_schema(cols: Sequence[str], default: T.DataType | None = None,
                 overrides: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """One type for all columns but the named ones."""
    overrides = overrides or {}
    return T.StructType([T.StructField(c, overrides.get(c, default or T.DoubleType())) for c in cols])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header row; `NA` and empty fields are missing."""
    return spark.read.schema(schema).option("header", True).option("nullValue", NA).csv(path)


def read_sheets(spark: SparkSession, path: str | list[str], columns: Mapping[str, tuple[str, T.DataType]],
                skip: int = 0, separator: str = ",", tag: str = "file") -> DataFrame:
    """Worksheets staged as CSV files, with `skip` title rows above the header; large files are read by many tasks.

    `columns` maps header texts to (name, type). Adds `sheet`, the name of the file without its ending (or of its
    folder, with `tag="folder"`), and `row_no`, the row order a worksheet has: records of a file below its header,
    blank ones included. Columns are found by the header of each file, so their order may differ; a file without one
    of them is an error. Quoted cells may hold line ends, also across splits.

    A first pass scans every split for both ways it may begin, inside a quoted cell or not, and gives how it ends and
    how many records end in it. Put together in the order of the splits this says how each begins and its first record
    number: one small row per split reaches the driver and goes out with the second pass, in which every split parses
    its own records. Records that cross splits are put together from their fragments.
    """
    name = {"file": F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""),
            "folder": F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)}[tag]
    wanted = list(columns)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        name.alias("sheet"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    splits = lines.mapInArrow(_scan_splits(skip, separator), _SPLIT).collect()
    heads = {r["path"]: r["header"] for r in splits if r["start"] == 0}
    if not heads or any(h is None for h in heads.values()):
        raise ValueError(f"no header row after {skip} title rows in {path}")
    if missing := sorted({c for h in heads.values() for c in wanted if c not in h}):
        raise ValueError(f"columns not in the sheet header: {missing}")
    places = {p: [h.index(c) for c in wanted] for p, h in heads.items()}
    begins, crossed = _beginnings(splits)
    rows = lines.mapInArrow(_split_records(skip, separator, places, begins),
                            "sheet string, path string, number long, start long, cells array<string>, fragment string")
    records = rows.filter("fragment IS NULL").select("sheet", "number", "cells")
    if crossed:
        # Rare, so reading once more for the fragments costs less than storing all records would.
        parts = F.transform(F.array_sort(F.collect_list(F.struct("start", "fragment"))), lambda p: p["fragment"])
        crossing = rows.filter("fragment IS NOT NULL").groupBy("sheet", "path", "number").agg(F.array_join(parts, "\n").alias("value"))
        records = records.unionByName(crossing.mapInArrow(
            _joined_records(separator, places), "sheet string, number long, cells array<string>"))

    def cell(place: int, name: str, kind: T.DataType):
        raw = F.nullif(F.get("cells", F.lit(place)), F.lit(""))
        raw = F.when(raw != NA, raw)
        return (raw if isinstance(kind, T.StringType) else raw.try_cast(kind)).alias(name)

    # The header is the first record.
    return records.select("sheet", (F.col("number") - 1).alias("row_no"), *[cell(i, n, t) for i, (n, t) in enumerate(columns.values())])


_SPLIT = "path string, start long, header array<string>, outside_open boolean, outside_records long, inside_open boolean, inside_records long"


def _ends_open(line: str, inside: bool, separator: str) -> bool:
    """Whether a line ends inside a quoted cell. A quote opens a cell only where the cell begins; two are one of its text."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line.startswith('"', at):
                at += 1
            else:
                at = line.find(separator, at) + 1
                if not at:
                    return False
                continue
        at = line.find('"', at)
        if at < 0:
            return True
        inside = line.startswith('""', at)
        if inside:
            at += 2
        else:
            at = line.find(separator, at) + 1
            if not at:
                return False


def _split_lines(batches: Iterator[pa.RecordBatch], skip: int) -> Iterator[tuple[str, str, int, str | None]]:
    """(sheet, path, start of the split, line), the line None for a title row and without a mark of byte order."""
    last, left = None, 0
    for batch in batches:
        for sheet, path, start, line in zip(*(batch.column(c).to_pylist() for c in ("sheet", "path", "start", "value"))):
            if (path, start) != last:
                if left:
                    raise ValueError(f"the {skip} title rows of {last[0]} go beyond the first split")
                last, left = (path, start), skip if start == 0 else 0
                if start == 0:
                    line = line.removeprefix("\ufeff")
            yield sheet, path, start, None if left else line
            left -= left > 0


def _scan_splits(skip: int, separator: str):
    """One row per split: its header if a file begins there, and its end for both ways it may begin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for _, path, start, line in _split_lines(batches, skip):
            own = found.get((path, start))
            if own is None:
                # Header so far, whether it is whole, then state and records for a start outside and inside.
                own = found[path, start] = [[], start != 0, False, 0, True, 0]
            if line is None:
                continue
            for k in (2, 4):
                own[k] = _ends_open(line, own[k], separator)
                own[k + 1] += not own[k]
            if not own[1]:
                own[0].append(line)
                own[1] = not own[2]
        columns = list(zip(*[
            (path, start, _parsed("\n".join(own[0]), separator) if own[0] and own[1] else None, *own[2:])
            for (path, start), own in found.items()])) or [()] * 7
        kinds = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.int64(), pa.bool_(), pa.int64())
        names = [part.split()[0] for part in _SPLIT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)
    return run


def _beginnings(splits: list) -> tuple[dict[tuple[str, int], tuple[bool, int]], bool]:
    """How each split begins: inside a quoted cell or not, and the number of records that end before it.

    Also whether any split ends inside a quoted cell.
    """
    out: dict[tuple[str, int], tuple[bool, int]] = {}
    path, inside, before, crossed = None, False, 0, False
    for r in sorted(splits, key=lambda r: (r["path"], r["start"])):
        if r["path"] != path:
            path, inside, before = r["path"], False, 0
        out[path, r["start"]] = (inside, before)
        way = "inside" if inside else "outside"
        inside, before = r[f"{way}_open"], before + r[f"{way}_records"]
        crossed |= inside
    return out, crossed


def _parsed(record: str, separator: str) -> list[str]:
    return next(csv.reader([record.removesuffix("\r")], delimiter=separator), [])


def _cells(record: str, separator: str, places: list[int]) -> list[str | None] | None:
    """Wanted cells of a record; None for a blank one."""
    cells = _parsed(record, separator)
    if not any(c.strip() for c in cells):
        return None
    return [cells[p] if p < len(cells) else None for p in places]


def _split_records(skip: int, separator: str, places: dict[str, list[int]], begins: dict[tuple[str, int], tuple[bool, int]]):
    """Records that lie within a split, and the fragments of those that do not, with their numbers in the file."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string())
    names = ["sheet", "path", "number", "start", "cells", "fragment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, held, whole, inside, number = None, [], True, False, 0
        for sheet, path, start, line in _split_lines(batches, skip):
            if at != (sheet, path, start):
                if held:
                    out.append((*at[:2], number, at[2], None, "\n".join(held)))
                if (path, start) not in begins:
                    raise RuntimeError(f"{path} is split in another way than when it was scanned; keep spark.sql.files.* as it was")
                at, held = (sheet, path, start), []
                inside, number = begins[path, start]
                whole, number = not inside, number + 1
            if line is None:
                continue
            held.append(line)
            inside = _ends_open(line, inside, separator)
            if inside:
                continue
            text, held = "\n".join(held), []
            if not whole:
                out.append((sheet, path, number, start, None, text))
            elif number > 1 and (cells := _cells(text, separator, places[path])) is not None:
                out.append((sheet, path, number, start, cells, None))
            whole, number = True, number + 1
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if held:
            out.append((*at[:2], number, at[2], None, "\n".join(held)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names)
    return run


def _joined_records(separator: str, places: dict[str, list[int]]):
    """Records put together from fragments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(sheet, number, _cells(value, separator, places[path])) for sheet, path, number, value in
                    zip(*(b.column(c).to_pylist() for c in ("sheet", "path", "number", "value"))) if number > 1]
            rows = [r for r in rows if r[2] is not None]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.string())))], ["sheet", "number", "cells"])
    return run


def read_placemarks(spark: SparkSession, paths: Mapping[str, str], row_tag: str = "Placemark") -> DataFrame:
    """One row per placemark of every metric file: metric, name, style_url."""
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("styleUrl", T.StringType())])
    out = None
    for metric, path in paths.items():
        one = (
            spark.read.format("xml").schema(schema).option("rowTag", row_tag).option("ignoreNamespace", True).load(path)
            .select(F.lit(metric).alias("metric"), F.trim("name").alias("name"), F.trim("styleUrl").alias("style_url"))
        )
        out = one if out is None else out.unionByName(one)
    return out


# Coordinates are read as text first, as their depth depends on the kind of shape.
_GEOMETRY = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
_POLYGON = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def _features(spark: SparkSession, path: str, properties: T.StructType, layout: str) -> DataFrame:
    feature = T.StructType([
        T.StructField("type", T.StringType()), T.StructField("properties", properties), T.StructField("geometry", _GEOMETRY)])
    if layout == "document":
        doc = T.StructType([T.StructField("features", T.ArrayType(feature))])
        return spark.read.schema(doc).json(path, multiLine=True).select(F.explode("features").alias("f"))
    if layout == "lines":
        line = F.regexp_replace(F.trim("value"), ",$", "")
        # Lines of the frame around the features have no properties; any other line must be one whole feature.
        frame = line.isin("", "{", "}", "]", "]}") | line.rlike(r'^\{?\s*"(type"\s*:\s*"FeatureCollection"|name"|crs"|features")(?!.*"Feature")')
        parsed = F.from_json(line, feature)
        whole = line.rlike(r'^\{.*\}$') & parsed.isNotNull() & (parsed["type"] == "Feature")
        wrong = F.concat(F.lit(f"not a feature on a line of its own in {path}; use layout='document' for a collection: "), F.substring(line, 1, 80))
        return spark.read.text(path).filter(~frame).select(F.when(whole, parsed).otherwise(F.raise_error(wrong)).alias("f"))
    raise ValueError(f"unknown layout: {layout}")


def read_points(spark: SparkSession, path: str, properties: T.StructType, layout: str = "lines") -> DataFrame:
    """Point features: properties plus x (longitude) and y (latitude)."""
    xy = F.from_json("f.geometry.coordinates", "array<double>")
    return _features(spark, path, properties, layout).select("f.properties.*", xy.alias("xy")).select(
        *properties.names, F.get("xy", F.lit(0)).alias("x"), F.get("xy", F.lit(1)).alias("y"))


def read_polygons(spark: SparkSession, path: str, properties: T.StructType, layout: str = "lines") -> DataFrame:
    """Polygon and multi-polygon features: properties plus `rings`, all rings of all parts.

    `lines` reads files with one feature per line (splittable); `document`
    reads a feature collection that is one JSON value.
    """
    f = _features(spark, path, properties, layout)
    rings = F.when(
        F.col("f.geometry.type") == "MultiPolygon", F.flatten(F.from_json("f.geometry.coordinates", _MULTI))
    ).otherwise(F.from_json("f.geometry.coordinates", _POLYGON))
    return f.select("f.properties.*", rings.alias("rings"))


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Statistics-portal records staged as JSON lines."""
    return spark.read.schema(schema).json(path)


def rename_from_descriptions(df: DataFrame, descriptions: DataFrame, code: str, description: str) -> DataFrame:
    """Replace column codes by their descriptions from a metadata table with one row per column.

    Only the table's rows for columns of `df` are read. Two descriptions of one column are an error.
    """
    own = descriptions.select(code, description).filter(F.col(code).isin(df.columns)).distinct().collect()
    named = {r[0]: r[1] for r in own}
    if len(named) < len(own):
        raise ValueError("a column has more than one description")
    return df.toDF(*[named.get(c) or c for c in df.columns])
