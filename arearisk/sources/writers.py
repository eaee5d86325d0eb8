"""Writers. Tables between steps are Parquet; CSV is for people and other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.sources.readers import NA


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; missing values are written as `NA`."""
    df.write.mode("overwrite").option("header", True).option("nullValue", NA).csv(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_report(sheets: dict[str, DataFrame], path: str) -> None:
    """One folder per sheet: the first write replaces the report, the others add to it.

    Sheets differ in columns, so each is written on its own.
    """
    for i, (name, df) in enumerate(sheets.items()):
        tagged = df.withColumn("sheet", F.lit(name))
        tagged.write.mode("overwrite" if i == 0 else "append").option("header", True).option(
            "nullValue", NA).partitionBy("sheet").csv(path)
