"""Quoted CSV: scan and export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# A quote inside a quoted value is doubled.
QUOTING = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    header: Sequence[str] | None = None,
    multiline: bool = False,
    require: Sequence[str] = (),
) -> DataFrame:
    """Every column as string, named by the header line.

    `header` lists all columns of the file in order; the file's own header line
    is checked against it and no extra pass reads it. Without it, Spark takes
    the names from the first line.

    `multiline` lets quoted values hold line breaks. Spark cannot split such a
    file: one task reads it. `records.read_records` reads it by blocks.
    """
    reader = spark.read.options(**QUOTING, multiLine=str(multiline).lower())
    if header is not None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        reader = reader.schema(schema).option("enforceSchema", "false")
    frame = reader.csv(path)
    missing = [name for name in require if name not in frame.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return frame.select(*[f"`{name}`" for name in require]) if require else frame


def export_csv(frame: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """Write a folder of quoted CSV files that `read_csv` reads back unchanged.

    Blanks at the ends of values are kept. An empty string reads back as NULL:
    CSV has one spelling for both. The files are bounded in rows, since a reader
    that must allow line breaks cannot split them.
    """
    (
        frame.write.mode("overwrite")
        .options(
            **QUOTING,
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
            maxRecordsPerFile=str(rows_per_file),
        )
        .csv(path)
    )
