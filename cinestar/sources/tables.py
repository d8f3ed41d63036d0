"""Parquet folders and catalog tables: scan, overwrite, re-run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cinestar.sources.publish import expire, point_table, publish


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a catalog schema unless it is there."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def save_table(
    frame: DataFrame,
    name: str,
    path: str,
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Publish the rows as an external table, in place of an earlier run, and return its scan.

    The earlier run stays readable until the new one is whole, and the one before
    it is removed then. `bucket_by` is that of `publish`.
    """
    spark = frame.sparkSession
    publish(frame, path, bucket_by=bucket_by or "", buckets=buckets or 0)
    table = point_table(spark, name, path)
    expire(spark, path)
    return table


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table; names are case-insensitive."""
    return spark.table(name)


def overwrite_parquet(frame: DataFrame, path: str) -> DataFrame:
    """Replace a Parquet folder and return its scan (the hand-off between stages)."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def overwrite_run(frame: DataFrame, path: str, run: Mapping[str, str]) -> str:
    """Replace one run, named by its partition columns; other runs stay. Returns its folder.

    The partition is named by the caller and not found in the rows, so a run
    without rows leaves an empty partition and nothing of an earlier run.
    """
    folder = "/".join([path, *(f"{column}={value}" for column, value in run.items())])
    frame.drop(*run).write.mode("overwrite").parquet(folder)
    return folder


def save_run(frame: DataFrame, name: str, path: str, run: Mapping[str, str]) -> DataFrame:
    """Publish one run of a partitioned catalog table, in place of an earlier one; returns all runs' scan."""
    spark = frame.sparkSession
    publish(frame, path, run)
    table = point_table(spark, name, path)
    expire(spark, path)
    return table
