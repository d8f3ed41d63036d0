"""Poster locations: an outside lookup per film, in a set number of parallel slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinestar.functions.scalars import bare_imdb_id, slice_of

# Fixed value: lookups in parallel unless configured otherwise.
DEFAULT_SLICES = 5

# A resolver turns a bare outside id into a poster location.
Resolver = Callable[[str], "str | None"]


def resolve_posters(
    films: DataFrame, open_resolver: Callable[[], Resolver], slices: int = DEFAULT_SLICES
) -> DataFrame:
    """film_id, imdb_id, slice, url, error for every film, `slices` lookups at a time.

    `films` has film_id and imdb_id. Each slice is one partition and opens one
    resolver. A lookup that fails leaves a NULL url and its error text. A task
    that is run again repeats its lookups, so they must be idempotent; write
    the result once and read it from there.
    """

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resolver: Resolver | None = None

        def one(bare: str | None) -> tuple[str | None, str | None]:
            if bare is None:
                return None, None
            try:
                return resolver(bare), None
            except Exception as error:  # the outside service may fail in any way
                return None, f"{type(error).__name__}: {error}"

        for batch in batches:
            if resolver is None and batch.num_rows:  # a slice without films opens none
                resolver = open_resolver()
            found = [one(bare) for bare in batch.column("bare").to_pylist()]
            columns = {name: batch.column(name) for name in ("film_id", "imdb_id", "slice")}
            columns["url"] = pa.array([url for url, _ in found], pa.string())
            columns["error"] = pa.array([error for _, error in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return (
        films.select(
            "film_id",
            "imdb_id",
            slice_of(F.col("film_id"), slices).alias("slice"),
            bare_imdb_id(F.col("imdb_id")).alias("bare"),
        )
        .repartitionById(slices, F.col("slice"))
        .mapInArrow(
            lookup, "film_id bigint, imdb_id string, slice int, url string, error string"
        )
    )


def lookup_posters(films: DataFrame, locations: DataFrame) -> DataFrame:
    """film_id, imdb_id, url from a table of locations (`bare`, `url`; one row per id).

    Films without an outside id match nothing; a key of their own spreads them
    over the join's tasks instead of sending all NULLs to one.
    """
    keyed = films.select(
        "film_id",
        "imdb_id",
        F.coalesce(
            bare_imdb_id(F.col("imdb_id")), F.concat(F.lit("film "), F.col("film_id"))
        ).alias("bare"),
    )
    return keyed.join(locations.select("bare", "url"), "bare", "left").drop("bare")


def write_slices(posters: DataFrame, path: str) -> DataFrame:
    """Write the lookups, one folder per slice, in one job; return the written rows.

    Whoever uses the result reads the folders, so no lookup is made twice.
    """
    posters.write.mode("overwrite").partitionBy("slice").parquet(path)
    rows = posters.sparkSession.read.schema(posters.schema).parquet(path)
    return rows.select(*posters.columns)


def read_worker_outputs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Separate worker output folders as one table, by one scan."""
    return spark.read.parquet(*paths)


def union_slices(frames: Sequence[DataFrame]) -> DataFrame:
    """The union of separately built worker outputs, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def place_posters(films: DataFrame, posters: DataFrame) -> DataFrame:
    """Each film with the location of its poster, NULL where none was found."""
    return films.join(posters.select("film_id", F.col("url").alias("poster")), "film_id", "left")
