"""Distinct films over several dimensions at once, where a film has many values in each.

Counting rows of a join would count a film once for each combination of its
values. Films are numbered densely instead, and a set of films is a bitmap: one
row of 32,768 bits for each value and each stretch of numbers that it has films
in. Bitmaps of single cells are made within tasks before the shuffle; those of
coarser groups are the union of them, so the films are read once for all levels,
and sets of several runs or parts can be merged later in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.operators.dense import dense_key

_WIDTH = 15  # bits of a number within a bitmap: Spark's bitmaps hold 2**15


def film_numbers(films: DataFrame) -> DataFrame:
    """(film_id, number): films numbered from 0 without a gap."""
    return dense_key(films.select("film_id").distinct(), "film_id", key="number")


def film_sets(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(names, stretch, films): bitmaps of the numbers in each cell of (names); rows may repeat."""
    place = F.col("number").bitwiseAND(F.lit((1 << _WIDTH) - 1))
    return rows.groupBy(*names, F.shiftright("number", _WIDTH).alias("stretch")).agg(
        F.bitmap_construct_agg(place).alias("films")
    )


def merged(sets: DataFrame, names: Sequence[str], levels: Sequence[Sequence[str]]) -> DataFrame:
    """(names, level, stretch, films): unions of the cells at each level; names that it leaves out are null.

    `level` has a bit for each name, the first one the highest, set where the name is left out.
    """
    view = [[*level, "stretch"] for level in levels]
    grouped = sets.groupingSets([[F.col(c) for c in level] for level in view], *names, "stretch")
    out = grouped.agg(F.bitmap_or_agg("films").alias("films"), F.grouping_id().alias("level"))
    # The last of the bits is that of the stretch, which no level leaves out.
    return out.withColumn("level", F.shiftright("level", 1))


def distinct_films(
    films: DataFrame, dims: dict[str, DataFrame], levels: Sequence[Sequence[str]]
) -> DataFrame:
    """(names, level, films): distinct films at each level.

    `films` has film_id; each dimension has film_id and a column of its name. A
    film without a value in a dimension counts under null there.
    """
    rows = film_numbers(films)
    for name, dim in dims.items():
        rows = rows.join(dim.select("film_id", name).distinct(), "film_id", "left")
    sets = merged(film_sets(rows, list(dims)), list(dims), levels)
    size: Column = F.bitmap_count("films")
    return sets.groupBy(*dims, "level").agg(F.sum(size).alias("films"))
