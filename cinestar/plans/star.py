"""Queries over the finished star: films with their attributes, rollups by dimension."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinestar.operators.ratings import mean_of


def star_films(votes: DataFrame, scalar_dims: Mapping[str, DataFrame]) -> DataFrame:
    """Each film with its votes and every scalar dimension next to it.

    `scalar_dims` holds, per attribute, a dimension with one row per film. All
    joins are on film_id, so one partitioning by film serves the whole chain.
    """
    return reduce(
        lambda wide, dim: wide.join(dim[1].select("film_id", dim[0]), "film_id", "left"),
        scalar_dims.items(),
        votes,
    )


def film_measures(films: DataFrame, totals: DataFrame, revenue: DataFrame) -> DataFrame:
    """What can be summed per film: votes, sum of ratings, revenue."""
    return (
        films.select(F.col("id").alias("film_id"))
        .join(totals.select("film_id", "freq", "rated", "rating_sum"), "film_id", "left")
        .join(revenue.select("film_id", "revenue"), "film_id", "left")
    )


def rollup_by(measures: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """Films, votes, mean rating and revenue per value of a dimension.

    The mean is that of all single ratings, from sums and counts. A value with
    very many films is combined within each task before the shuffle.
    """
    return (
        measures.join(dim.select("film_id", F.col(name).alias("value")), "film_id")
        .groupBy("value")
        .agg(
            F.count("*").alias("films"),
            F.coalesce(F.sum("freq"), F.lit(0)).alias("votes"),
            F.sum("rating_sum").alias("rating_sum"),
            F.sum("rated").alias("rated"),
            F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        )
        .select(
            F.col("value").alias(name),
            "films",
            "votes",
            mean_of("rating_sum", "rated").alias("vote_average"),
            "revenue",
        )
    )
