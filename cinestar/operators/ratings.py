"""Ratings: typed rows, per-film aggregates, votes on the film."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.operators.collections import film_id


def fact_ratings(ratings: DataFrame) -> DataFrame:
    """FactRatings: each single rating, typed; a malformed rating is NULL."""
    return ratings.select(
        film_id("movieId").alias("film_id"), F.col("rating").try_cast("double").alias("rating")
    )


def split_ratings(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of a film with a number or no rating, rows whose film or rating is no number)."""
    typed = F.col("rating").try_cast("double").isNotNull() | F.col("rating").isNull()
    good = film_id("movieId").isNotNull() & typed
    return ratings.where(good), ratings.where(~good)


def above(frame: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows whose text column is a number above the bound; other text is not."""
    kind = "bigint" if isinstance(bound, int) else "double"
    return frame.where(F.col(column).try_cast(kind) > bound)


def film_totals(facts: DataFrame) -> DataFrame:
    """Per film of FactRatings, in one aggregate: rows, rated rows, sum and mean of the ratings.

    Tasks combine their rows per film before the shuffle, so a film that holds
    a third of all ratings arrives as one row per task.
    """
    return facts.groupBy("film_id").agg(
        F.count("*").alias("freq"),
        F.count("rating").alias("rated"),
        F.sum("rating").alias("rating_sum"),
        F.avg("rating").alias("rating"),
    )


def ratings_count(totals: DataFrame) -> DataFrame:
    """votes_count: number of ratings per film, NULL ratings included."""
    return totals.select(F.col("film_id").alias("movieId"), "freq")


def ratings_mean(totals: DataFrame) -> DataFrame:
    """avg_votes: mean rating per film."""
    return totals.select(
        hash_key("film_id").alias("id"), F.col("film_id").alias("movieId"), "rating"
    )


def remap_totals(totals: DataFrame, links: DataFrame) -> DataFrame:
    """Totals by the catalogue's film ids, where the ratings use an id space of their own.

    `links` pairs `rating_id` and `film_id`; copies of a pair count once. Mapping
    the totals instead of the ratings joins one row per rated id. Several of
    them may lead to one film.
    """
    pairs = links.select("rating_id", "film_id").distinct()
    mapped = totals.withColumnRenamed("film_id", "rating_id").join(pairs, "rating_id")
    return (
        mapped.groupBy("film_id")
        .agg(
            F.sum("freq").alias("freq"),
            F.sum("rated").alias("rated"),
            F.sum("rating_sum").alias("rating_sum"),
        )
        .withColumn("rating", mean_of("rating_sum", "rated"))
    )


def unlinked_totals(totals: DataFrame, links: DataFrame) -> DataFrame:
    """The totals of rated ids that no link leads from."""
    pairs = links.select(F.col("rating_id").alias("film_id")).distinct()
    return totals.join(pairs, "film_id", "anti").withColumnRenamed("film_id", "rating_id")


def mean_of(total: str, count: str) -> Column:
    """Mean from a sum and a count; NULL for no rows."""
    return F.try_divide(F.col(total), F.col(count))


def film_votes(films: DataFrame, totals: DataFrame) -> DataFrame:
    """Each film with its votes recomputed from the ratings; 0 votes where unrated."""
    votes = totals.select(
        "film_id", F.col("rating").alias("vote_average"), F.col("freq").alias("vote_count")
    )
    return (
        films.withColumnRenamed("id", "film_id")
        .join(votes, "film_id", "left")
        .withColumn("vote_count", F.coalesce("vote_count", F.lit(0)))
    )


def dim_vote_average(votes: DataFrame) -> DataFrame:
    """DimVoteAverage, recomputed."""
    return votes.select(
        hash_key("film_id", F.lit("vote_average")).alias("id"), "film_id", "vote_average"
    )


def dim_vote_count(votes: DataFrame) -> DataFrame:
    """DimVoteCount, recomputed, for all films."""
    return votes.select(
        hash_key("film_id", F.lit("vote_count")).alias("id"), "film_id", "vote_count"
    )


def top_films(votes: DataFrame, n: int) -> DataFrame:
    """The n films with the most votes; ties go by film id, so the answer is fixed."""
    return votes.orderBy(F.desc("vote_count"), "film_id").limit(n)
