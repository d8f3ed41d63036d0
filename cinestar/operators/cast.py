"""Tables derived from the credits: who plays whom, and in which role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.functions.scalars import PLAYER, role_of
from cinestar.operators.collections import film_elements
from cinestar.sources import schemas


def cast_members(credits: DataFrame, policy: str = "exact") -> DataFrame:
    """One row per credited member; the three cast tables are projections of it.

    `id` identifies the credit and is the same in all of them. A film may have
    its cast spread over several credits rows.
    """
    rows = film_elements(credits, "cast", schemas.CREDITED, policy)
    return rows.select(
        hash_key("film_id", "element.credit_id", "element.id", "position").alias("id"),
        F.col("element.id").alias("cast_member_id"),
        "film_id",
        "element.name",
        "element.gender",
        "element.character",
    )


def dim_cast(members: DataFrame) -> DataFrame:
    """DimCast: the bridge between film and person."""
    return members.select("id", "cast_member_id", "film_id", "name")


def dim_characters(members: DataFrame) -> DataFrame:
    """DimCharacters, with the film the character occurs in."""
    return members.select("id", "cast_member_id", "film_id", "character")


def dim_roles(members: DataFrame) -> DataFrame:
    """DimRoles over both role values."""
    return members.select(
        "id", "cast_member_id", "film_id", role_of(F.col("character")).alias("role")
    )


def dim_actors(members: DataFrame) -> DataFrame:
    """The actors and actresses: roles that are not voice roles."""
    return dim_roles(members).where(F.col("role") == PLAYER)


def dim_person(members: DataFrame) -> DataFrame:
    """DimPerson: each person once, by the name and gender that most of the credits give.

    Credits of one id may disagree. Votes are counted per person, name and gender,
    within tasks first, so a person of very many credits costs a row per task and
    spelling. Ties go to the smaller name or gender; 0 is no known gender and only
    counts where no other is given. `names` and `genders` say how many there were.
    """
    votes = members.where(F.col("cast_member_id").isNotNull()).groupBy("cast_member_id", "name", "gender")
    votes = votes.agg(F.count("*").alias("credits"))
    by_name = votes.groupBy("cast_member_id", "name").agg(F.sum("credits").alias("credits"))
    known = F.when(F.col("gender") != 0, F.col("gender"))
    by_gender = votes.groupBy("cast_member_id", known.alias("gender")).agg(F.sum("credits").alias("credits"))

    def most(value: str) -> Column:
        vote = F.struct((-F.col("credits")).alias("minus"), value)
        return F.min(F.when(F.col(value).isNotNull(), vote))[value]

    names = by_name.groupBy("cast_member_id").agg(
        most("name").alias("name"), F.count("name").alias("names"), F.sum("credits").alias("credits")
    )
    genders = by_gender.groupBy("cast_member_id").agg(
        F.coalesce(most("gender"), F.lit(0)).alias("gender"), F.count("gender").alias("genders")
    )
    return names.join(genders, "cast_member_id").select(
        hash_key("cast_member_id").alias("id"), "cast_member_id", "name", "gender", "names", "genders", "credits"
    )
