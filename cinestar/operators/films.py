"""Tables derived from the film metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.operators.collections import explode_elements, film_elements, film_id, parse_inferred
from cinestar.sources import schemas

# Outside ids of broken metadata rows.
DENIED_IMDB_IDS = ("0", "tt0113002", "tt2423504", "tt2622826")


def accept_films(movies: DataFrame, denied: Sequence[str] = DENIED_IMDB_IDS) -> DataFrame:
    """Films whose outside id is known and not on the list (a NULL id is not accepted)."""
    return movies.where(~F.col("imdb_id").isin(*denied))


def accept_films_by_table(movies: DataFrame, denied: DataFrame) -> DataFrame:
    """The same rule for a list of any length, given as a table with an `imdb_id` column."""
    known = movies.where(F.col("imdb_id").isNotNull())
    return known.join(denied.select("imdb_id").distinct(), "imdb_id", "left_anti")


def split_numbered(movies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id is a number, the others); the others are broken rows, not films."""
    return movies.where(film_id().isNotNull()), movies.where(film_id().isNull())


def one_per_film(movies: DataFrame) -> DataFrame:
    """One row per numbered film: of its copies the one with the fewest NULLs, then the smallest.

    Whole rows are compared, so give every column that any table is made of and
    project afterwards: a film is then one of its copies and never a mixture.
    Copies are combined before the shuffle, so an id with very many of them
    costs one row per task. The result is partitioned and sorted by its typed
    id, which a join on the film then uses as it is.
    """
    others = [name for name in movies.columns if name != "id"]
    numbered, _ = split_numbered(movies)
    nulls = sum((F.col(name).isNull().cast("int") for name in others), F.lit(0))
    unique = numbered.groupBy(film_id().alias("id")).agg(
        F.min(F.struct(nulls.alias("_nulls"), *others)).alias("row")
    )
    return unique.select("id", *[F.col("row")[name].alias(name) for name in others])


def of_films(rows: DataFrame, films: DataFrame) -> DataFrame:
    """The rows of another export whose film is among `films`, with the film id typed."""
    return rows.withColumn("id", film_id()).join(films.select("id"), "id", "semi")


def fact_films(movies: DataFrame) -> DataFrame:
    """FactFilms: one row per film."""
    return one_per_film(movies).select("id", "title", "original_title")


def scalar_quarantine(movies: DataFrame) -> DataFrame:
    """The scalar values that are not of their column's type: film id, column, raw text."""
    cells = [
        F.when(
            F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(),
            F.struct(F.lit(name).alias("column"), F.col(name).alias("raw")),
        )
        for name, (_, _, kind) in schemas.SCALARS.items()
        if name in movies.columns and kind != "string"
    ]
    cell = F.explode(F.array_compact(F.array(*cells))).alias("cell")
    return movies.select(film_id().alias("film_id"), cell).select("film_id", "cell.*")


def scalar_dim(movies: DataFrame, attribute: str) -> DataFrame:
    """One typed attribute per film, keyed by (film, attribute name)."""
    _, key, data_type = schemas.SCALARS[attribute]
    return movies.select(
        hash_key(film_id(), F.lit(attribute)).alias(key),
        film_id().alias("film_id"),
        F.col(attribute).try_cast(data_type).alias(attribute),
    )


def _element_key(name: str) -> Column:
    return hash_key("film_id", "position", f"element.{name}")


def dim_countries(movies: DataFrame, policy: str = "exact") -> DataFrame:
    """DimCountries: production countries by name."""
    rows = film_elements(movies, "production_countries", schemas.NAMED, policy)
    return rows.select(_element_key("name").alias("country_id"), "film_id", "element.name")


def dim_countries_inferred(movies: DataFrame, policy: str = "exact") -> DataFrame:
    """DimCountries with the element schema found in the data."""
    parsed = parse_inferred(movies, "production_countries", policy=policy)
    rows = explode_elements(parsed, [film_id().alias("film_id")])
    return rows.select(_element_key("name").alias("country_id"), "film_id", "element.name")


def dim_genres(movies: DataFrame, policy: str = "exact") -> DataFrame:
    """DimGenres: `id` is the genre's own id."""
    rows = film_elements(movies, "genres", schemas.ID_NAME, policy)
    return rows.select("element.id", "film_id", "element.name")


def dim_companies(movies: DataFrame, policy: str = "exact") -> DataFrame:
    """DimProductionCompanies by name; a company without a name keeps its row.

    A film may have its companies spread over several rows; the company's own
    id keeps the keys of their elements apart.
    """
    rows = film_elements(movies, "production_companies", schemas.ID_NAME, policy)
    return rows.select(
        hash_key("film_id", "element.id", "position", "element.name").alias("company_id"),
        "film_id",
        F.col("element.name").alias("company_name"),
    )


def dim_languages(movies: DataFrame, policy: str = "exact") -> DataFrame:
    """DimSpokenLanguages: own key per language, and one key shared by a film's languages."""
    rows = film_elements(movies, "spoken_languages", schemas.NAMED, policy)
    return rows.select(
        _element_key("name").alias("id"),
        hash_key("film_id", F.lit("spoken_languages")).alias("film_key"),
        "film_id",
        F.col("element.name").alias("languages"),
    )


def film_keywords(keywords: DataFrame, policy: str = "exact") -> DataFrame:
    """One row per film, position and keyword, however often the export repeats it."""
    rows = film_elements(keywords, "keywords", schemas.NAMED, policy)
    rows = rows.select("film_id", "position", "element.name").distinct()
    return rows.select(
        hash_key("film_id", "position", "name").alias("id"), "film_id", F.col("name").alias("keyword")
    )
