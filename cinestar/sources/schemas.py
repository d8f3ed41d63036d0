"""Columns of the raw exports and the types of the model."""

from __future__ import annotations

# Element structs of the collection columns in the exports, as DDL.
ID_NAME = "id int, name string"
CAST_MEMBER = (
    "cast_id int, character string, credit_id string, gender int, "
    "id int, name string, `order` int, profile_path string"
)

# The parts of the elements that the tables use; the parser skips the rest.
NAMED = "name string"
CREDITED = "character string, credit_id string, gender int, id int, name string"

# Collection columns of the metadata export, and what the batch keeps of them.
FILM_COLLECTIONS = {
    "genres": ID_NAME,
    "production_companies": ID_NAME,
    "production_countries": NAMED,
    "spoken_languages": NAMED,
}

# Columns each stage needs; raw files may hold more.
MOVIES = (
    "id",
    "imdb_id",
    "title",
    "original_title",
    "genres",
    "homepage",
    "overview",
    "popularity",
    "production_companies",
    "production_countries",
    "release_date",
    "revenue",
    "runtime",
    "spoken_languages",
    "status",
)
COMPANIES = ("id", "production_companies")
CREDITS = ("id", "cast")
KEYWORDS = ("id", "keywords")
RATINGS = ("movieId", "rating")
LINKS = ("rating_id", "film_id")

# Scalar film attribute -> (table, name of its key column, type in the model).
SCALARS = {
    "homepage": ("DimHomepages", "homepage_id", "string"),
    "imdb_id": ("DimImdbId", "id", "string"),
    "overview": ("DimOverview", "id", "string"),
    "popularity": ("DimPopularity", "id", "double"),
    "release_date": ("DimReleaseDate", "id", "date"),
    "revenue": ("DimRevenue", "id", "decimal(18,2)"),
    "runtime": ("DimRuntime", "id", "double"),
    "status": ("DimStatus", "id", "string"),
}
