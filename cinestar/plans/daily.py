"""The daily batch: raw exports -> star tables -> ratings -> posters -> genre model.

Every stage reads what an earlier stage has written, and every write replaces
its target, so the batch can be run again at any time with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinestar.operators import cast, enrich, films, posters, ratings
from cinestar.operators.collections import parse_collections, quarantine_cells
from cinestar.sources import schemas
from cinestar.sources.csv import read_csv
from cinestar.sources.records import read_records
from cinestar.sources.tables import (
    ensure_schema,
    overwrite_parquet,
    read_table,
    save_run,
    save_table,
)

@dataclass(frozen=True)
class DailyConfig:
    """Where the exports lie and where the model goes."""

    movies_csv: str
    credits_csv: str
    keywords_csv: str
    ratings_csv: str
    lake: str
    run_date: str
    database: str = "films"
    denied: Sequence[str] = films.DENIED_IMDB_IDS
    policy: str = "exact"
    # Companies as an export of their own, with any number of rows per film; else
    # they are read from the metadata.
    companies_csv: str | None = None
    # Pairs of rating id and film id, where the ratings have an id space of their own.
    links_csv: str | None = None
    # Keywords and ratings may hold line breaks inside quoted values, as metadata always may.
    multiline: bool = False
    # Buckets of the tables that have one row per film; equal counts join without
    # a shuffle. By default as many as a shuffle has partitions.
    buckets: int | None = None
    # Poster locations: a resolver, asked for `slices` films at a time, or else
    # a Parquet table (bare outside id in `bare`, location in `url`).
    open_resolver: Callable[[], enrich.Resolver] | None = None
    slices: int = enrich.DEFAULT_SLICES
    poster_table: str | None = None
    # Parquet with film_id and features (array) of the posters, for the genre model.
    poster_features: str | None = None


class _Lake:
    """Names and paths of one configuration."""

    def __init__(self, spark: SparkSession, config: DailyConfig) -> None:
        self.spark, self.config = spark, config

    def path(self, name: str) -> str:
        return f"{self.config.lake}/{name}"

    def stage(self, frame: DataFrame, name: str) -> DataFrame:
        return overwrite_parquet(frame, self.path(name))

    def table(self, frame: DataFrame, name: str, per_film: str | None = None) -> DataFrame:
        """Save a table of the model; `per_film` names the id of a table with one row per film."""
        full_name, path = f"{self.config.database}.{name}", self.path(f"model/{name}")
        buckets = self.config.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return save_table(frame, full_name, path, per_film, buckets)

    def numbered(self, frame: DataFrame, name: str) -> DataFrame:
        """The distinct rows whose id is a number; the others go to a quarantine of that name."""
        staged = self.stage(frame.distinct(), f"stage/{name}_rows")
        good, broken = films.split_numbered(staged)
        self.stage(broken, f"quarantine/{name}_id")
        return good

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.config.database}.{name}")


def run_credits(lake: _Lake) -> None:
    """Credits are parsed once; the cast tables are projections of the staged cells."""
    config = lake.config
    credits = read_csv(lake.spark, config.credits_csv, require=schemas.CREDITS)
    credits = lake.numbered(credits, "credits")
    credits = parse_collections(credits, {"cast": schemas.CREDITED}, config.policy)
    credits = lake.stage(credits, "stage/credits")
    members = cast.cast_members(credits)
    lake.table(cast.dim_cast(members), "DimCast")
    lake.table(cast.dim_characters(members), "DimCharacters")
    lake.table(cast.dim_roles(members), "DimRoles")
    lake.table(cast.dim_actors(members), "DimActors")
    lake.table(cast.dim_person(members), "DimPerson")
    lake.stage(quarantine_cells(credits), "quarantine/credits")


def run_movies(lake: _Lake) -> None:
    """Metadata is read once, cleared of denied rows and copies, parsed and staged."""
    config = lake.config
    movies = read_records(lake.spark, config.movies_csv, require=schemas.MOVIES)
    accepted = lake.stage(films.accept_films(movies, config.denied), "stage/accepted")
    numbered, broken = films.split_numbered(accepted)
    lake.stage(broken, "quarantine/film_id")
    unique = films.one_per_film(numbered)
    movies = parse_collections(unique, schemas.FILM_COLLECTIONS, config.policy)
    movies = lake.stage(movies, "stage/movies")

    lake.table(movies.select("id", "title", "original_title"), "FactFilms", per_film="id")
    lake.table(films.dim_countries(movies), "DimCountries")
    lake.table(films.dim_genres(movies), "DimGenres")
    lake.table(films.dim_companies(_companies(lake, movies)), "DimProductionCompanies")
    lake.table(films.dim_languages(movies), "DimSpokenLanguages")
    for attribute, (name, _, _) in schemas.SCALARS.items():
        lake.table(films.scalar_dim(movies, attribute), name, per_film="film_id")
    lake.stage(quarantine_cells(movies), "quarantine/movies")
    lake.stage(films.scalar_quarantine(movies), "quarantine/scalars")


def _companies(lake: _Lake, movies: DataFrame) -> DataFrame:
    """Rows with the companies of the accepted films."""
    path = lake.config.companies_csv
    if path is None:
        return movies
    rows = lake.numbered(read_csv(lake.spark, path, require=schemas.COMPANIES), "companies")
    rows = parse_collections(rows, {"production_companies": schemas.ID_NAME}, lake.config.policy)
    rows = lake.stage(rows, "stage/companies")
    lake.stage(quarantine_cells(rows), "quarantine/companies")
    return films.of_films(rows, movies)


def run_keywords(lake: _Lake) -> None:
    """Keywords, parsed and staged like the other exports."""
    config = lake.config
    read = read_records if config.multiline else read_csv
    keywords = read(lake.spark, config.keywords_csv, require=schemas.KEYWORDS)
    keywords = lake.numbered(keywords, "keywords")
    keywords = parse_collections(keywords, {"keywords": schemas.NAMED}, config.policy)
    keywords = lake.stage(keywords, "stage/keywords")
    lake.table(films.film_keywords(keywords), "DimKeywords")
    lake.stage(quarantine_cells(keywords), "quarantine/keywords")


def run_ratings(lake: _Lake) -> None:
    """Single ratings as a partition of the run; their totals per film as its votes."""
    config = lake.config
    read = read_records if config.multiline else read_csv
    raw = read(lake.spark, config.ratings_csv, require=schemas.RATINGS)
    good, broken = ratings.split_ratings(raw)
    lake.stage(broken, "quarantine/ratings")
    name, path = f"{config.database}.FactRatings", lake.path("model/FactRatings")
    runs = save_run(ratings.fact_ratings(good), name, path, {"run_date": config.run_date})
    of_this_run = runs.where(F.col("run_date") == config.run_date)

    totals = lake.stage(ratings.film_totals(of_this_run), "stage/rating_totals")
    if config.links_csv is not None:
        links = read_csv(lake.spark, config.links_csv, require=schemas.LINKS)
        links = links.select(*[F.col(c).try_cast("bigint").alias(c) for c in schemas.LINKS])
        links = links.where("rating_id IS NOT NULL AND film_id IS NOT NULL")
        lake.stage(ratings.unlinked_totals(totals, links), "quarantine/unlinked")
        totals = lake.stage(ratings.remap_totals(totals, links), "stage/linked_totals")
    lake.stage(ratings.ratings_mean(totals), "avg_votes")
    lake.stage(ratings.ratings_count(totals), "votes_count")
    votes = lake.stage(ratings.film_votes(lake.read("FactFilms"), totals), "stage/votes")
    lake.table(ratings.dim_vote_average(votes), "DimVoteAverage", per_film="film_id")
    lake.table(ratings.dim_vote_count(votes), "DimVoteCount", per_film="film_id")


def run_posters(lake: _Lake) -> None:
    """The location of each film's poster. Outside lookups are written before they are used."""
    config = lake.config
    ids = lake.read("DimImdbId").select("film_id", "imdb_id")
    if config.open_resolver is not None:
        located = _resolved(lake, ids)
    elif config.poster_table is not None:
        located = enrich.lookup_posters(ids, lake.spark.read.parquet(config.poster_table))
    else:
        return
    lake.table(located, "DimPosters", per_film="film_id")


def _resolved(lake: _Lake, ids: DataFrame) -> DataFrame:
    """Locations found by earlier runs, and by this run for the films without one."""
    config, key = lake.config, ["film_id", "imdb_id"]
    found = enrich.resolve_posters(ids, config.open_resolver, config.slices)
    name = f"{config.database}.DimPosters"
    if not lake.spark.catalog.tableExists(name):
        written = enrich.write_slices(found, lake.path("stage/posters"))
        return written.select(*key, "url", "error")
    # Staged: the table that is read here is replaced in the end.
    known = lake.read("DimPosters").where("url IS NOT NULL").join(ids, key, "semi")
    known = lake.stage(known.select(*key, "url", "error"), "stage/known_posters")
    missing = ids.join(known, key, "anti")
    found = enrich.resolve_posters(missing, config.open_resolver, config.slices)
    written = enrich.write_slices(found, lake.path("stage/posters"))
    return known.unionByName(written.select(*key, "url", "error"))


def run_genres(lake: _Lake) -> None:
    """Posters labelled with the genres of their films, the model, and its ranked genres."""
    config = lake.config
    if config.poster_features is None:
        return
    features = lake.spark.read.parquet(config.poster_features).select("film_id", "features")
    labels = posters.poster_labels(features, lake.read("DimGenres"))
    labels = lake.stage(labels, "stage/poster_labels")
    train, test = posters.split_by_film(labels)
    model = posters.train_genres(train)
    model.write().overwrite().save(lake.path("model/GenreModel"))
    lake.stage(posters.evaluate_genres(model, test), "genre_evaluation")
    lake.table(posters.score_genres(model, features), "PosterGenres")


def score_posters(spark: SparkSession, model_path: str, features_path: str) -> DataFrame:
    """Ranked genres of new posters by a saved model; nothing is trained."""
    features = spark.read.parquet(features_path).select("film_id", "features")
    return posters.score_genres(PipelineModel.load(model_path), features)


def run_daily(spark: SparkSession, config: DailyConfig) -> None:
    """All stages in order: cast, metadata and keywords, then ratings, posters, genres."""
    ensure_schema(spark, config.database, f"{config.lake}/schema")
    lake = _Lake(spark, config)
    run_credits(lake)
    run_movies(lake)
    run_keywords(lake)
    run_ratings(lake)
    run_posters(lake)
    run_genres(lake)
