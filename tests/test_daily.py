"""The whole batch on CSV exports written from the derived film tables."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cinestar.__main__ import parse_config
from cinestar.plans.daily import DailyConfig, run_daily, score_posters
from cinestar.plans.registry import QUERIES, open_template_resolver
from cinestar.plans.star import star_films
from cinestar.sources import fixtures as raw
from cinestar.sources import schemas
from cinestar.sources.csv import export_csv

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = [
    name for name in schemas.MOVIES if name not in ("id", "imdb_id", "production_companies")
]

# Table of the batch -> registered query that computes the same rows.
SAME_AS = {
    "DimCast": "dim_cast",
    "DimCharacters": "dim_characters",
    "DimRoles": "dim_roles",
    "DimActors": "dim_actors",
    "DimPerson": "dim_person",
    "DimKeywords": "film_keywords",
    "FactFilms": "fact_films",
    "DimGenres": "dim_genres",
    "DimCountries": "dim_countries",
    "DimProductionCompanies": "dim_companies",
    "DimSpokenLanguages": "dim_languages",
    "DimHomepages": "dim_homepages",
    "DimImdbId": "dim_external_id",
    "DimOverview": "dim_overview",
    "DimPopularity": "dim_popularity",
    "DimReleaseDate": "dim_release_date",
    "DimRevenue": "dim_revenue",
    "DimRuntime": "dim_runtime",
    "DimStatus": "dim_status",
    "DimVoteAverage": "dim_vote_average",
    "DimVoteCount": "dim_vote_count",
}


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    return exported(spark, tmp_path_factory.mktemp("daily"), "films_daily")


def exported(spark, folder, database, with_broken_values=False):
    """Exports in a folder, and the configuration of a batch over them."""
    exports = {
        "movies": raw.raw_movies(spark, SF_DIR, *COLUMNS).withColumn(
            "production_companies", F.lit("[]")
        ),
        "credits": raw.raw_credits(spark, SF_DIR),
        "keywords": raw.raw_keywords(spark, SF_DIR),
        "ratings": raw.raw_ratings(spark, SF_DIR),
        "companies": raw.raw_companies(spark, SF_DIR),
    }
    # Twice: copies must not show in the model. Those of films with another size
    # have a NULL more, so they are never the copy that is kept.
    worse = exports["movies"].withColumns({"popularity": F.lit(None), "status": F.lit("AAA")})
    exports["movies"] = exports["movies"].unionByName(worse)
    for name in ("credits", "keywords", "companies"):
        exports[name] = exports[name].unionByName(exports[name])
    broken = exports["movies"].limit(1).withColumns(
        {"id": F.lit("1997-08-20"), "imdb_id": F.lit("tt9"), "genres": F.lit("[{'id'")}
    )
    exports["movies"] = exports["movies"].unionByName(broken)
    untyped = worse.limit(1).withColumns(
        {
            "id": F.lit("999999"),
            "imdb_id": F.lit("tt999999"),
            "popularity": F.lit("12x"),
            "revenue": F.lit("99999999999999999999"),
            "release_date": F.lit("soon"),
        }
    )
    if with_broken_values:
        exports["movies"] = exports["movies"].unionByName(untyped)
    for name, column in (("credits", "cast"), ("keywords", "keywords")):
        bad = spark.createDataFrame([("bad", "[{'id': 1, 'name': 'x'}]")], f"id string, {column} string")
        exports[name] = exports[name].unionByName(bad)
    bad = spark.createDataFrame([("xx", "4.0"), ("1", "oops")], "movieId string, rating string")
    exports["ratings"] = exports["ratings"].unionByName(bad)
    for name, frame in exports.items():
        export_csv(frame, str(folder / name))
    features = str(folder / "features")
    raw.poster_features(spark, SF_DIR).write.parquet(features)
    return DailyConfig(
        **{f"{name}_csv": str(folder / name) for name in exports},
        lake=str(folder / "lake"),
        run_date="2024-01-01",
        database=database,
        denied=raw.DENIED,
        open_resolver=open_template_resolver,
        poster_features=features,
    )


def rows(frame):
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=repr)


def model(spark):
    return {name: rows(spark.table(f"films_daily.{name}")) for name in (*SAME_AS, "DimPosters")}


def test_batch_builds_the_model_and_can_be_repeated(spark, config):
    run_daily(spark, config)
    first = model(spark)
    for table, query in SAME_AS.items():
        assert first[table] == rows(QUERIES[query](spark, SF_DIR)), table
    assert len(first["DimPosters"]) == len(first["DimImdbId"]) == len(first["FactFilms"])

    lake = config.lake
    bad_ids = spark.read.parquet(f"{lake}/quarantine/film_id").collect()
    assert [r["id"] for r in bad_ids] == ["1997-08-20"]
    for name in ("credits", "keywords"):
        assert [r["id"] for r in spark.read.parquet(f"{lake}/quarantine/{name}_id").collect()] == ["bad"]
    assert rows(spark.read.parquet(f"{lake}/quarantine/ratings")) == [("1", "oops"), ("xx", "4.0")]
    assert spark.read.parquet(f"{lake}/quarantine/scalars").count() == 0
    for table in SAME_AS:
        columns = spark.table(f"films_daily.{table}").columns
        if "film_id" in columns:
            assert spark.table(f"films_daily.{table}").where("film_id IS NULL").count() == 0
    cells = spark.read.parquet(f"{lake}/quarantine/credits")
    expected = QUERIES["json_quarantine"](spark, SF_DIR).agg(F.sum("malformed")).first()[0]
    assert cells.count() == expected > 0
    assert spark.read.parquet(f"{lake}/quarantine/movies").count() == 0
    ratings = raw.raw_ratings(spark, SF_DIR).count()
    assert spark.read.parquet(f"{lake}/model/FactRatings").count() == ratings

    scores = spark.table("films_daily.PosterGenres")
    assert scores.where("rank = 1").count() == raw.poster_features(spark, SF_DIR).count()
    assert PipelineModel.load(f"{lake}/model/GenreModel").stages

    run_daily(spark, replace(config, run_date="2024-01-02"))
    run_daily(spark, replace(config, run_date="2024-01-02"))
    assert model(spark) == first
    runs = spark.table("films_daily.FactRatings").groupBy("run_date").count()
    assert {tuple(r) for r in runs.collect()} == {("2024-01-01", ratings), ("2024-01-02", ratings)}


def open_failing_resolver():
    raise AssertionError("a lookup was made")


def test_a_later_run_looks_up_no_known_poster_and_an_empty_one_leaves_no_old_rows(spark, config, tmp_path):
    empty = str(tmp_path / "ratings")
    export_csv(spark.createDataFrame([("xx", "1")], "movieId string, rating string"), empty)
    run_daily(spark, replace(config, run_date="2024-01-03"))
    again = replace(config, run_date="2024-01-03", ratings_csv=empty, open_resolver=open_failing_resolver)
    run_daily(spark, again)
    assert spark.table("films_daily.FactRatings").where("run_date = '2024-01-03'").count() == 0
    assert spark.table("films_daily.DimVoteCount").where("vote_count > 0").count() == 0
    assert spark.table("films_daily.DimPosters").where("url IS NULL").count() == 0


def test_links_and_untyped_values(spark, tmp_path):
    """Ratings with ids of their own, 5000 above the films'; every third has no link."""
    config = exported(spark, tmp_path, "films_linked", with_broken_values=True)
    own = raw.raw_ratings(spark, SF_DIR).withColumn(
        "movieId", (F.col("movieId").cast("bigint") + 5000).cast("string")
    )
    links = spark.range(0, 200).where("id % 3 > 0").selectExpr(
        "CAST(id + 5000 AS STRING) AS rating_id", "CAST(id AS STRING) AS film_id"
    )
    export_csv(own, f"{tmp_path}/own_ratings")
    export_csv(links.unionByName(links), f"{tmp_path}/links")
    config = replace(
        config, ratings_csv=f"{tmp_path}/own_ratings", links_csv=f"{tmp_path}/links",
        open_resolver=None, poster_features=None,
    )
    run_daily(spark, config)
    expected = {
        r["film_id"]: r["freq"] if r["film_id"] % 3 else 0
        for r in QUERIES["film_votes"](spark, SF_DIR).withColumnRenamed("vote_count", "freq").collect()
    }
    found = spark.table("films_linked.DimVoteCount").where("film_id < 999999").collect()
    assert {r["film_id"]: r["vote_count"] for r in found} == expected
    lost = spark.read.parquet(f"{config.lake}/quarantine/unlinked").agg(F.sum("freq")).first()[0]
    assert lost == own.where("movieId % 3 = 2").count() > 0
    scalars = spark.read.parquet(f"{config.lake}/quarantine/scalars")
    assert rows(scalars) == [
        ("popularity", 999999, "12x"), ("release_date", 999999, "soon"), ("revenue", 999999, "99999999999999999999"),
    ]


def test_a_saved_model_scores_new_posters(spark, config, tmp_path):
    features = spark.read.parquet(config.poster_features).limit(3)
    features.write.parquet(str(tmp_path / "new"))
    scored = score_posters(spark, f"{config.lake}/model/GenreModel", str(tmp_path / "new"))
    assert scored.where("rank = 1").count() == 3
    held = spark.read.parquet(f"{config.lake}/genre_evaluation").first()
    assert 0 < held["posters"] and held["first"] <= held["among_three"] <= held["posters"]


def test_bucketed_tables_join_without_shuffle(spark, config, no_broadcast):
    per_film = {a: spark.table(f"films_daily.{t}") for a, (t, _, _) in schemas.SCALARS.items()}
    facts = spark.table("films_daily.FactFilms").withColumnRenamed("id", "film_id")
    wide = star_films(facts, per_film)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert wide.count() == facts.count()


def test_command_line_sets_the_number_of_slices():
    arguments = "--movies-csv m --credits-csv c --keywords-csv k --ratings-csv r --lake l".split()
    arguments += ["--run-date", "2024-01-01", "--slices", "10"]
    arguments += ["--open-resolver", "cinestar.plans.registry:open_template_resolver"]
    config = parse_config(arguments)
    assert config.slices == 10 and config.movies_csv == "m" and config.database == "films"
    assert config.open_resolver is open_template_resolver
    assert parse_config(arguments[:-4]).slices == 5
