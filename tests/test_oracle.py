"""Registered queries against their SQL, on the smallest test tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cinestar.plans.oracles import ORACLES
from cinestar.plans.registry import QUERIES
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    assert differences(queries()[name](spark, SF_DIR), database, oracle_sql()[name]) == []


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == {"genre_scores"}


def test_genre_scores_cover_every_poster_and_genre(spark):
    scores = queries()["genre_scores"](spark, SF_DIR)
    posters, genres = scores.select("film_id").distinct().count(), scores.select("genre").distinct().count()
    assert scores.count() == posters * genres > 0


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["film_id", "title", "original_title", "vote_average", "vote_count"]
    assert frame.count() > 0


# Query -> columns that identify its rows.
KEYS = {
    "dim_countries": ["country_id"],
    "dim_companies": ["company_id"],
    "dim_languages": ["id"],
    "film_keywords": ["id"],
    "dim_cast": ["id"],
    "dim_homepages": ["homepage_id"],
    "dim_revenue": ["id"],
    "dim_vote_count": ["id"],
    "ratings_mean": ["id"],
    "dense_keys": ["id"],
    "fact_films": ["id"],
    "genre_scores": ["film_id", "rank"],
}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_keys_are_unique(spark, name):
    rows = queries()[name](spark, SF_DIR).select(*KEYS[name])
    assert rows.count() == rows.distinct().count() > 0
