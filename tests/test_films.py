from __future__ import annotations

import datetime
import decimal

from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.functions.scalars import bare_imdb_id, role_of
from cinestar.operators import cast, films
from cinestar.operators.collections import film_id


def ids(frame, column="imdb_id"):
    return sorted(r[column] for r in frame.collect())


def test_deny_list_drops_null_too(spark):
    movies = spark.createDataFrame([("0",), ("tt1",), (None,)], "imdb_id string")
    assert ids(films.accept_films(movies, ["0"])) == ["tt1"]
    denied = spark.createDataFrame([("0",), (None,)], "imdb_id string")
    assert ids(films.accept_films_by_table(movies, denied)) == ["tt1"]


def test_one_per_film_is_the_smallest_copy(spark):
    rows = [("7", "b", "x"), ("07", "a", "y"), ("7", "a", "z"), ("n/a", "c", None), ("bad", "d", None)]
    movies = spark.createDataFrame(rows, "id string, title string, original_title string")
    unique = {tuple(r) for r in films.one_per_film(movies).collect()}
    assert unique == {(7, "a", "y")}
    numbered, broken = films.split_numbered(movies)
    assert numbered.count() == 3 and ids(broken, "id") == ["bad", "n/a"]


def test_scalar_dims_are_typed_and_malformed_text_is_null(spark):
    movies = spark.createDataFrame(
        [("1", "1995-10-30", "373554033", "81.0"), ("2", "soon", "much", "")],
        "id string, release_date string, revenue string, runtime string",
    )
    dates = films.scalar_dim(movies, "release_date")
    assert dates.dtypes[2] == ("release_date", "date")
    assert {(r["film_id"], r["release_date"]) for r in dates.collect()} == {
        (1, datetime.date(1995, 10, 30)),
        (2, None),
    }
    money = {r["film_id"]: r["revenue"] for r in films.scalar_dim(movies, "revenue").collect()}
    assert money == {1: decimal.Decimal("373554033.00"), 2: None}
    assert films.scalar_dim(movies, "runtime").where("runtime is null").count() == 1


def test_child_dims(spark):
    movies = spark.createDataFrame(
        [
            (
                "5",
                "[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': None}]",
                "[{'name': 'Pixar', 'id': 3}, {'name': None, 'id': 4}]",
                "[{'iso_3166_1': 'CI', 'name': \"Cote D'Ivoire\"}]",
                "[{'iso_639_1': 'en', 'name': 'English'}, {'iso_639_1': 'fr', 'name': 'Fran\\xe7ais'}]",
            )
        ],
        "id string, genres string, production_companies string, "
        "production_countries string, spoken_languages string",
    )
    assert {tuple(r) for r in films.dim_genres(movies).collect()} == {
        (16, 5, "Animation"),
        (35, 5, None),
    }
    assert ids(films.dim_companies(movies).where("company_name is not null"), "company_name") == ["Pixar"]
    assert films.dim_companies(movies).count() == 2
    assert ids(films.dim_countries(movies), "name") == ["Cote D'Ivoire"]
    assert ids(films.dim_countries_inferred(movies), "name") == ["Cote D'Ivoire"]
    languages = films.dim_languages(movies).collect()
    assert sorted(r["languages"] for r in languages) == ["English", "Français"]
    assert len({r["id"] for r in languages}) == 2 and len({r["film_key"] for r in languages}) == 1


def test_without_cleaning_one_none_loses_the_film(spark):
    movies = spark.createDataFrame(
        [("1", "[{'id': 1, 'name': 'a'}, {'id': 2, 'name': None}]")], "id string, genres string"
    )
    assert films.dim_genres(movies, policy="none").count() == 0
    assert films.dim_genres(movies).count() == 2


def test_roles(spark):
    rows = spark.createDataFrame([(None,), ("B (voice)",), ("C (Voice)",)], "c string")
    roles = {r[0]: r[1] for r in rows.select("c", role_of(F.col("c"))).collect()}
    assert roles == {None: "actor/actress", "B (voice)": "voice", "C (Voice)": "actor/actress"}


def test_cast_tables_share_the_credit_key(spark):
    cell = (
        "[{'cast_id': 14, 'character': 'Woody (voice)', 'credit_id': '52fe', 'gender': 2, "
        "'id': 31, 'name': 'Tom', 'order': 0, 'profile_path': None}, "
        "{'cast_id': 15, 'character': None, 'credit_id': '52ff', 'gender': 2, "
        "'id': 31, 'name': 'Tom', 'order': 1, 'profile_path': '/p.jpg'}]"
    )
    members = cast.cast_members(spark.createDataFrame([("862", cell)], "id string, cast string"))
    keys = [
        {r["id"] for r in table(members).collect()}
        for table in (cast.dim_cast, cast.dim_characters, cast.dim_roles)
    ]
    assert len(keys[0]) == 2 and keys[0] == keys[1] == keys[2]
    assert {(r["film_id"], r["role"]) for r in cast.dim_roles(members).collect()} == {
        (862, "voice"),
        (862, "actor/actress"),
    }
    assert cast.dim_actors(members).count() == 1


def test_hash_keys_tell_parts_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("~", None), (None, "~"), ("", "")]
    frame = spark.createDataFrame(rows, "x string, y string")
    keyed = frame.select("x", "y", hash_key("x", "y").alias("key"))
    first = {(r["x"], r["y"]): r["key"] for r in keyed.collect()}
    again = {(r["x"], r["y"]): r["key"] for r in keyed.repartition(3, "y").collect()}
    assert len(set(first.values())) == len(rows) and first == again


def test_bare_id_and_film_id(spark):
    rows = spark.createDataFrame([("tt0114709", "862"), (None, "1997-08-20")], "i string, id string")
    found = [tuple(r) for r in rows.select(bare_imdb_id(F.col("i")), film_id()).collect()]
    assert found == [("0114709", 862), (None, None)]
