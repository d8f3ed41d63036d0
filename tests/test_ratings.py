from __future__ import annotations

from cinestar.operators import ratings


def raw(spark, rows):
    return spark.createDataFrame(rows, "movieId string, rating string")


def totals(spark, rows):
    return ratings.film_totals(ratings.fact_ratings(raw(spark, rows)))


ROWS = [("1", "3.5"), ("1", "x"), ("2", None)]


def test_mean_skips_and_count_keeps_unusable_ratings(spark):
    both = totals(spark, ROWS)
    assert {tuple(r) for r in ratings.ratings_count(both).collect()} == {(1, 2), (2, 1)}
    assert {(r["movieId"], r["rating"]) for r in ratings.ratings_mean(both).collect()} == {
        (1, 3.5),
        (2, None),
    }


def test_unrated_film_has_no_votes(spark):
    films = spark.createDataFrame([(1, "a"), (3, "b")], "id bigint, title string")
    votes = ratings.film_votes(films, totals(spark, ROWS))
    assert {tuple(r) for r in votes.select("film_id", "vote_average", "vote_count").collect()} == {
        (1, 3.5, 2),
        (3, None, 0),
    }


def test_above_compares_numbers_not_text(spark):
    rows = raw(spark, [("10", "1"), ("9", "1"), ("5", "1"), ("five", "1"), (None, "1")])
    assert sorted(r["movieId"] for r in ratings.above(rows, "movieId", 5).collect()) == ["10", "9"]


def test_remapped_totals_weigh_by_count(spark):
    links = spark.createDataFrame([(1, 100), (2, 100), (3, 200)], "rating_id bigint, film_id bigint")
    sums = totals(spark, [("1", "1.0"), ("1", "2.0"), ("2", "4.5"), ("3", None)])
    mapped = ratings.remap_totals(sums, links)
    assert {(r["film_id"], r["freq"], r["rating"]) for r in mapped.collect()} == {
        (100, 3, 2.5),
        (200, 1, None),
    }


def test_one_shuffle_for_count_and_mean(spark):
    plan = totals(spark, ROWS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_top_films_breaks_ties_by_id(spark):
    votes = spark.createDataFrame(
        [(3, 5), (1, 5), (2, 9), (4, 1)], "film_id bigint, vote_count bigint"
    )
    assert [r["film_id"] for r in ratings.top_films(votes, 3).collect()] == [2, 1, 3]
