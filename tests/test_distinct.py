from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from cinestar.operators.cast import dim_person
from cinestar.plans.distinct import distinct_films, film_numbers, film_sets, merged

LEVELS = [["g", "c"], ["g"], ["c"], []]


def test_no_film_counts_twice(spark):
    rng = random.Random(1)
    films = list(range(100_000, 170_000, 7)) * 2  # copies, and more than one stretch of numbers would hold
    genres = [(f, rng.choice("xyz")) for f in films for _ in range(2) if f % 5]
    countries = [(f, rng.choice(["k", "l", None])) for f in films if f % 3]
    dims = {
        "g": spark.createDataFrame(genres, "film_id bigint, g string"),
        "c": spark.createDataFrame(countries, "film_id bigint, c string"),
    }
    found = distinct_films(spark.createDataFrame([(f,) for f in films], "film_id bigint"), dims, LEVELS)
    by_film = {name: defaultdict(set) for name in dims}
    for f, g in genres:
        by_film["g"][f].add(g)
    for f, c in countries:
        by_film["c"][f].add(c)
    expected = defaultdict(set)
    for f in set(films):
        for g in by_film["g"][f] or {None}:
            for c in by_film["c"][f] or {None}:
                for key in ((g, c, 0), (g, None, 1), (None, c, 2), (None, None, 3)):
                    expected[key].add(f)
    assert {(r.g, r.c, r.level): r.films for r in found.collect()} == {k: len(v) for k, v in expected.items()}


def test_sets_of_parts_can_be_merged(spark):
    rows = film_numbers(spark.range(70_000).withColumnRenamed("id", "film_id"))
    rows = rows.withColumn("g", F.when(F.col("film_id") % 3 == 0, "x").otherwise("y"))
    halves = [film_sets(rows.where(part), ["g"]) for part in ("film_id < 40000", "film_id >= 30000")]
    both = merged(halves[0].union(halves[1]), ["g"], [["g"], []])
    found = both.groupBy("g", "level").agg(F.sum(F.bitmap_count("films")).alias("films"), F.count("*").alias("rows"))
    assert {(r.g, r.level): r.films for r in found.collect()} == {("x", 0): 23_334, ("y", 0): 46_666, (None, 1): 70_000}
    assert {r.rows for r in found.collect()} == {3}  # 70,000 numbers in stretches of 32,768


def test_persons_are_settled_by_their_credits(spark):
    rows = (
        [(1, "Ann", 1)] * 3 + [(1, "Anne", 1)] * 2 + [(1, "Anne", 2)] * 4  # 6 x Anne; 5 x 1, 4 x 2
        + [(2, "b", 0), (2, "a", 0)]  # a tie; no known gender
        + [(3, None, 2), (3, None, 0), (3, None, 0)]
        + [(4, "x", 0)] * 5 + [(4, "x", 2)]
        + [(None, "nobody", 1)]
        + [(5, "hot", 1)] * 3000
    )
    members = spark.createDataFrame(rows, "cast_member_id int, name string, gender int").repartition(5)
    found = {r.cast_member_id: (r.name, r.gender, r.names, r.genders, r.credits) for r in dim_person(members).collect()}
    assert found == {
        1: ("Anne", 1, 2, 2, 9),
        2: ("a", 0, 2, 0, 2),
        3: (None, 2, 0, 1, 3),
        4: ("x", 2, 1, 1, 6),
        5: ("hot", 1, 1, 1, 3000),
    }
