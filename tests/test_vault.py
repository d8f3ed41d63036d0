from __future__ import annotations

import random

from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.plans import vault

SCHEMA = "film_id bigint, title string, status string"
DAYS = [f"2024-01-{k:02}" for k in range(1, 7)]


def load(spark, loads, days=DAYS):
    known = None
    for day, rows in zip(days, loads, strict=False):
        new = vault.satellite_rows(spark.createDataFrame(rows, SCHEMA), hash_key("film_id"), day, known).checkpoint()
        known = new if known is None else known.unionByName(new).checkpoint()
    return known


def state(satellite, day):
    return sorted(map(tuple, vault.as_of(satellite, day).select("film_id", "title", "status").collect()))


def test_every_state_can_be_read_back(spark):
    rng = random.Random(3)
    loads = [
        [(k, rng.choice(["a", "b", None]), rng.choice(["x", None])) for k in range(20) if rng.random() < 0.7]
        for _ in DAYS
    ]
    satellite = load(spark, loads)
    for day, rows in zip(DAYS, loads, strict=True):
        assert state(satellite, day) == sorted(rows)
    assert state(satellite, "2023-12-31") == []
    # A row for each change and no more.
    changes, last = 0, {}
    for rows in loads:
        now = {r[0]: r for r in rows}
        changes += sum(last.get(k) != now.get(k) for k in last.keys() | now.keys())
        last = now
    assert satellite.count() == changes


def test_a_load_can_be_repeated(spark):
    rows = [(1, "a", "x"), (2, None, None)]
    satellite = load(spark, [rows, rows[:1], rows])
    again = vault.satellite_rows(spark.createDataFrame(rows, SCHEMA), hash_key("film_id"), DAYS[2], satellite)
    assert again.count() == 0
    films = spark.createDataFrame([(1,), (1,), (2,), (None,)], "film_id bigint")
    hub = vault.hub_rows(films, "film_id", DAYS[0])
    assert sorted(r.film_id for r in hub.collect()) == [1, 2]
    more = films.union(spark.createDataFrame([(3,)], "film_id bigint"))
    assert [r.film_id for r in vault.hub_rows(more, "film_id", DAYS[1], hub).collect()] == [3]
    pairs = spark.createDataFrame([(1, "g"), (1, "g"), (1, None), (2, "g")], "film_id bigint, name string")
    links = vault.link_rows(pairs, ["film_id", "name"], DAYS[0])
    assert links.count() == 2
    assert vault.link_rows(pairs, ["film_id", "name"], DAYS[1], links).count() == 0
    assert links.join(hub, F.col("film_id_key") == hub.key).count() == 2


def test_events_see_what_was_valid_on_their_day(spark, no_broadcast):
    satellite = load(spark, [[(1, "a", "x"), (2, "p", "x")], [(1, "b", "x")], [(1, "b", "x"), (2, "q", "x")]])
    events = [(k, f, d) for k, (f, d) in enumerate((f, d) for f in (1, 2, 3) for d in ["2023-01-01", *DAYS[:4], None])]
    events += [(100 + k, 1, DAYS[k % 4]) for k in range(3000)]
    frame = spark.createDataFrame(events, "n bigint, film bigint, day string").withColumn("day", F.col("day").cast("date"))
    frame = frame.withColumn("key", hash_key("film"))
    found = vault.as_of_join(frame, satellite.drop("film_id", "status"), "key", "day")
    titles = {1: ["a", "b", "b", "b"], 2: ["p", None, "q", "q"], 3: [None] * 4}
    expected = {n: titles[f][DAYS.index(d)] if d in DAYS else None for n, f, d in events}
    assert {r.n: r.title for r in found.collect()} == expected
    assert found.count() == len(events)
