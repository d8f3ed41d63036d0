from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cinestar.operators.lookups import Lookups, answers, look_up, patient

START = datetime(2024, 1, 1)
SMALL = Lookups(slices=2, chunk_films=4, attempts=3, wait_hours=1.0, miss_days=10.0, retries=0)


def films(spark, n):
    ids = F.when(F.col("id") % 7 != 3, F.format_string("tt%07d", "id"))
    return spark.range(n).select(F.col("id").alias("film_id"), ids.alias("imdb_id"))


def service(log, errors=(), misses=(), dies_after=None):
    """A resolver that notes every id it is asked for; it may die as a whole, not with an error per film."""

    def opened():
        def resolve(bare):
            with open(log, "a") as file:
                file.write(bare + "\n")
            if int(bare) in errors:
                raise TimeoutError("slow")
            return None if int(bare) in misses else f"u/{bare}"

        if dies_after is not None and len(asked(log)) >= dies_after:
            raise SystemError("down")
        return resolve

    return opened


def asked(log):
    try:
        return [int(line) for line in open(log)]
    except FileNotFoundError:
        return []


@pytest.mark.parametrize("slices", [1, 2])
def test_a_service_that_dies_half_way_is_not_asked_again(spark, tmp_path, slices):
    path, log = str(tmp_path / "answers"), str(tmp_path / "log")
    settings = replace(SMALL, slices=slices)
    with pytest.raises(Exception, match="down"):
        look_up(films(spark, 40), service(log, dies_after=10), path, settings, START)
    first = asked(log)
    assert 10 <= len(first) < 30
    answered = {r.film_id for r in answers(spark, path).collect()}
    found = look_up(films(spark, 40), service(log), path, settings, START + timedelta(minutes=1)).collect()
    everything = [k for k in range(40) if k % 7 != 3]
    assert sorted(set(asked(log))) == everything
    # Of the chunk that was lost, one slice may have been asked for before the other died.
    twice = {k for k in everything if asked(log).count(k) > 1}
    assert not twice & answered and twice <= set(first) and (slices > 1 or not twice)
    assert {r.film_id: r.url for r in found} == {k: f"u/{k:07}" for k in everything}
    # A third run has nothing to ask for.
    before = len(asked(log))
    look_up(films(spark, 40), service(log), path, settings, START + timedelta(days=900))
    assert len(asked(log)) == before


def test_errors_wait_and_misses_expire(spark, tmp_path):
    path, log = str(tmp_path / "answers"), str(tmp_path / "log")

    def run(after, **faults):
        before = len(asked(log))
        found = look_up(films(spark, 8), service(log, **faults), path, SMALL, START + after)
        rows = {r.film_id: (r.url, r.error, r.tries) for r in found.collect()}
        return sorted(asked(log)[before:]), rows

    again, rows = run(timedelta(0), errors={1, 2}, misses={4})
    assert again == [0, 1, 2, 4, 5, 6, 7]
    assert rows[1] == (None, "TimeoutError: slow", 1) and rows[4] == (None, None, 1)
    assert run(timedelta(minutes=30))[0] == []
    again, rows = run(timedelta(hours=1), errors={1})
    assert again == [1, 2] and rows[2] == ("u/0000002", None, 2) and rows[1][2] == 2
    assert run(timedelta(hours=2))[0] == []  # two hours after the second error
    again, rows = run(timedelta(hours=3), errors={1})
    assert again == [1] and rows[1][2] == 3
    again, rows = run(timedelta(days=10))  # the miss has expired, the attempts at 1 are used up
    assert again == [4] and rows[4] == ("u/0000004", None, 2)
    # Under another outside id a film is asked for anew.
    other = films(spark, 8).withColumn("imdb_id", F.when(F.col("film_id") == 1, "tt0000099").otherwise(F.col("imdb_id")))
    found = look_up(other, service(log), path, SMALL, START + timedelta(days=11))
    assert asked(log)[-1] == 99 and {r.film_id: r.tries for r in found.collect()}[1] == 1


def test_errors_within_a_run_are_retried():
    calls = []

    def opened():
        def resolve(bare):
            calls.append(bare)
            if len(calls) < 3:
                raise ConnectionError
            return bare

        return resolve

    assert patient(opened, 2, 0.0)()("x") == "x" and len(calls) == 3
    calls.clear()
    with pytest.raises(ConnectionError):
        patient(opened, 1, 0.0)()("x")


def test_no_films(spark, tmp_path):
    assert look_up(films(spark, 0), service(str(tmp_path / "log")), str(tmp_path / "a"), SMALL, START).count() == 0
