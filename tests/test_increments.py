from __future__ import annotations

import random
from collections import defaultdict

import pytest

from cinestar.operators import increments
from cinestar.operators.ratings import film_totals
from cinestar.sources import publish

SCHEMA = "film_id bigint, rating double"


def ratings(rng, n):
    return [(rng.choice([1, 1, rng.randrange(30), None]), rng.choice([0.5, 3.7, 4.1, None, -0.3])) for _ in range(n)]


def check(spark, path, runs):
    rows = [r for run in runs.values() for r in run]
    expected = {r.film_id: r for r in film_totals(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = {r.film_id: r for r in increments.read_totals(spark, path).collect()}
    assert found.keys() == expected.keys()
    for film, row in found.items():
        assert (row.freq, row.rated) == (expected[film].freq, expected[film].rated)
        assert row.rating == pytest.approx(expected[film].rating) if row.rated else row.rating is None


def test_replaced_runs_leave_nothing_behind(spark, tmp_path):
    rng, path, runs = random.Random(1), str(tmp_path), {}
    for run in ("a", "b", "c", "b", "a"):
        runs[run] = ratings(rng, 200)
        increments.add_run(spark.createDataFrame(runs[run], SCHEMA), path, {"run": run})
        check(spark, path, runs)
    # A run replaced by an empty one takes its films along.
    runs["c"] = []
    increments.add_run(spark.createDataFrame([], SCHEMA), path, {"run": "c"})
    check(spark, path, runs)
    increments.remove_old(spark, path)
    runs["b"] = ratings(rng, 50)
    increments.add_run(spark.createDataFrame(runs["b"], SCHEMA), path, {"run": "b"})
    check(spark, path, runs)


def test_a_batch_that_dies_between_its_steps_is_made_good(spark, tmp_path, monkeypatch):
    rng, path, runs = random.Random(2), str(tmp_path), {}
    runs["a"] = ratings(rng, 100)
    increments.add_run(spark.createDataFrame(runs["a"], SCHEMA), path, {"run": "a"})

    def die(*_):
        raise RuntimeError("died")

    for run in ("b", "a"):
        runs[run] = ratings(rng, 100)
        with monkeypatch.context() as broken:
            broken.setattr(increments, "bring_up_to_date", die)
            with pytest.raises(RuntimeError):
                increments.add_run(spark.createDataFrame(runs[run], SCHEMA), path, {"run": run})
    assert increments.bring_up_to_date(spark, path)
    check(spark, path, runs)
    assert not increments.bring_up_to_date(spark, path)


def test_ratings_of_other_runs_are_not_read(spark, tmp_path):
    """The totals need a run's sums: its ratings, and those of other runs, may be gone."""
    path = str(tmp_path / "state")
    sums = defaultdict(list)
    for run in "abc":
        facts = str(tmp_path / run)
        spark.range(10).selectExpr("id % 2 AS film_id", "CAST(id AS double) AS rating").write.parquet(facts)
        increments.add_run(spark.read.parquet(facts), path, {"run": run})
        for file in (tmp_path / run).glob("*.parquet"):
            file.write_bytes(b"")
        sums[run] = [20.0, 25.0]
    found = {r.film_id: (r.freq, r.rating_sum) for r in increments.read_totals(spark, path).collect()}
    assert found == {0: (15, 60.0), 1: (15, 75.0)}
    assert len(publish.ledger(spark, f"{path}/totals")) == 3
