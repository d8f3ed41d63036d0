from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from cinestar.sources import publish as p


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a bigint").repartition(3)


def failing(spark):
    """Rows of which some are written before one of them fails."""
    frame = spark.range(1000).repartition(8)
    bad = F.raise_error(F.lit("boom")).cast("bigint")
    return frame.select(F.when(F.col("id") == 999, bad).otherwise(F.col("id")).alias("a"))


def values(frame):
    return sorted(r.a for r in frame.collect())


def test_a_run_that_dies_leaves_the_last_one(spark, path):
    p.publish(rows(spark, 1, 2), path)
    with pytest.raises(Exception, match="boom"):
        p.publish(failing(spark), path)
    assert values(p.read_published(spark, path)) == [1, 2]
    # What it has written is not named by the ledger and goes when it is old enough.
    left = [d for d in os.listdir(path) if d.startswith("version=")]
    assert len(left) == 2
    assert p.expire(spark, path) == []
    assert len(p.expire(spark, path, orphan_seconds=0)) == 1
    assert values(p.read_published(spark, path)) == [1, 2]


def test_nothing_published(spark, path):
    with pytest.raises(ValueError, match="nothing has been published"):
        p.read_published(spark, path)
    with pytest.raises(Exception, match="boom"):
        p.publish(failing(spark), path)
    with pytest.raises(ValueError, match="nothing has been published"):
        p.read_published(spark, path)


def test_versions_and_rolling_back(spark, path):
    for k in (1, 2, 3):
        assert p.publish(rows(spark, k), path, note=f"run {k}").number == k
    assert [v.note for v in p.ledger(spark, path)] == ["run 1", "run 2", "run 3"]
    assert values(p.read_published(spark, path, at=2)) == [2]
    assert p.roll_back(spark, path, to=1).number == 4
    assert values(p.read_published(spark, path)) == [1]
    both = p.read_versions(spark, path, p.ledger(spark, path)[1:3])
    assert sorted(map(tuple, both.collect())) == [(2, 2), (3, 3)]
    with pytest.raises(ValueError, match="no version 9"):
        p.roll_back(spark, path, to=9)


def test_runs_are_replaced_one_by_one(spark, path):
    p.publish(rows(spark, 1), path, {"day": "a"})
    p.publish(rows(spark, 2), path, {"day": "b"})
    p.publish(rows(spark, 3, 4).withColumn("day", F.lit("ignored")), path, {"day": "a"})
    with pytest.raises(Exception, match="boom"):
        p.publish(failing(spark), path, {"day": "b"})
    found = p.read_published(spark, path)
    assert sorted(map(tuple, found.select("day", "a").collect())) == [("a", 3), ("a", 4), ("b", 2)]
    assert sorted(map(tuple, p.read_published(spark, path, at=2).select("day", "a").collect())) == [("a", 1), ("b", 2)]
    # A run without rows is an empty run, not the one before.
    p.publish(rows(spark, 9).where("a < 0"), path, {"day": "b"})
    assert values(p.read_published(spark, path)) == [3, 4]


def test_old_versions_go_and_kept_ones_stay(spark, path):
    for k in range(5):
        p.publish(rows(spark, k), path)
    p.publish(rows(spark, 77), path, note="last")
    assert len(p.expire(spark, path, keep=2)) == 4
    assert [v.number for v in p.ledger(spark, path)] == [5, 6]
    assert values(p.read_published(spark, path, at=5)) == [4]
    assert p.publish(rows(spark, 8), path).number == 7
    # A folder that a rolled-back version still names is kept.
    p.roll_back(spark, path, to=5)
    assert len(p.expire(spark, path, keep=1)) == 2
    assert values(p.read_published(spark, path)) == [4]


def test_two_writers_get_two_numbers(spark, path, monkeypatch):
    p.publish(rows(spark, 1), path)
    create, beaten = p._Files.create, []

    def late(self, name, text):
        if not beaten:
            beaten.append(create(self, name, text.replace('"note": "mine"', '"note": "theirs"')))
        return create(self, name, text)

    monkeypatch.setattr(p._Files, "create", late)
    assert p.publish(rows(spark, 2), path, note="mine").number == 3
    assert [v.note for v in p.ledger(spark, path)] == ["", "theirs", "mine"]


def test_tables_follow_their_versions(spark, path):
    name = f"published_{uuid.uuid4().hex}"
    p.publish(rows(spark, 1), path)
    assert values(p.point_table(spark, name, path)) == [1]
    p.publish(rows(spark, 2, 3), path)
    assert values(spark.table(name)) == [1]  # until it is switched
    assert values(p.point_table(spark, name, path)) == [2, 3]
    p.publish(rows(spark, 5).withColumn("b", F.lit("x")), path)
    assert [tuple(r) for r in p.point_table(spark, name, path).collect()] == [(5, "x")]
    spark.sql(f"DROP TABLE {name}")


def test_partitions_follow_their_runs(spark, path):
    name = f"published_{uuid.uuid4().hex}"
    p.publish(rows(spark, 1), path, {"day": "a"})
    p.point_table(spark, name, path)
    p.publish(rows(spark, 2), path, {"day": "b"})
    p.publish(rows(spark, 3), path, {"day": "a"})
    found = p.point_table(spark, name, path)
    assert sorted(map(tuple, found.select("day", "a").collect())) == [("a", 3), ("b", 2)]
    plan = found.where("day = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    spark.sql(f"DROP TABLE {name}")


def test_buckets_join_without_a_shuffle_after_a_switch(spark, path, no_broadcast):
    names = [f"published_{uuid.uuid4().hex}" for _ in "12"]
    for run in (1, 2):
        for name in names:
            frame = spark.range(100).select(F.col("id").alias("a"), (F.col("id") * run).alias(f"b{name[-3:]}"))
            p.publish(frame, f"{path}/{name}", bucket_by="a", buckets=4)
            p.point_table(spark, name, f"{path}/{name}")
    joined = spark.table(names[0]).join(spark.table(names[1]), "a")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.agg(F.sum(f"b{names[0][-3:]}")).first()[0] == 2 * 4950
    for name in names:
        spark.sql(f"DROP TABLE {name}")
