"""Votes kept up run by run: sums that can be added, taken off and added again.

Each run of ratings gives a small table of sums per film, published under the
run's name (`publish`). The totals are the sums over the current version of
every run. They are kept up by differences: the sums of a new version of a run
are added, those of the version it replaces taken off, and no rating of another
run is read again. The published totals name the versions that are in them, so a
batch that dies between the two steps is made good by the next one, and no run
counts twice.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinestar.operators.ratings import mean_of
from cinestar.sources import publish

# Exact sums: a difference of them leaves nothing behind.
_SUM = "decimal(38,6)"


def run_sums(facts: DataFrame) -> DataFrame:
    """(film_id, freq, rated, rating_sum) of rating rows; a hot film is combined within tasks first."""
    return facts.groupBy("film_id").agg(
        F.count("*").alias("freq"),
        F.count("rating").alias("rated"),
        F.coalesce(F.sum(F.col("rating").cast("decimal(18,6)")), F.lit(0)).cast(_SUM).alias("rating_sum"),
    )


def _signed(sums: DataFrame, sign: int) -> DataFrame:
    columns = [(F.lit(sign) * F.col(name)).cast(kind).alias(name) for name, kind in _KINDS.items()]
    return sums.select("film_id", *columns)


_KINDS = {"freq": "bigint", "rated": "bigint", "rating_sum": _SUM}


def _added(parts: list[DataFrame]) -> DataFrame:
    """Sums of sums; films that nothing is left of are dropped."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    total = rows.groupBy("film_id").agg(*(F.sum(name).cast(kind).alias(name) for name, kind in _KINDS.items()))
    return total.where("freq <> 0")


def add_run(facts: DataFrame, path: str, run: Mapping[str, str]) -> None:
    """Publish the sums of a run, in place of an earlier version of it, and bring the totals up to date."""
    publish.publish(run_sums(facts), f"{path}/runs", run)
    bring_up_to_date(facts.sparkSession, path)


def bring_up_to_date(spark: SparkSession, path: str) -> bool:
    """Add to the totals what they lack of the published runs; False if they lack nothing."""
    runs = {json.dumps(v.run, sort_keys=True): v for v in publish.current(publish.ledger(spark, f"{path}/runs"))}
    done = publish.ledger(spark, f"{path}/totals")
    counted: dict[str, int] = json.loads(done[-1].note) if done else {}
    versions = {v.number: v for v in publish.ledger(spark, f"{path}/runs")}
    changed = {run: v for run, v in runs.items() if counted.get(run) != v.number}
    if not changed:
        return False
    parts = [publish.read_published(spark, f"{path}/totals")] if done else []
    for run, version in changed.items():
        parts.append(_signed(publish.read_versions(spark, f"{path}/runs", [version]), 1))
        if run in counted:
            # The replaced version is still there: old versions are removed only once no totals name them.
            parts.append(_signed(publish.read_versions(spark, f"{path}/runs", [versions[counted[run]]]), -1))
    now = {run: version.number for run, version in runs.items()}
    publish.publish(_added(parts), f"{path}/totals", note=json.dumps(now, sort_keys=True))
    return True


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """(film_id, freq, rated, rating_sum, rating), as `ratings.film_totals` gives over all current runs."""
    totals = publish.read_published(spark, f"{path}/totals").withColumn("rating_sum", F.col("rating_sum").cast("double"))
    return totals.withColumn("rating", mean_of("rating_sum", "rated"))


def remove_old(spark: SparkSession, path: str) -> None:
    """Remove versions that neither the totals nor a reader of the last totals need."""
    publish.expire(spark, f"{path}/totals")
    publish.expire(spark, f"{path}/runs")
