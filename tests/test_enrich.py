from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cinestar.functions.scalars import slice_of
from cinestar.operators import dense, enrich


def films(spark, n):
    return spark.range(n).select(
        F.col("id").alias("film_id"),
        F.when(F.col("id") != 2, F.format_string("tt%07d", "id")).alias("imdb_id"),
    )


def open_failing_resolver():
    opened = os.getpid()

    def resolve(bare):
        if bare == "0000004":
            raise KeyError("cover url")
        return f"u/{bare}/{opened}"

    return resolve


def test_lookup_failures_do_not_fail_the_job(spark):
    rows = {r["film_id"]: r for r in enrich.resolve_posters(films(spark, 6), open_failing_resolver, 3).collect()}
    assert len(rows) == 6
    assert rows[2]["url"] is None and rows[2]["error"] is None
    assert rows[4]["url"] is None and rows[4]["error"] == "KeyError: 'cover url'"
    assert rows[5]["url"].startswith("u/0000005/") and rows[5]["error"] is None


@pytest.mark.parametrize("slices", range(1, 8))
def test_slices_partition_the_films(spark, slices):
    """Every film in exactly one slice, one partition per slice."""
    found = enrich.resolve_posters(films(spark, 50), open_failing_resolver, slices)
    placed = found.select("film_id", "slice", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["film_id"] for r in placed) == list(range(50))
    assert all(r["slice"] == r["task"] and 0 <= r["slice"] < slices for r in placed)


def test_no_slices_is_an_error():
    with pytest.raises(ValueError):
        slice_of(None, 0)


def test_written_slices_read_back_as_one_table(spark, tmp_path):
    found = enrich.resolve_posters(films(spark, 20), open_failing_resolver, 4)
    written = enrich.write_slices(found, str(tmp_path / "urls"))
    assert written.columns == found.columns and written.count() == 20
    folders = sorted(str(p) for p in (tmp_path / "urls").glob("slice=*"))
    assert enrich.read_worker_outputs(spark, folders).count() == 20
    parts = [written.where(F.col("slice") == i) for i in range(4)]
    assert enrich.union_slices(parts).count() == 20


def test_table_lookup_and_place(spark):
    locations = spark.createDataFrame([("0000001", "a"), ("0000009", "b")], "bare string, url string")
    found = enrich.lookup_posters(films(spark, 4), locations)
    assert {(r["film_id"], r["url"]) for r in found.collect()} == {(0, None), (1, "a"), (2, None), (3, None)}
    placed = enrich.place_posters(films(spark, 5).select("film_id"), found)
    assert {tuple(r) for r in placed.collect()} == {(0, None), (1, "a"), (2, None), (3, None), (4, None)}


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_dense_keys_follow_the_order(spark, n):
    rows = spark.range(n).select((F.lit(5 * n) - F.col("id") * 3).alias("v")).repartition(7)
    keyed = sorted((r["id"], r["v"]) for r in dense.dense_key(rows, "v").collect())
    assert [k for k, _ in keyed] == list(range(n))
    assert [v for _, v in keyed] == sorted(v for _, v in keyed)


@pytest.mark.parametrize(("rows", "slices"), [(3, 2), (10, 3), (7, 7), (2, 5), (100, 6)])
def test_equal_ranges_lose_no_row(spark, rows, slices):
    sliced = dense.range_slices(spark.range(rows).withColumnRenamed("id", "v"), slices, "v")
    found = {r["id"]: r["slice"] for r in sliced.collect()}
    assert sorted(found) == list(range(rows))
    for i in range(slices):
        inside = {r["id"] for r in sliced.where(dense.range_slice("id", i, slices, rows)).collect()}
        assert inside == {key for key, number in found.items() if number == i}
