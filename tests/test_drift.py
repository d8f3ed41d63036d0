from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinestar.sources import drift

DECLARED = {"id": "int", "name": "string"}


def cells(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "film int, cell string")


def parsed(spark, texts):
    rows = drift.parse_keeping(cells(spark, texts), "cell", DECLARED).select("film", F.posexplode_outer("elements"))
    rows = rows.select("film", "col.id", "col.name", F.map_entries("col.rest").alias("rest"))
    rows = rows.select("film", "id", "name", F.transform("rest", lambda e: F.concat(e.key, F.lit("="), F.to_json(e.value))).alias("rest"))
    return [(r.film, r.id, r.name, sorted(r.rest) if r.rest is not None else None) for r in rows.collect()]


def test_what_no_field_takes_stays(spark):
    texts = [
        "[{'id': 1, 'name': 'a'}, {'id': 2, 'name': None, 'iso': 'x'}]",
        "[{'id': 'zz', 'name': \"D's\", 'more': {'k': [1, 2]}}]",
        "{'id': 7, 'name': 'o'}",
        "[]",
        "abc",
        None,
        "[{'name': 'only'}]",
    ]
    rows = parsed(spark, texts)
    assert sorted(rows, key=repr) == sorted(
        [
            (0, 1, "a", []),
            (0, 2, None, ['iso="x"']),
            (1, None, "D's", ['id="zz"', 'more={"k":[1,2]}']),
            (2, 7, "o", []),
            (3, None, None, None),
            (4, None, None, None),
            (5, None, None, None),
            (6, None, "only", []),
        ],
        key=repr,
    )


def test_runs_are_compared_field_by_field(spark, tmp_path):
    path = str(tmp_path)
    first = ["[{'id': 1, 'name': 'a', 'old': 1.5}]", None, "broken"]
    second = ["[{'id': 'x', 'name': 'a', 'new': {'deep': true}}]", "[{'id': 2}]"]
    drift.note_run(cells(spark, first), "cell", path, "1", "none")
    drift.note_run(cells(spark, second), "cell", path, "2", "none")
    drift.note_run(cells(spark, ["broken"]), "cell", path, "3")
    found = {r.field: (r.change, r.before, r.after) for r in drift.differences(spark, path, "1", "2").collect()}
    assert found == {
        "[].old": ("gone", "double", None),
        "[].new.deep": ("new", None, "boolean"),
        "[].id": ("type", "bigint", found["[].id"][2]),
    }
    assert found["[].id"][2] != "bigint"
    assert {r.change for r in drift.differences(spark, path, "1", "3").collect()} == {"gone"}
    assert drift.differences(spark, path, "2", "2").count() == 0


def test_flat_fields(spark):
    kind = T.DataType.fromDDL("array<struct<a:int,b:struct<c:array<string>>>>")
    assert list(drift.flat_fields(kind)) == [("[].a", "int"), ("[].b.c[]", "string")]
    assert list(drift.flat_fields(T.LongType())) == [("", "bigint")]
