from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cinestar.functions.literals import clean_literal
from cinestar.operators.collections import (
    explode_elements,
    film_elements,
    parse_collections,
    parse_column,
    parse_inferred,
    quarantine_cells,
    split_quarantine,
)
from cinestar.sources import schemas
from cinestar.sources.infer import infer_schema

CELLS = [
    ("1", "[{'id': 1, 'name': 'a'}, {'id': 2, 'name': None}]"),
    ("2", "[]"),
    ("3", None),
    ("4", "[{'id': 1, 'name': 'cut"),
    ("5", "[None, {'id': 3}]"),
    ("6", ""),
]


def frame(spark):
    return spark.createDataFrame(CELLS, "id string, cell string")


def test_quarantine_keeps_malformed_apart_from_absent(spark):
    parsed = parse_column(frame(spark), "cell", schemas.ID_NAME)
    usable, malformed = split_quarantine(parsed, "cell")
    assert {r["id"] for r in usable.collect()} == {"1", "2", "3", "5"}
    assert {(r["id"], r["cell"]) for r in malformed.collect()} == {
        ("4", "[{'id': 1, 'name': 'cut"),
        ("6", ""),
    }


def test_quarantine_of_several_columns(spark):
    rows = spark.createDataFrame(
        [("1", "[]", "oops"), ("2", "[", None), ("3", None, "[{'id': 1}]")], "id string, a string, b string"
    )
    parsed = parse_collections(rows, {"a": schemas.ID_NAME, "b": schemas.ID_NAME})
    found = quarantine_cells(parsed)
    assert {tuple(r) for r in found.collect()} == {("1", "b", "oops"), ("2", "a", "[")}
    assert [r["b"] for r in parsed.orderBy("id").collect()] == [None, None, [(1, None)]]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2
    again = film_elements(parsed, "b", schemas.NAMED).collect()
    assert [(r["film_id"], r["position"], r["element"]["id"]) for r in again] == [(3, 0, 1)]


def test_explode_gives_one_row_per_element(spark):
    parsed = parse_column(frame(spark), "cell", schemas.ID_NAME)
    rows = explode_elements(parsed, ["id"]).collect()
    assert {(r["id"], r["position"], r["element"] and tuple(r["element"])) for r in rows} == {
        ("1", 0, (1, "a")),
        ("1", 1, (2, None)),
        ("5", 0, None),
        ("5", 1, (3, None)),
    }
    sizes = parsed.agg(F.sum(F.greatest(F.size("elements"), F.lit(0)))).first()[0]
    assert len(rows) == sizes


def test_explode_parses_a_cell_once(spark):
    """No filter that repeats the parser in front of the generator."""
    rows = explode_elements(parse_column(frame(spark), "cell", schemas.ID_NAME), ["id"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_inferred_schema(spark):
    cells = [
        "[{'iso': 'a', 'n': 1, 'x': None}]",
        "[{'iso': 'b', 'n': 2.5}, {'extra': {'k': True}}]",
        None,
        "[]",
        "broken",
    ]
    rows = spark.createDataFrame([(cell,) for cell in cells], "cell string")
    schema = infer_schema(rows, clean_literal(F.col("cell")))
    assert schema.simpleString() == (
        "array<struct<extra:struct<k:boolean>,iso:string,n:double,x:string>>"
    )
    parsed = parse_inferred(rows, "cell").select(F.explode("elements").alias("e"))
    assert [r[0] for r in parsed.select("e.iso").collect()] == ["a", "b", None]


def test_inference_needs_a_collection(spark):
    rows = spark.createDataFrame([("x",), (None,), ("[1, 2]",)], "cell string")
    with pytest.raises(ValueError, match="no collection of structs"):
        parse_inferred(rows, "cell")
    mixed = spark.createDataFrame([("{'a': 1}",), ("[{'a': 2}, {'b': 'x'}]",)], "cell string")
    found = [[tuple(e) for e in r["elements"]] for r in parse_inferred(mixed, "cell").collect()]
    assert sorted(found) == [[(1, None)], [(2, None), (None, "x")]]
