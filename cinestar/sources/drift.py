"""Schema drift of collection columns: what each run's elements hold, and what no declared field takes.

A run's element schema is one aggregate over its cells, combined within tasks
(`infer_schema`), and is published as a small table of fields under the run's
name. Two runs are compared field by field. Elements are parsed into the declared
fields as ever; what would be lost, a field that is not declared or a value that
is not of its field's type, stays as a `variant` under its name.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinestar.functions.literals import clean_literal
from cinestar.sources import publish
from cinestar.sources.infer import infer_schema

NEW, GONE, TYPE = "new", "gone", "type"


def flat_fields(kind: T.DataType, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, type) of every field; `[]` stands for the elements of an array."""
    if isinstance(kind, T.ArrayType):
        yield from flat_fields(kind.elementType, f"{path}[]")
    elif isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from flat_fields(field.dataType, f"{path}.{field.name}")
    else:
        yield path, kind.simpleString()


def cell_variant(column: str, policy: str = "exact") -> Column:
    """A cell as a variant; NULL where it does not parse."""
    return F.from_json(clean_literal(F.col(column), policy), "variant")


def run_fields(frame: DataFrame, column: str, policy: str = "exact") -> DataFrame:
    """(field, type) of a run's cells; a run without any parsable cell has no fields."""
    spark, schema = frame.sparkSession, "field string, type string"
    cells = frame.where(cell_variant(column, policy).isNotNull())
    if cells.isEmpty():
        return spark.createDataFrame([], schema)
    kind = infer_schema(cells, clean_literal(F.col(column), policy))
    return spark.createDataFrame(list(flat_fields(kind)), schema)


def note_run(frame: DataFrame, column: str, path: str, run: str, policy: str = "exact") -> None:
    """Publish the fields of a run's column, in place of an earlier version of that run."""
    publish.publish(run_fields(frame, column, policy), path, {"run": run})


def differences(spark: SparkSession, path: str, before: str, after: str) -> DataFrame:
    """(field, change, before, after): fields that are new, gone, or of another type in the later run."""
    fields = publish.read_published(spark, path)
    one, two = (
        fields.where(F.col("run") == run).select("field", F.col("type").alias(name))
        for run, name in ((before, "before"), (after, "after"))
    )
    change = (
        F.when(F.col("before").isNull(), NEW)
        .when(F.col("after").isNull(), GONE)
        .when(F.col("before") != F.col("after"), TYPE)
    )
    both = one.join(two, "field", "full").withColumn("change", change)
    return both.where("change IS NOT NULL").select("field", "change", "before", "after")


def parse_keeping(
    frame: DataFrame, column: str, declared: Mapping[str, str], into: str = "elements", policy: str = "exact"
) -> DataFrame:
    """Add the collection in a cell as an array of structs: the declared fields, and `rest`.

    `rest` is a map of variants: the fields that are not declared, and the values
    that their declared type does not take. Nothing of a cell that parses is lost,
    and one odd value no longer costs the whole cell. A bare object is a list of one.
    """
    cell = cell_variant(column, policy)
    elements = F.coalesce(
        F.try_variant_get(cell, "$", "array<variant>"), F.array(cell)
    )

    def struct(element: Column) -> Column:
        fields = F.try_variant_get(element, "$", "map<string,variant>")
        typed = {name: F.try_variant_get(fields[name], "$", kind) for name, kind in declared.items()}

        def lost(name: Column, value: Column) -> Column:
            keeps = F.lit(True)
            for own, column_ in typed.items():
                keeps = F.when(name == own, column_.isNull() & ~F.is_variant_null(value)).otherwise(keeps)
            return keeps

        rest = F.map_filter(fields, lost)
        return F.struct(*(value.alias(name) for name, value in typed.items()), rest.alias("rest"))

    parsed = F.when(cell.isNotNull(), F.transform(elements, struct))
    return frame.withColumn(into, parsed)
