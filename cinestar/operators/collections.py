"""Collections held in cells: parse, set unparsable rows aside, one row per element."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinestar.functions.literals import clean_literal, parse_literal
from cinestar.sources.infer import infer_schema


def film_id(column: str = "id") -> Column:
    """The film id of a raw table as a number; NULL where the text is none."""
    return F.col(column).try_cast("bigint")


def parse_column(
    frame: DataFrame,
    raw: str,
    element: T.StructType | str,
    parsed: str = "elements",
    policy: str = "exact",
) -> DataFrame:
    """Add the collection in cell `raw` as an array of structs.

    In a frame from `parse_collections` the cell is that array already.
    """
    if isinstance(frame.schema[raw].dataType, T.ArrayType):
        return frame.withColumn(parsed, F.col(raw))
    return frame.withColumn(parsed, parse_literal(F.col(raw), element, policy))


def parse_collections(
    frame: DataFrame, elements: Mapping[str, str], policy: str = "exact"
) -> DataFrame:
    """Replace raw cells by their collections, parsing each cell once.

    What did not parse is kept in `malformed`, as an array of (column, raw).
    """
    parsed = frame.withColumns(
        {f"_{name}": parse_literal(F.col(name), e, policy) for name, e in elements.items()}
    )
    malformed = [
        F.when(
            is_malformed(name, f"_{name}"),
            F.struct(F.lit(name).alias("column"), F.col(name).alias("raw")),
        )
        for name in elements
    ]
    return parsed.select(
        *[name for name in frame.columns if name not in elements],
        *[F.col(f"_{name}").alias(name) for name in elements],
        F.array_compact(F.array(*malformed)).alias("malformed"),
    )


def quarantine_cells(parsed: DataFrame) -> DataFrame:
    """The malformed cells of a frame from `parse_collections`: id, column, raw."""
    return parsed.select("id", F.explode("malformed").alias("cell")).select("id", "cell.*")


def parse_inferred(
    frame: DataFrame, raw: str, parsed: str = "elements", policy: str = "exact"
) -> DataFrame:
    """Like `parse_column`, with the schema found in the data by one extra pass."""
    text = clean_literal(F.col(raw), policy)
    # A bare object parses as a list of one, so it counts as one here.
    schema = infer_schema(frame, F.regexp_replace(text, r"(?s)^\s*(\{.*)$", "[$1]"))
    if not isinstance(getattr(schema, "elementType", None), T.StructType):
        raise ValueError(f"{raw} holds no collection of structs: {schema.simpleString()}")
    return frame.withColumn(parsed, F.from_json(text, schema))


def is_malformed(raw: str, parsed: str = "elements") -> Column:
    """The cell holds text that did not parse. An absent (NULL) cell is not malformed."""
    return F.col(parsed).isNull() & F.col(raw).isNotNull()


def split_quarantine(
    frame: DataFrame, raw: str, parsed: str = "elements"
) -> tuple[DataFrame, DataFrame]:
    """(usable rows, malformed rows); a row whose cell is absent is usable and has no element."""
    malformed = is_malformed(raw, parsed)
    return frame.where(~malformed), frame.where(malformed).drop(parsed)


def explode_elements(
    frame: DataFrame, keep: Sequence[str | Column], parsed: str = "elements"
) -> DataFrame:
    """One row per element: the kept columns, `position` from 0, `element`.

    NULL and empty collections yield no row. A NULL element yields a row.

    The outer form with a filter behind it, because for the plain form Spark
    puts `size(...) > 0` in front and so parses every cell a second time.
    """
    rows = frame.select(*keep, F.posexplode_outer(parsed).alias("position", "element"))
    return rows.where(F.col("position").isNotNull())


def film_elements(
    frame: DataFrame, raw: str, element: T.StructType | str, policy: str = "exact"
) -> DataFrame:
    """Parse and explode in one go: film_id, position, element."""
    parsed = parse_column(frame, raw, element, policy=policy)
    return explode_elements(parsed, [film_id().alias("film_id")])
