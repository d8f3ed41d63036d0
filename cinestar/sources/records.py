"""Quoted CSV with line breaks inside values, read by many tasks per file.

Spark splits a file into blocks of whole lines, but a line may begin inside a
quoted value. Whether it does follows from all lines before it, by an
associative map: a line, a block or a row of blocks turns "begins outside a
value" and "begins inside one" each into the state after it.

1. Each block's map is computed where the block is read, without knowing what
   comes before it: one row per block.
2. The maps of a file's blocks are composed in order, which gives the state at
   every block's start. The blocks that begin inside a value go to the tasks: a
   flag for some of the splits, all of which the driver has listed already.
3. Each block is read again and its lines are put together to records. A record
   that crosses a block's end leaves a piece in each block it touches; the
   pieces, two a block at most, are joined in a shuffle of their own.
4. Spark's own CSV parser turns the records into columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinestar.sources.csv import QUOTING
from cinestar.sources.tables import overwrite_parquet
from cinestar.session import scratch_path

_OUTSIDE, _INSIDE = 0, 1
# Kinds of rows: a whole record, or a piece of one that began before, fills the block, goes on after it.
_WHOLE, _HEAD, _MIDDLE, _TAIL = range(4)


def _line_map(delimiter: str):
    """(line, state at its start) -> state at its end."""
    # From the start of a value: a quoted one that ends, or an unquoted one (quotes in it mean nothing).
    # Nothing is given back once matched: a doubled quote is never the end of a value and a quote after it.
    end = re.escape(delimiter)
    value = rf'(?:"(?:[^"]|"")*+"[^{end}]*+|[^"{end}][^{end}]*+|)'
    closed = re.compile(rf"{value}(?:{end}{value})*+\Z", re.DOTALL)

    def after(line: str, state: int) -> int:
        if '"' not in line:
            return state
        # A line inside a value goes on as one that a quote has opened.
        return _OUTSIDE if closed.match(line if state == _OUTSIDE else f'"{line}') else _INSIDE

    return after


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, line): lines in order, with the file and block that they lie in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def block_maps(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """(file, start, from_outside, from_inside): the state after each block, by the state before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, block, states = _line_map(delimiter), None, [_OUTSIDE, _INSIDE]

        def out() -> pa.RecordBatch:
            columns = [[block[0]], [block[1]], [states[0]], [states[1]]]
            types = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["file", "start", "from_outside", "from_inside"])

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line")), strict=True)
            for file, start, line in rows:
                if block != (file, start):
                    if block:
                        yield out()
                    block, states = (file, start), [_OUTSIDE, _INSIDE]
                if '"' in line:
                    states = [after(line, s) for s in states]
        if block:
            yield out()

    return lines.mapInArrow(run, "file string, start bigint, from_outside int, from_inside int")


def blocks_begun_inside(maps: DataFrame) -> DataFrame:
    """(file, start) of the blocks whose first line lies inside a value.

    A prefix of maps either keeps, swaps or sets the state. The state after it is
    what the last setting map has set, swapped as often as maps have swapped since.
    """
    swaps = (F.col("from_outside") == _INSIDE) & (F.col("from_inside") == _OUTSIDE)
    sets = F.col("from_outside") == F.col("from_inside")
    order = Window.partitionBy("file").orderBy("start")
    upto, before = (order.rowsBetween(Window.unboundedPreceding, k) for k in (0, -1))
    since = maps.withColumn("swaps", F.sum(swaps.cast("long")).over(upto))
    last = F.last(F.when(sets, F.struct(F.col("from_outside").alias("state"), "swaps")), True).over(before)
    rows = since.withColumns({"last": last, "swapped": F.lag("swaps", 1, 0).over(order)})
    state = F.coalesce("last.state", F.lit(_OUTSIDE)) + F.col("swapped") - F.coalesce("last.swaps", F.lit(0))
    return rows.where(F.pmod(state, F.lit(2)) == _INSIDE).select("file", "start")


def _pieces(lines: DataFrame, inside: frozenset[tuple[str, int]], delimiter: str) -> DataFrame:
    """(file, start, kind, first, text): the records of each block, and pieces at its ends.

    `first` marks the first record of a file.
    """
    shared = lines.sparkSession.sparkContext.broadcast(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, inside_ = _line_map(delimiter), shared.value
        rows: list[tuple] = []
        block, state, open_lines, began_before, n = None, _OUTSIDE, [], False, 0

        def put(kind: int) -> None:
            nonlocal open_lines, began_before, n
            text = "\n".join(open_lines)
            whole = kind in (_WHOLE, _HEAD)
            # The line end of a record, not of a line inside a value, may be of two characters.
            text = text[:-1] if whole and text.endswith("\r") else text
            rows.append((*block, kind, block[1] == 0 and n == 0 and kind in (_WHOLE, _TAIL), text))
            open_lines, began_before, n = [], False, n + 1

        def end_of_block() -> None:
            if block and open_lines:
                put(_MIDDLE if began_before else _TAIL)

        def out() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["file", "start", "kind", "first", "text"])

        for batch in batches:
            for file, start, line in zip(
                *(batch.column(c).to_pylist() for c in ("file", "start", "line")), strict=True
            ):
                if block != (file, start):
                    end_of_block()
                    block, open_lines, n = (file, start), [], 0
                    state = _INSIDE if block in inside_ else _OUTSIDE
                    began_before = state == _INSIDE
                open_lines.append(line)
                state = after(line, state)
                if state == _OUTSIDE:
                    put(_HEAD if began_before else _WHOLE)
            if len(rows) >= 2000:
                yield out()
                rows.clear()
        end_of_block()
        if rows:
            yield out()

    return lines.mapInArrow(run, "file string, start bigint, kind int, first boolean, text string")


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross blocks' ends: a tail, the blocks it fills, and the head that ends it."""
    order = Window.partitionBy("file").orderBy("start", "kind")
    ends = pieces.where(F.col("kind") != _WHOLE).withColumn(
        "record", F.sum((F.col("kind") == _TAIL).cast("long")).over(order)
    )
    parts = ends.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "text"))).alias("parts"), F.max("first").alias("first")
    )
    return parts.select("first", F.array_join(F.col("parts.text"), "\n").alias("text"))


def read_records(
    spark: SparkSession,
    path: str | list[str],
    header: Sequence[str] | None = None,
    delimiter: str = ",",
    require: Sequence[str] = (),
) -> DataFrame:
    """Every column as string, like `read_csv(..., header=header, multiline=True)`, files split into blocks.

    Each file begins with a header line of these columns; one that names others
    raises an error when the rows are read. Without `header`, the first line of
    one file gives the names. Line breaks inside values are kept as they are.
    Blank lines outside values are no records. Quotes inside a value are doubled; a quote within an unquoted value
    is a character like any other.
    """
    if header is None:
        header = spark.read.options(**QUOTING, sep=delimiter, multiLine="true").csv(path).columns
    missing = [name for name in require if name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    lines = _lines(spark, path)
    maps = overwrite_parquet(block_maps(lines, delimiter), scratch_path(spark, "blocks"))
    begun = blocks_begun_inside(maps).toLocalIterator()
    inside = frozenset((row["file"], row["start"]) for row in begun)
    pieces = _pieces(lines, inside, delimiter)
    # Pieces are few; the whole records never pass a shuffle.
    whole = pieces.where(F.col("kind") == _WHOLE).select("first", "text")
    records = whole.union(_joined(pieces)).where("text <> ''")
    schema = ", ".join(f"`{name}` string" for name in header)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    row: Column = F.from_csv("text", schema, options)
    parsed = records.select("first", row.alias("row"))
    # The header is a record like any other until it is known to be the first of its file.
    names = F.array(*[F.col(f"row.`{name}`") for name in header])
    named = names.eqNullSafe(F.array(*map(F.lit, header)))
    wrong = F.raise_error(F.lit(f"{path}: the header is not {', '.join(header)}")).cast("boolean")
    rows = parsed.where(F.when(F.col("first"), F.when(named, F.lit(False)).otherwise(wrong)).otherwise(True))
    return rows.select(*[F.col(f"row.`{name}`").alias(name) for name in (require or header)])
