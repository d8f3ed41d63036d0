"""What changed between two runs of an export, and how to bring derived tables up to date with it.

Rows of a key are compared as a whole, by a digest that does not depend on their
order: 64-bit hashes of the rows are added up, under two seeds, in decimals that
cannot overflow. Digests are combined within tasks before they are shuffled, so
a key with a third of all rows, or very many copies of one row, costs a row per
task, and no text ever moves. Only keys whose digests differ go further.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _plain(frame: DataFrame, name: str) -> Column:
    """A column in a form whose hash tells all its values apart, nulls inside of it included."""
    column = F.col(f"`{name}`")
    if isinstance(frame.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(F.struct(column), {"ignoreNullFields": "false"})
    return column


def row_hash(frame: DataFrame, seed: int, *leave_out: str) -> Column:
    """A 64-bit hash of a row. Spark's hash passes over nulls, so each column's null is hashed as well."""
    names = sorted(name for name in frame.columns if name not in leave_out)
    parts = [part for name in names for part in (F.col(f"`{name}`").isNull(), _plain(frame, name))]
    return F.xxhash64(F.lit(seed), *parts)


def digests(frame: DataFrame, key: str) -> DataFrame:
    """(key, rows, one, two): how many rows a key has, and the sums of their hashes."""
    total = "decimal(38,0)"
    rows = frame.select(key, *(row_hash(frame, seed, key).cast(total).alias(name) for seed, name in ((1, "one"), (2, "two"))))
    return rows.groupBy(key).agg(
        F.count("*").alias("rows"), F.sum("one").cast(total).alias("one"), F.sum("two").cast(total).alias("two")
    )


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change): the keys that are new, gone, or have other rows. A null key is a key like any other."""
    old, new = (
        digests(frame, key).select(F.col(key).alias(f"{side}_key"), F.struct("rows", "one", "two").alias(side))
        for frame, side in ((before, "old"), (after, "new"))
    )
    both = old.join(new, F.col("old_key").eqNullSafe(F.col("new_key")), "full")
    change = (
        F.when(F.col("old").isNull(), INSERT)
        .when(F.col("new").isNull(), DELETE)
        .when(F.col("old") != F.col("new"), UPDATE)
    )
    # Of a row that one side lacks, that side's key is null as well.
    name = F.when(F.col("new").isNotNull(), F.col("new_key")).otherwise(F.col("old_key"))
    return both.select(name.alias(key), change.alias("change")).where("change IS NOT NULL")


def of_keys(frame: DataFrame, keys: DataFrame, key: str, how: str = "semi") -> DataFrame:
    """The rows whose key is among `keys`, or with `how` = anti is not."""
    other = keys.select(F.col(key).alias("_other"))
    return frame.join(other, F.col(key).eqNullSafe(F.col("_other")), how)


def apply_changes(table: DataFrame, changes: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table with the rows of changed keys taken from `rows`; all other rows stay as they are.

    `rows` may hold all keys of the new run, or only the changed ones.
    """
    arriving = of_keys(rows, changes.where(F.col("change") != DELETE), key)
    return of_keys(table, changes, key, "anti").unionByName(arriving)


def refresh(
    table: DataFrame,
    changes: DataFrame,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    key: str,
    source_key: str,
) -> DataFrame:
    """A derived table after a run: `build` sees the changed keys' rows of the new export only.

    `build` must work key by key. So what is costly, the cleaning and parsing of
    cells, is done for what has changed and for nothing else.
    """
    wanted = changes.where(F.col("change") != DELETE).select(F.col(key).cast("string").alias("_wanted"))
    few = source.join(wanted, F.col(source_key).cast("string").eqNullSafe(F.col("_wanted")), "semi")
    return of_keys(table, changes, key, "anti").unionByName(build(few))
