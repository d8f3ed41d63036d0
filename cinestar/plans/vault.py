"""The film model as a data vault: hubs, links and satellites that only ever grow.

A hub holds each business key once, a link each pair of keys once, a satellite a
row each time that what it describes has changed, with the date of the load. A
row says so by its hash, so nothing but keys and hashes is compared. A load is
an insert and can be repeated: what is there already is not inserted again.
Loads are made in the order of their dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.operators.changes import row_hash


def hub_rows(frame: DataFrame, business_key: str, date: str, known: DataFrame | None = None) -> DataFrame:
    """(key, business key, load_date) of the keys that the hub does not know yet."""
    keys = frame.select(business_key).where(F.col(business_key).isNotNull()).distinct()
    rows = keys.select(hash_key(business_key).alias("key"), business_key, F.lit(date).cast("date").alias("load_date"))
    return rows if known is None else rows.join(known.select("key"), "key", "anti")


def link_rows(
    frame: DataFrame, business_keys: Sequence[str], date: str, known: DataFrame | None = None
) -> DataFrame:
    """(key, <name>_key for each business key, load_date) of the combinations that are new."""
    complete = frame.select(*business_keys).na.drop().distinct()
    rows = complete.select(
        hash_key(*business_keys).alias("key"),
        *(hash_key(name).alias(f"{name}_key") for name in business_keys),
        F.lit(date).cast("date").alias("load_date"),
    )
    return rows if known is None else rows.join(known.select("key"), "key", "anti")


def _latest(satellite: DataFrame) -> DataFrame:
    """(key, hash, deleted) of each key's last row. Rows of a key are combined within tasks."""
    last = F.max(F.struct("load_date", "hash", "deleted")).alias("last")
    return satellite.groupBy("key").agg(last).select("key", "last.hash", "last.deleted")


def satellite_rows(
    frame: DataFrame, key: Column, date: str, known: DataFrame | None = None
) -> DataFrame:
    """(key, load_date, hash, deleted, attributes) of what differs from the last row of its key.

    `frame` holds one row per key with the attributes. A key that is not in the
    load any more gets a row that says so, without attributes.
    """
    attributes = frame.columns
    rows = frame.select(key.alias("key"), row_hash(frame, 1).alias("hash"), *attributes)
    day, alive = F.lit(date).cast("date").alias("load_date"), F.lit(False).alias("deleted")
    if known is None:
        return rows.select("key", day, "hash", alive, *attributes)
    last = _latest(known).select("key", F.col("hash").alias("old"), F.col("deleted").alias("gone"))
    both = rows.withColumn("here", F.lit(True)).join(last, "key", "full")
    same = F.col("old").eqNullSafe(F.col("hash")) & ~F.coalesce("gone", F.lit(True))
    here = F.coalesce("here", F.lit(False))
    new = both.where((here & ~same) | (~here & ~F.coalesce("gone", F.lit(True))))
    return new.select("key", day, "hash", (~here).alias("deleted"), *attributes)


def as_of(satellite: DataFrame, date: str) -> DataFrame:
    """Each key's attributes on a date: its last row up to then, unless that says it is gone."""
    attributes = [c for c in satellite.columns if c not in ("key", "load_date", "hash", "deleted")]
    rows = satellite.where(F.col("load_date") <= F.lit(date).cast("date"))
    last = F.max_by(F.struct("deleted", *attributes), "load_date").alias("last")
    found = rows.groupBy("key").agg(last).where(~F.col("last.deleted"))
    return found.select("key", *(f"last.{name}" for name in attributes))


def valid_ranges(satellite: DataFrame) -> DataFrame:
    """Satellite rows with `until`, the date of the next row of the key; null for the last one."""
    following = F.lead("load_date").over(Window.partitionBy("key").orderBy("load_date"))
    return satellite.withColumn("until", following).where(~F.col("deleted"))


def as_of_join(events: DataFrame, satellite: DataFrame, key: str, date: str) -> DataFrame:
    """Each event with the attributes that were valid on its own date; null where none were.

    An equality on the key with a range of dates beside it: the events of a hot
    key are split over tasks at run time, a key's few versions go to each part.
    """
    attributes = [c for c in satellite.columns if c not in ("key", "load_date", "hash", "deleted")]
    ranges = valid_ranges(satellite).select(F.col("key").alias("_key"), "load_date", "until", *attributes)
    valid = (F.col(date) >= F.col("load_date")) & (F.col("until").isNull() | (F.col(date) < F.col("until")))
    joined = events.join(ranges, (F.col(key) == F.col("_key")) & valid, "left")
    return joined.drop("_key", "load_date", "until")
