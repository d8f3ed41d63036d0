"""Line dedup by site-relative frequency.

The rows of a host are its pages. A line that occurs on more than `max_ratio`
of a host's pages, and on at least `min_pages` of them, is boilerplate of that
host and is dropped from all its pages, every occurrence. Lines without a word
are layout: they are neither counted nor dropped.

Counting shuffles a 64-bit hash per distinct line of a page, combined within
tasks, so a line shared by a third of all rows costs one row per task. Hashes
that pass the limit are then counted again by their whole line, which rules
out collisions. A host with p pages of at most n lines has at most
n / max_ratio such lines, whatever p is. They reach the pages as one array per
host through a join on the host; Spark broadcasts that side if its file is
small, otherwise it splits the rows of a hot host.

With `distinct_pages` the pages of a host are its distinct texts, each counted
once however often it is copied: the lines of a copied article are no
boilerplate. A 128-bit digest of the text tells pages apart; a line is then
shuffled once per page and task, and counted by its whole key as before.

Defined results: a null text stays null and an empty one empty, a row without
host is no page of any host and stays as it is; repeated rows are pages of
their own, but for `distinct_pages`; a text all of whose lines are dropped becomes empty; an empty table
gives no rows. Columns named like a result are replaced, others kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.llm.frames import SPACES, fresh, staged


@dataclass(frozen=True)
class Boilerplate:
    max_ratio: float = 0.02
    min_pages: int = 10
    distinct_pages: bool = False


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def has_word(line: Column) -> Column:
    return line.rlike(f"[^{SPACES}]")


def boilerplate_lines(
    pages: DataFrame, settings: Boilerplate, text: str, host: str
) -> DataFrame:
    """One row per host with boilerplate: (host, lines)."""
    rows = pages.where(F.col(host).isNotNull()).select(
        F.col(host).alias("host"), F.col(text).alias("text")
    )
    digest = F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))
    rows = rows.withColumn("page", digest) if settings.distinct_pages else rows
    page = ["page"] if settings.distinct_pages else []
    distinct = F.array_distinct(F.filter(lines_of(F.col("text")), has_word))

    def count_pages(found: DataFrame, keys: list[str], name: str) -> DataFrame:
        found = found.select(*keys, *page)
        if settings.distinct_pages:
            found = found.distinct()
        return found.groupBy(*keys).agg(F.count("*").alias(name))

    sizes = count_pages(rows, ["host"], "pages")

    def frequent(counts: DataFrame) -> DataFrame:
        often = (F.col("on_pages") > settings.max_ratio * F.col("pages")) & (
            F.col("on_pages") >= settings.min_pages
        )
        return counts.join(sizes, "host").where(often)

    hashed = F.explode(F.transform(distinct, lambda line: F.xxhash64(line))).alias("hash")
    hashes = frequent(count_pages(rows.select("host", *page, hashed), ["host", "hash"], "on_pages"))
    hashes = staged(hashes.select("host", "hash"), "line-hashes")
    lines = rows.select("host", *page, F.explode(distinct).alias("line"))
    lines = lines.withColumn("hash", F.xxhash64("line")).join(hashes, ["host", "hash"], "semi")
    counted = count_pages(lines, ["host", "line"], "on_pages")
    return frequent(counted).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame,
    settings: Boilerplate = Boilerplate(),
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """Every row with the cleaned text and `n_dropped_lines`."""
    found = staged(boilerplate_lines(pages, settings, text, host), "boilerplate")
    key, listed, kept = (fresh(pages, n) for n in ("_host", "_lines", "_kept"))
    found = found.select(F.col("host").alias(key), F.col("lines").alias(listed))
    rows = pages.join(found, F.col(host) == F.col(key), "left")
    unlisted = F.filter(lines_of(F.col(text)), lambda line: ~F.array_contains(F.col(listed), line))
    rows = rows.withColumn(kept, F.when(F.col(listed).isNotNull(), unlisted))
    dropped = F.size(lines_of(F.col(text))) - F.size(kept)
    return rows.withColumns(
        {
            "n_dropped_lines": F.when(F.col(kept).isNotNull(), dropped).otherwise(0).cast("long"),
            text: F.when(F.col(kept).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text)),
        }
    ).drop(key, listed, kept)
