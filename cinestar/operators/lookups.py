"""Outside lookups that go on where an earlier run has stopped.

Films are asked for in chunks, one Spark job each, and a chunk's answers are
published before the next one is begun (`publish`). A run that dies loses the
chunk that it was at and nothing else. The published answers are the ledger of
attempts: when a film was asked for, how often, and what came back. A film is
asked for again only

- if it was never asked for, or under another outside id,
- after an error, once its waiting time is over, which doubles with each attempt,
  and at most `attempts` times,
- after a miss (the service knows no poster), once the miss has expired.

Within a run, a lookup that raises an error is repeated `retries` times.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinestar.functions.scalars import bare_imdb_id
from cinestar.operators.enrich import DEFAULT_SLICES, Resolver, resolve_posters
from cinestar.sources import publish

_ANSWER = "film_id bigint, imdb_id string, url string, error string, tries int, asked timestamp"


@dataclass(frozen=True)
class Lookups:
    """Slices at once; films in a chunk; attempts over all runs; when to ask again.

    `wait_hours` after a first error, twice as long after each further one; misses
    expire after `miss_days`. `retries` within a run wait `retry_seconds`, doubling.
    """

    slices: int = DEFAULT_SLICES
    chunk_films: int = 10_000
    attempts: int = 5
    wait_hours: float = 1.0
    miss_days: float = 30.0
    retries: int = 2
    retry_seconds: float = 1.0


def patient(open_resolver: Callable[[], Resolver], retries: int, seconds: float) -> Callable[[], Resolver]:
    """A resolver that repeats a lookup after an error, waiting longer each time."""

    def opened() -> Resolver:
        resolver = open_resolver()

        def resolve(bare: str) -> str | None:
            for attempt in range(retries + 1):
                try:
                    return resolver(bare)
                except Exception:
                    if attempt == retries:
                        raise
                    time.sleep(seconds * 2**attempt)
            return None

        return resolve

    return opened


def answers(spark: SparkSession, path: str) -> DataFrame:
    """Each film's last answer: (film_id, imdb_id, url, error, tries, asked)."""
    if not publish.ledger(spark, path):
        return spark.createDataFrame([], _ANSWER)
    rows = publish.read_published(spark, path).select("film_id", F.struct("imdb_id", "url", "error", "tries", "asked").alias("row"))
    # Combined within tasks: a film has as many rows as it was asked for.
    last = rows.groupBy("film_id").agg(F.max_by("row", F.col("row.asked")).alias("row"))
    return last.select("film_id", "row.*")


def due(settings: Lookups, now: Column) -> Column:
    """Whether a film with this answer is to be asked for again."""
    hours = settings.wait_hours * F.pow(F.lit(2.0), F.col("tries") - 1)
    waited = F.unix_micros(now) - F.unix_micros("asked") >= (hours * 3_600_000_000).cast("bigint")
    failed = F.col("error").isNotNull() & (F.col("tries") < settings.attempts) & waited
    age = F.unix_micros(now) - F.unix_micros("asked")
    missed = F.col("error").isNull() & F.col("url").isNull() & (age >= int(settings.miss_days * 86_400_000_000))
    return failed | missed


def pending(films: DataFrame, known: DataFrame, settings: Lookups, now: datetime) -> DataFrame:
    """(film_id, imdb_id, tries) of the films to ask for; `tries` is how often they were asked for.

    Films without an outside id cannot be asked for.
    """
    last = known.withColumns({"due": due(settings, F.lit(now)), "old_id": F.col("imdb_id")}).drop("imdb_id")
    both = films.select("film_id", "imdb_id").where(bare_imdb_id(F.col("imdb_id")).isNotNull()).join(last, "film_id", "left")
    other = ~F.col("old_id").eqNullSafe(F.col("imdb_id"))
    tries = F.when(other, 0).otherwise(F.col("tries"))
    return both.where(other | F.col("due")).select("film_id", "imdb_id", tries.alias("tries"))


def look_up(
    films: DataFrame,
    open_resolver: Callable[[], Resolver],
    path: str,
    settings: Lookups = Lookups(),
    now: datetime | None = None,
) -> DataFrame:
    """Ask for all films that are due, chunk by chunk, and return every film's last answer.

    `films` has film_id and imdb_id, one row per film. `now` is the time of the run.
    """
    spark, now = films.sparkSession, now or datetime.now()
    done = publish.ledger(spark, path)
    # The films of this run are fixed before the first chunk changes what is pending.
    run = f"{done[-1].number + 1 if done else 1:012d}"
    publish.publish(pending(films, answers(spark, path), settings, now), f"{path}/_pending", {"run": run})
    todo = publish.read_published(spark, f"{path}/_pending").where(F.col("run") == run)
    chunks = -(-todo.count() // settings.chunk_films)
    resolver = patient(open_resolver, settings.retries, settings.retry_seconds)
    for chunk in range(chunks):
        some = todo.where(F.pmod(F.xxhash64("film_id"), F.lit(chunks)) == chunk)
        found = resolve_posters(some, resolver, settings.slices).select("film_id", "imdb_id", "url", "error")
        asked = found.join(some.select("film_id", F.col("tries").alias("before")), "film_id")
        rows = asked.select(
            "film_id", "imdb_id", "url", "error",
            (F.col("before") + 1).cast("int").alias("tries"), F.lit(now).cast("timestamp").alias("asked"),
        )
        publish.publish(rows, path, {"run": run, "chunk": f"{chunk:06d}"})
    publish.expire(spark, f"{path}/_pending", keep=1)
    return answers(spark, path)
