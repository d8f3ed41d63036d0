"""Tables that change at once: a run is written beside the last one, then named the current one.

A published table is a folder:

    <path>/<run columns>/version=<n>/...   the rows of one version of one run
    <path>/_ledger/<n>.json                one small file per published version

A version counts from the moment its ledger file is there. The file is made
under another name and renamed, and a rename onto a file that is there fails,
so a version is whole or absent and two writers never get the same number. A
run that dies leaves rows that no ledger file names; readers go on with the
last version, and `expire` removes the remains.

A table without runs has one run, the empty one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEDGER = "_ledger"


@dataclass(frozen=True)
class Version:
    """One published version: its number, run, folder under the table's path, and schema as JSON.

    `published` is in seconds since 1970. `note` says what made it. The rows may
    lie in `buckets` of the column `bucket_by`.
    """

    number: int
    folder: str
    schema: str
    run: dict[str, str] = field(default_factory=dict)
    published: float = 0.0
    note: str = ""
    bucket_by: str = ""
    buckets: int = 0


class _Files:
    """The file system of a path, through Spark's own client: any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder) if folder else self.root
        if not self.fs.exists(place):
            return []
        return sorted(status.getPath().getName() for status in self.fs.listStatus(place))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a file with this text at once; False if there is one of that name."""
        made = self.path(f"{_LEDGER}/.{uuid.uuid4().hex}")
        stream = self.fs.create(made, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        place = self.path(name)
        # A rename onto a file fails on a store that renames at once; others are asked first.
        if not self.fs.exists(place) and self.fs.rename(made, place):
            return True
        self.fs.delete(made, False)
        return False

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def age(self, name: str) -> float:
        """Seconds since a folder was last changed."""
        return time.time() - self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000


def ledger(spark: SparkSession, path: str) -> list[Version]:
    """All published versions, oldest first. One small file each: versions are runs, not rows."""
    files = _Files(spark, path)
    names = [name for name in files.names(_LEDGER) if name.endswith(".json") and name[0] != "."]
    return sorted((Version(**json.loads(files.read(f"{_LEDGER}/{n}"))) for n in names), key=lambda v: v.number)


def current(versions: list[Version]) -> list[Version]:
    """The last version of each run."""
    return list({json.dumps(v.run, sort_keys=True): v for v in versions}.values())


def _folder(run: Mapping[str, str], name: str) -> str:
    return "/".join([*(f"{column}={value}" for column, value in run.items()), f"version={name}"])


def _enter(files: _Files, version: Version, after: int) -> Version:
    """Put a version into the ledger under the first free number."""
    number = after + 1
    while True:
        entered = Version(**{**asdict(version), "number": number, "published": time.time()})
        if files.create(f"{_LEDGER}/{number:012d}.json", json.dumps(asdict(entered))):
            return entered
        number += 1


def publish(
    frame: DataFrame,
    path: str,
    run: Mapping[str, str] | None = None,
    note: str = "",
    bucket_by: str = "",
    buckets: int = 0,
) -> Version:
    """Write the rows as the next version of a run. Until it is whole, readers see the one before.

    With `bucket_by`, tables of equal bucket counts join on that column without
    a shuffle. Use it for columns that are unique in the table: the rows of one
    value all pass through one task.
    """
    spark, run = frame.sparkSession, dict(run or {})
    files, rows, own = _Files(spark, path), frame.drop(*run), uuid.uuid4().hex
    folder = _folder(run, own)
    if bucket_by:
        # Spark writes buckets for tables of a catalog only: this one goes, its files stay.
        written = rows.repartition(buckets, bucket_by).write.format("parquet").option("path", f"{path}/{folder}")
        written.bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(f"published_{own}")
        spark.sql(f"DROP TABLE published_{own}")
    else:
        rows.write.mode("errorifexists").parquet(f"{path}/{folder}")
    numbers = [int(n.partition(".")[0]) for n in files.names(_LEDGER) if n.endswith(".json") and n[0] != "."]
    version = Version(0, folder, rows.schema.json(), run, 0.0, note, bucket_by, buckets)
    return _enter(files, version, max(numbers, default=0))


def roll_back(spark: SparkSession, path: str, to: int, note: str = "") -> Version:
    """Make an earlier version of a run its current one again, as a version of its own."""
    versions = ledger(spark, path)
    earlier = next((v for v in versions if v.number == to), None)
    if earlier is None:
        raise ValueError(f"{path}: no version {to}")
    return _enter(_Files(spark, path), Version(**{**asdict(earlier), "note": note}), versions[-1].number)


def read_versions(spark: SparkSession, path: str, versions: list[Version]) -> DataFrame:
    """The rows of these versions, with their run's columns and `version`."""
    if not versions:
        raise ValueError(f"{path}: nothing has been published")
    schema = T.StructType.fromJson(json.loads(versions[-1].schema))
    for name in versions[-1].run:
        schema = schema.add(name, T.StringType())
    # The folder's name identifies it; its number follows from the ledger, a row a version.
    folder = "version"
    schema = schema.add(folder, T.StringType())
    rows = spark.read.schema(schema).option("basePath", path).parquet(*{f"{path}/{v.folder}" for v in versions})
    numbers = F.create_map(*[F.lit(x) for v in versions for x in (v.folder.rpartition("=")[2], v.number)])
    return rows.withColumn(folder, numbers[F.col(folder)].cast("bigint"))


def read_published(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """The current version of every run, or what was current when version `at` was published."""
    versions = [v for v in ledger(spark, path) if at is None or v.number <= at]
    return read_versions(spark, path, current(versions)).drop("version")


def expire(spark: SparkSession, path: str, keep: int = 2, orphan_seconds: float = 86_400.0) -> list[str]:
    """Remove all but the last `keep` versions of each run, and remains of runs that died.

    A folder that no version names may be one that is being written: it goes only
    when it has not been changed for `orphan_seconds`. Returns the folders removed.
    """
    files, versions = _Files(spark, path), ledger(spark, path)
    by_run: dict[str, list[Version]] = {}
    for version in versions:
        by_run.setdefault(json.dumps(version.run, sort_keys=True), []).append(version)
    kept = [v for run in by_run.values() for v in run[-keep:]]
    numbers, folders = {v.number for v in kept}, {v.folder for v in kept}
    # The ledger first: no reader may be led to a folder that is gone.
    for version in versions:
        if version.number not in numbers:
            files.remove(f"{_LEDGER}/{version.number:012d}.json")
    named = {v.folder for v in versions}
    removed = sorted(named - folders)
    for parent in {folder.rpartition("/")[0] for folder in named}:
        for name in files.names(parent):
            folder = f"{parent}/{name}" if parent else name
            if name.startswith("version=") and folder not in named and files.age(folder) >= orphan_seconds:
                removed.append(folder)
    for folder in removed:
        files.remove(folder)
    return removed


def _definition(version: Version) -> str:
    """Columns and layout of the catalog table over a published one."""
    schema = T.StructType.fromJson(json.loads(version.schema))
    columns = ", ".join([schema.toDDL(), *(f"`{column}` string" for column in version.run)])
    by = f" PARTITIONED BY ({', '.join(f'`{column}`' for column in version.run)})" if version.run else ""
    if version.bucket_by:
        name = f"`{version.bucket_by}`"
        by += f" CLUSTERED BY ({name}) SORTED BY ({name}) INTO {version.buckets} BUCKETS"
    return f"({columns}) USING parquet{by}"


def point_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make a catalog table read what is current under a path.

    The table's location, or a partition's of a table with runs, is switched to
    the folder of the version; that is one change in the catalog for each. Only
    when columns or buckets are others is the table's entry made anew.
    """
    now = current(ledger(spark, path))
    if not now:
        raise ValueError(f"{path}: nothing has been published")
    last, definition, tag = now[-1], _definition(now[-1]), "published.definition"
    if spark.catalog.tableExists(name):
        told = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if told.get(tag) != definition:
            spark.sql(f"DROP TABLE {name}")  # an external one: its files stay
    place = path if last.run else f"{path}/{last.folder}"
    quoted = definition.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} {definition} LOCATION '{place}' TBLPROPERTIES ('{tag}' = '{quoted}')"
    )
    if not last.run:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    for version in now if last.run else []:
        values = ", ".join(f"`{column}` = '{value}'" for column, value in version.run.items())
        folder = f"{path}/{version.folder}"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({values}) LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({values}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)
