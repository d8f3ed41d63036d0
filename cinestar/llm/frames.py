"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinestar.session import scratch_path

# What separates words, as a character class and as characters.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    It cuts the lineage, so that a lost executor costs no more than the tasks
    it ran, and it gives the planner the true size of the rows.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


BITMAP_ROW = 1 << 15  # bits in a row of Spark's bitmap aggregate


def bitmap(places: DataFrame, bits: int) -> Broadcast:
    """A bit for each place, 0 to bits - 1, in a column of that name: packed, `bits` / 8 bytes whatever the rows.

    `bits` is a power of two, `BITMAP_ROW` at least. The bits are gathered in
    tasks; the driver puts at most `bits` / `BITMAP_ROW` rows together.
    """
    rows = places.select(
        F.shiftright("place", 15).alias("row"), F.col("place").bitwiseAND(F.lit(BITMAP_ROW - 1)).alias("bit")
    )
    packed, width = bytearray(bits // 8), BITMAP_ROW // 8
    for row in rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        packed[row["row"] * width : (row["row"] + 1) * width] = row["bits"]
    return places.sparkSession.sparkContext.broadcast(bytes(packed))


def discard(*frames: DataFrame) -> None:
    """Remove the folders of staged tables that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            # Only hand-off tables: the paths that `scratch_path` gives.
            if folder.rpartition("/")[0].endswith("/cinestar"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(frame: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores, such that the frame has no such column."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """The words of a text in order: runs of anything but ASCII white space."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{SPACES}]+", " ")
    return F.array_remove(F.split(spaced, " "), "")


def slices(batches, rows: int = 500):
    """Arrow batches cut into small ones, so that Python objects are made for few rows at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)
