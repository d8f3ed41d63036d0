"""From raw documents to packed training sequences, as stages that are each written out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of the documents. `run` writes each stage's result to
the shared folder and gives the next one what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinestar.llm import decontaminate, line_dedup, minhash, packing, quality
from cinestar.llm.frames import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stay near their language's reference."""
    return quality.judge(docs).where(F.col("kept")).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source.

    Copies are still among them, so a text counts once however often it occurs:
    else a much copied article would lose all its lines in every copy.
    """
    cleaned = line_dedup.drop_boilerplate(docs, line_dedup.Boilerplate(distinct_pages=True))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of the smallest id; a null id is no duplicate."""
    judged = minhash.near_duplicates(docs)
    copies = judged.where(~F.col("kept")).select("doc_id").distinct()
    rows = docs.join(copies, "doc_id", "left_anti").select(docs.columns)
    # Rows of one id are one document: the smallest row of them stays.
    several = staged(
        rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1"),
        "several",
    ).select("doc_id")
    again = rows.join(several, "doc_id", "left_semi").select(docs.columns)
    one = again.groupBy("doc_id").agg(F.min(F.struct(docs.columns)).alias("row")).select("row.*")
    return rows.join(several, "doc_id", "left_anti").select(docs.columns).union(one)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, with the documents in each."""
    sequences = packing.pack(docs)
    return sequences.withColumn("doc_ids", F.col("segments.doc_id"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# Packing needs the tokenizer, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
