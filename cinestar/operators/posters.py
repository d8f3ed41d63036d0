"""Posters as labelled examples: one per genre, a genre model, ranked genres per poster."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def poster_labels(posters: DataFrame, genres: DataFrame) -> DataFrame:
    """A copy of each poster for each genre of its film; `posters` has one row per film."""
    labels = genres.select("film_id", F.col("name").alias("genre"))
    return posters.join(labels, "film_id")


def train_genres(examples: DataFrame, max_iter: int = 20, reg: float = 0.01) -> PipelineModel:
    """Multinomial logistic regression over examples of (`features` array, `genre`).

    The driver holds the coefficients and the genre names, no examples.
    """
    data = examples.where(F.col("genre").isNotNull()).select(
        array_to_vector("features").alias("vector"), "genre"
    )
    index = StringIndexer(inputCol="genre", outputCol="label", stringOrderType="alphabetAsc")
    model = LogisticRegression(
        featuresCol="vector", family="multinomial", maxIter=max_iter, regParam=reg
    )
    return Pipeline(stages=[index, model]).fit(data)


def score_genres(model: PipelineModel, posters: DataFrame) -> DataFrame:
    """film_id, genre, probability, rank (1 = most likely) for each poster and genre.

    A poster's probabilities sit in one row, so they are ranked in place; ties
    go by genre name.
    """
    names = model.stages[0].labels
    scored = model.stages[-1].transform(
        posters.select("film_id", array_to_vector("features").alias("vector"))
    )
    pairs = F.zip_with(
        vector_to_array("probability"),
        F.array(*[F.lit(name) for name in names]),
        lambda p, name: F.struct((-p).alias("minus"), name.alias("genre")),
    )
    ranked = scored.select("film_id", F.posexplode(F.array_sort(pairs)).alias("place", "pair"))
    return ranked.select(
        "film_id",
        F.col("pair.genre").alias("genre"),
        (-F.col("pair.minus")).alias("probability"),
        (F.col("place") + 1).alias("rank"),
    )


def split_by_film(frame: DataFrame, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(training rows, test rows); all copies of a film's poster land on one side.

    The side follows from the md5 of the id, which any engine can repeat.
    """
    share = _place(100)
    return frame.where(share >= test_percent), frame.where(share < test_percent)


def _place(parts: int) -> Column:
    """0 to parts - 1, from the md5 of the film's id."""
    digits = F.substring(F.md5(F.col("film_id").cast("string")), 1, 7)
    return F.conv(digits, 16, 10).cast("bigint") % parts


def with_folds(frame: DataFrame, folds: int = 5) -> DataFrame:
    """Add `fold`, 0 to folds - 1: all copies of a film's poster lie in one."""
    return frame.withColumn("fold", _place(folds))


def cross_validate(examples: DataFrame, folds: int = 5, max_iter: int = 20, reg: float = 0.01) -> DataFrame:
    """`evaluate_genres` of each fold under a model of the others: (fold, posters, first, among_three).

    One training job for each fold; write the examples out before.
    """
    rows = with_folds(examples, folds)
    results = []
    for fold in range(folds):
        model = train_genres(rows.where(F.col("fold") != fold), max_iter, reg)
        held = evaluate_genres(model, rows.where(F.col("fold") == fold))
        results.append(held.select(F.lit(fold).alias("fold"), "*"))
    return reduce(DataFrame.unionByName, results)


def calibration(scores: DataFrame, examples: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, pairs, predicted, observed): are genres given with probability p a genre of the film as often?

    Over all pairs of a scored poster and a genre; sums per bin, combined within
    tasks. A multinomial model gives one poster's probabilities a sum of 1, so
    for films of k genres the observed shares are up to k times the predicted.
    """
    truth = examples.select("film_id", "genre").distinct().withColumn("is_genre", F.lit(1.0))
    pairs = scores.join(truth, ["film_id", "genre"], "left")
    place = F.least(F.floor(F.col("probability") * bins), F.lit(bins - 1)).cast("int")
    return pairs.groupBy(place.alias("bin")).agg(
        F.count("*").alias("pairs"),
        F.avg("probability").alias("predicted"),
        F.avg(F.coalesce("is_genre", F.lit(0.0))).alias("observed"),
    )


def evaluate_genres(model: PipelineModel, examples: DataFrame) -> DataFrame:
    """One row: held-out posters, and how many have a genre of their film ranked first or in the top 3."""
    truth = examples.groupBy("film_id").agg(F.collect_set("genre").alias("truth"))
    # Copies of a poster may differ: the smallest counts, whichever comes first.
    posters = examples.groupBy("film_id").agg(F.min("features").alias("features"))
    ranked = score_genres(model, posters).join(truth, "film_id")
    hit = F.when(F.array_contains("truth", F.col("genre")), F.col("rank"))
    best = ranked.groupBy("film_id").agg(F.min(hit).alias("best"))
    return best.agg(
        F.count("*").alias("posters"),
        F.count_if(F.col("best") == 1).alias("first"),
        F.count_if(F.col("best") <= 3).alias("among_three"),
    )
