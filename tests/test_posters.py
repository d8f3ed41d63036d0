from __future__ import annotations

import random

import numpy as np

from pyspark.sql import functions as F

from cinestar.operators import posters


def test_poster_is_copied_once_per_genre(spark):
    shown = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3")], "film_id bigint, url string")
    genres = spark.createDataFrame(
        [(18, 1, "Drama"), (35, 1, "Comedy"), (18, 2, "Drama"), (18, 9, "Drama")],
        "id int, film_id bigint, name string",
    )
    assert {tuple(r) for r in posters.poster_labels(shown, genres).collect()} == {
        (1, "u1", "Drama"),
        (1, "u1", "Comedy"),
        (2, "u2", "Drama"),
    }


def test_training_and_ranked_scores(spark):
    source = random.Random(3)
    rows = []
    for film in range(120):
        kind = film % 3
        vector = [float(axis == kind) + source.gauss(0, 0.1) for axis in range(3)]
        rows.append((film, vector, "abc"[kind]))
    examples = spark.createDataFrame(rows, "film_id bigint, features array<float>, genre string")
    train, test = posters.split_by_film(examples)
    assert train.count() + test.count() == 120
    assert train.join(test, "film_id", "left_semi").count() == 0
    model = posters.train_genres(train.unionByName(examples.limit(1).withColumn("genre", F.lit(None))))
    scores = posters.score_genres(model, examples)

    # Against the same formula by hand, from the model's coefficients.
    logistic = model.stages[-1]
    weights, bias = logistic.coefficientMatrix.toArray(), logistic.interceptVector.toArray()
    for row in scores.where("film_id < 10").collect():
        odds = np.exp(weights @ np.array(rows[row["film_id"]][1], dtype="float32") + bias)
        by_hand = dict(zip(model.stages[0].labels, odds / odds.sum(), strict=True))
        assert abs(row["probability"] - by_hand[row["genre"]]) < 1e-9

    per_film = scores.groupBy("film_id").agg(
        F.sum("probability").alias("total"),
        F.sort_array(F.collect_list("rank")).alias("ranks"),
        F.max_by("rank", "probability").alias("best"),
        F.min_by("genre", "rank").alias("genre"),
    )
    found = {r["film_id"]: r for r in per_film.collect()}
    assert len(found) == 120
    assert all(abs(r["total"] - 1) < 1e-9 and r["ranks"] == [1, 2, 3] for r in found.values())
    assert all(r["best"] == 1 for r in found.values())
    assert all(found[film]["genre"] == genre for film, _, genre in rows)


def noisy(seed, films=240):
    """Posters of three genres that overlap; some films have two genres."""
    source, rows = random.Random(seed), []
    for film in range(films):
        kind = film % 3
        vector = [float(axis == kind) + source.gauss(0, 0.6) for axis in range(3)]
        rows += [(film, vector, "abc"[k]) for k in {kind, (kind + 1) % 3 if film % 10 == 0 else kind}]
    return rows


def local_model(rows, reg, steps=4000):
    """Multinomial logistic regression by gradient descent: features scaled, biases without penalty."""
    features = np.array([np.float32(v) for _, v, _ in rows], dtype=float)
    labels = np.array(["abc".index(g) for _, _, g in rows])
    scale = features.std(axis=0, ddof=1)
    x, target = features / scale, np.eye(3)[labels]
    weights, bias = np.zeros((3, 3)), np.zeros(3)
    for _ in range(steps):
        odds = np.exp(x @ weights.T + bias)
        error = odds / odds.sum(axis=1, keepdims=True) - target
        weights -= 0.5 * (error.T @ x / len(x) + reg * weights)
        bias -= 0.5 * error.mean(axis=0)

    def probabilities(vectors):
        odds = np.exp(np.float32(vectors).astype(float) / scale @ weights.T + bias)
        return odds / odds.sum(axis=1, keepdims=True)

    return probabilities


def test_folds_equal_a_local_model(spark):
    rows = noisy(4)
    examples = spark.createDataFrame(rows, "film_id bigint, features array<float>, genre string").cache()
    folds = {r.film_id: r.fold for r in posters.with_folds(examples, 3).select("film_id", "fold").distinct().collect()}
    assert len(folds) == 240 and set(folds.values()) == {0, 1, 2}  # a film with two genres lies in one fold
    found = {r.fold: r for r in posters.cross_validate(examples, 3, max_iter=200).collect()}
    for fold in range(3):
        model = local_model([r for r in rows if folds[r[0]] != fold], 0.01)
        held = {film: vector for film, vector, _ in rows if folds[film] == fold}
        truth = {(film, genre) for film, _, genre in rows}
        best = model(np.array(list(held.values()))).argmax(axis=1)
        hits = sum((film, "abc"[k]) in truth for film, k in zip(held, best, strict=True))
        assert found[fold].posters == found[fold].among_three == len(held)
        # A poster between two genres may fall on either side.
        assert abs(found[fold].first - hits) <= 1


def test_probabilities_are_as_often_right(spark):
    rows = noisy(5, 600)
    examples = spark.createDataFrame(rows, "film_id bigint, features array<float>, genre string")
    single = examples.where("film_id % 10 <> 0")
    scores = posters.score_genres(posters.train_genres(single, 100, 0.0), single)
    table = {r.bin: r for r in posters.calibration(scores, single).collect()}
    assert sum(r.pairs for r in table.values()) == 3 * 540
    for row in table.values():
        assert row.bin / 10 <= row.predicted <= (row.bin + 1) / 10
        if row.pairs >= 60:
            assert abs(row.predicted - row.observed) < 0.15
