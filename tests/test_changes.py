from __future__ import annotations

import random

from pyspark.sql import functions as F

from cinestar.operators.changes import apply_changes, changed_keys, digests, of_keys, refresh

SCHEMA = "id bigint, a string, b array<string>"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def found(changes):
    return {r.id: r.change for r in changes.collect()}


def test_keys_are_new_gone_or_other(spark):
    before = [(1, "x", []), (2, "x", []), (3, "x", ["p"]), (4, "x", None), (None, "n", []), (6, "u", []), (6, "v", [])]
    after = [(2, "y", []), (3, "x", ["p"]), (4, "x", []), (5, "z", []), (None, "m", []), (6, "v", []), (6, "u", [])]
    assert found(changed_keys(frame(spark, before), frame(spark, after), "id")) == {
        1: "delete", 2: "update", 4: "update", 5: "insert", None: "update",
    }
    assert found(changed_keys(frame(spark, before), frame(spark, []), "id")) == dict.fromkeys((1, 2, 3, 4, None, 6), "delete")
    assert found(changed_keys(frame(spark, []), frame(spark, after), "id"))[None] == "insert"


def test_nulls_and_copies_count(spark):
    """Values that a plain hash of the row takes for the same."""
    pairs = [
        ([("a", None)], [(None, ["a"])]),
        ([(None, [])], [(None, None)]),
        ([("a", [None, "b"])], [("a", ["b", None])]),
        ([("a", ["b"])], [("a", ["b", None])]),
        ([("a", [""])], [("a", [])]),
        ([("a", [])], [("a", []), ("a", [])]),
        ([("a", []), ("a", []), ("b", [])], [("a", []), ("b", []), ("b", [])]),
    ]
    before = [(k, *row) for k, (one, _) in enumerate(pairs) for row in one]
    after = [(k, *row) for k, (_, two) in enumerate(pairs) for row in two]
    assert found(changed_keys(frame(spark, before), frame(spark, after), "id")) == dict.fromkeys(range(len(pairs)), "update")
    # The order of rows and of columns does not matter.
    other = frame(spark, after[::-1], 1).select("b", "id", "a")
    assert found(changed_keys(frame(spark, after), other, "id")) == {}


def test_applying_the_changes_equals_the_new_run(spark):
    rng = random.Random(1)
    rows = [(rng.choice([7, 7, 7, rng.randrange(60), None]), f"v{rng.randrange(5)}", [str(k % 3)]) for k in range(900)]
    kept = [r for r in rows if rng.random() < 0.9 or r[0] == 7]
    after = kept + kept[:20] + [(100 + k, "new", []) for k in range(5)]
    old, new = frame(spark, rows), frame(spark, after)
    changes = changed_keys(old, new, "id")
    result = apply_changes(old, changes, new, "id")
    key = lambda r: repr(r)
    assert sorted(map(tuple, result.collect()), key=key) == sorted(after, key=key)


def test_only_changed_keys_are_built_again(spark):
    before = [(k, f"v{k}", []) for k in range(50)]
    after = [(k, f"v{k}" if k % 10 else "other", []) for k in range(5, 55)]
    built = spark.sparkContext.accumulator(0)

    def build(rows):
        def count(batches):
            for batch in batches:
                built.add(batch.num_rows)
                yield batch

        return rows.select("id", "a").mapInArrow(count, "id bigint, a string").withColumn("a", F.upper("a"))

    old = build(frame(spark, before))
    changes = changed_keys(frame(spark, before), frame(spark, after), "id")
    result = refresh(old, changes, frame(spark, after), build, "id", "id").checkpoint()
    assert sorted(map(tuple, result.collect())) == sorted((k, a.upper()) for k, a, _ in after)
    # 50 old rows, and of the new ones 4 changed and 5 that are new.
    assert built.value == 50 + 9


def test_a_hot_key_is_combined_before_it_is_shuffled(spark, no_broadcast):
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("id"), (F.col("id") % 3).cast("string").alias("a"))
    plan = digests(rows, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")  # printed from the result down
    assert digests(rows, "id").first()["rows"] == 20_000


def test_rows_of_keys(spark):
    rows = frame(spark, [(1, "a", []), (None, "b", []), (2, "c", [])])
    keys = spark.createDataFrame([(1,), (None,)], "id bigint")
    assert {r.a for r in of_keys(rows, keys, "id").collect()} == {"a", "b"}
    assert {r.a for r in of_keys(rows, keys, "id", "anti").collect()} == {"c"}
