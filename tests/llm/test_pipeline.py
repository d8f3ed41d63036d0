from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from cinestar.llm.frames import staged, table
from tests.llm import cases
from tests.llm.test_minhash import brute_force

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def results(spark):
    """What each stage makes of the whole table, given what the one before kept."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = staged(stage(spark, docs, SF), name)
    return out


def ids(frame) -> list:
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(spark, results):
    names = list(results)
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
    for name in names[:-1]:
        assert results[name].schema == table(spark, SF, "documents").schema


def test_decisions(spark, results):
    from cinestar.llm.queries import QUERIES

    judged = QUERIES["op9_quality"](spark, SF)
    assert ids(results["quality_rules"]) == ids(judged.where("kept"))
    assert ids(results["line_dedup"]) == ids(results["quality_rules"])
    rows = [(r.doc_id, r.text) for r in results["line_dedup"].collect()]
    expected = {k for k, _, label, kept in brute_force(rows, 5) if kept}
    assert ids(results["near_duplicates"]) == sorted(expected)

    def plain(text):
        return " ".join(w.strip(".,!?;:").lower() for w in text.split())

    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = [r.doc_id for r in results["near_duplicates"].collect() if not any(i in plain(r.text) for i in items)]
    assert ids(results["decontamination"]) == sorted(clean)
    packed = results["packing"].selectExpr("inline(segments)").collect()
    assert {r.doc_id for r in packed} == set(clean)
    assert Counter((r.doc_id, r.piece) for r in packed).most_common(1)[0][1] == 1


def test_run_is_the_stages_in_order(spark, results):
    def pieces(frame):
        return Counter(map(tuple, frame.selectExpr("inline(segments)").drop("offset").collect()))

    assert pieces(corpus_pipeline.run(spark, SF)) == pieces(results["packing"])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_awkward_rows(spark, name):
    """No stage fails on nulls, blanks, repeated rows or extra columns, nor on an empty table."""
    docs = cases.documents(spark)
    out = STAGES[name](spark, docs, SF)
    assert out.columns == docs.columns
    rows = Counter(map(tuple, docs.select("doc_id", "text").collect()))
    left = Counter(map(tuple, out.select("doc_id", "text").collect()))
    if name in ("line_dedup",):
        assert sum(left.values()) == sum(rows.values())
    else:
        assert not left - rows
    if name == "near_duplicates":
        assert all(n == 1 for (k, _), n in left.items() if k is not None)
        assert sum(n for (k, _), n in left.items() if k is None) == 2
        assert not {k for k, _ in left} & {*range(100, 112)}
    if name == "decontamination":
        assert left == rows
    assert STAGES[name](spark, cases.documents(spark, []), SF).count() == 0


def test_much_copied_article_stays_once(spark):
    """Copies on more than 2 % of a source's pages keep their lines, a footer goes, one copy is kept."""
    rng = random.Random(12)
    article = cases.prose(rng)
    rows = [(k, f"{article}\nRead more", "en", "s", 1) for k in range(40)]
    rows += [(100 + k, f"{cases.prose(rng)}\nRead more", "en", "s", 1) for k in range(60)]
    cleaned = staged(STAGES["line_dedup"](spark, cases.documents(spark, rows), SF), "cleaned")
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts == {k: text.removesuffix("\nRead more") for k, text, *_ in rows}
    kept = STAGES["near_duplicates"](spark, cleaned, SF)
    assert ids(kept) == [0, *range(100, 160)]
