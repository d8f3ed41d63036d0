from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cinestar.llm.lexical_search import LexicalSearch, search
from cinestar.llm.treap import Treap, best_columns
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(rows, items, most):
    """(item, rank, doc_id, score), every document scored for every item."""
    found = [(doc_id, terms(text)) for doc_id, text in rows]
    found = [(doc_id, tf) for doc_id, tf in found if tf]
    n, length = len(found), sum(sum(tf.values()) for _, tf in found)
    df = Counter(t for _, tf in found for t in tf)
    out = []
    for item, text in set(items):
        scored = []
        for doc_id, tf in found:
            m = 100 - 50 + (50 * sum(tf.values()) * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in terms(text)
                if t in tf
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:most], 1):
            out.append((item, rank, doc_id, -score))
    return Counter(out)


def ours(spark, rows, items, settings, parts=4):
    documents = cases.documents(spark, [(*r, "en", "s", 1) for r in rows], parts)
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "0 AS score", "0 AS doc_id")
    return Counter(tuple(r) for r in search(documents, asked, settings).collect())


def test_treap_holds_its_values_and_maxima():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, m = int(rng.integers(1, 40)), int(rng.integers(1, 40))
        grid = rng.integers(1, 100, (n, m)) * (rng.random((n, m)) < rng.choice([0.05, 0.5]))
        if not grid.any():
            continue
        rows, columns = np.nonzero(grid)
        shuffled = rng.permutation(len(rows))
        treap = Treap.build(rows[shuffled], columns[shuffled], grid[rows, columns][shuffled])
        assert treap.values[0] == grid.max()
        asked = rng.integers(0, n, 5)
        weights = rng.integers(0, 50, 5)
        items = np.array([0, 0, 1, 1, 1])
        least = np.ones(2, dtype=np.int64)
        item, column, score = best_columns(treap, m, asked, weights, items, least, most=3, wave=1)
        for which in (0, 1):
            exact = (grid[asked[items == which]] * weights[items == which][:, None]).sum(axis=0)
            best = np.sort(exact[exact > 0])[::-1][:3]
            mine = np.sort(score[item == which])[::-1]
            assert list(mine[:3]) == list(best)
            assert all(exact[c] == s for c, s in zip(column[item == which], score[item == which], strict=True))
            # Ties of the last one that counts are all there.
            if len(best) == 3:
                assert (exact >= best[-1]).sum() == (mine >= best[-1]).sum()


@pytest.mark.parametrize(
    "settings", [LexicalSearch(), LexicalSearch(most=5, block_postings=100, query_terms=7, items_at_once=2)]
)
def test_equals_brute_force(spark, settings):
    rng = random.Random(5)
    rows = [r[:2] for r in cases.rows()]
    rows += [(1000 + k, " ".join(rng.choices(cases.SYLLABLES, k=5))) for k in range(300)]
    rows += [(2000 + k, "same words here") for k in range(70)] + [(None, "same words here"), (-3, "Same WORDS, here!")]
    texts = [r[1] for r in rows[:30]] + ["same here", "no-such-term", "", None, "Ünï an the", "an an AN re", "1234"]
    items = list(enumerate(texts)) + [(3, "the"), (3, "the"), (None, "words")]
    assert ours(spark, rows, items, settings) == brute(rows, items, settings.most)


def test_empty_tables(spark):
    assert ours(spark, [], [(1, "a")], LexicalSearch()) == Counter()
    assert ours(spark, [(1, "a")], [], LexicalSearch()) == Counter()
    assert ours(spark, [(1, None), (2, " ")], [(1, "a")], LexicalSearch()) == Counter()
