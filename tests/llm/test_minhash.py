from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cinestar.llm.hashing import WordHasher, shingles
from cinestar.llm.minhash import NearDuplicates, _compare, _Sketcher, near_duplicates
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows, width):
    found = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(width, len(words))
        some = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
        found.setdefault(doc_id, []).append(some)
    return found


def brute_force(rows, width, percent=80):
    """(doc_id, n_shingles) -> component, by comparing every two documents."""
    sets = {k: v for k, v in sets_of(rows, width).items() if k is not None}
    label = {k: k for k in sets}
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b
        and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return Counter(
        (k, len(s), label.get(k), label.get(k, k) == k or k is None)
        for k, all_ in sets_of(rows, width).items()
        for s in all_
    )


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force(spark, width):
    rows = cases.rows()
    found = near_duplicates(cases.documents(spark), NearDuplicates(width=width))
    assert Counter(map(tuple, found.collect())) == brute_force([r[:2] for r in rows], width)


def test_chains_of_near_copies(spark):
    """Links near the limit, where the first centre of a bucket is too far from its ends."""
    rng = random.Random(3)
    rows, words = [], [f"w{k}" for k in range(120)]
    for k in range(40):
        rows.append((k, " ".join(words), "en", "s", 1))
        words[rng.randrange(len(words))] = f"x{k}"
        words[rng.randrange(len(words))] = f"y{k}"
    rng.shuffle(rows)
    found = near_duplicates(cases.documents(spark, rows), NearDuplicates(width=2))
    assert Counter(map(tuple, found.collect())) == brute_force([r[:2] for r in rows], 2)


def test_many_copies_that_only_their_original_links(spark):
    """Two copies differ twice as much as either does from the original, whose id is not the smallest."""
    rng = random.Random(4)
    original = [f"w{k}" for k in range(300)]
    rows = [(500, " ".join(original), "en", "s", 1)]
    for k in range(80):
        words = list(original)
        for place in rng.sample(range(300), 14):
            words[place] = f"x{k}-{place}"
        rows.append((k, " ".join(words), "en", "s", 1))
    found = near_duplicates(cases.documents(spark, rows), NearDuplicates(width=2))
    expected = brute_force([r[:2] for r in rows], 2)
    assert len({component for _, _, component, _ in expected}) == 1
    assert Counter(map(tuple, found.collect())) == expected


def edits(seed, copies):
    """Edits of one text, most of them too far from each other for a link, few near."""
    rng = random.Random(seed)
    original = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(copies):
        made = list(original)
        for place in rng.sample(range(200), rng.randint(6, 13)):
            made[place] = f"x{rng.randrange(12)}"
        rows.append((k, " ".join(made), "en", "s", 1))
    return rows


def components_by_matrix(rows, width, percent=80):
    """Components of the documents, all pairs compared by a product of their incidence matrices."""
    sets = [s for (s,) in sets_of([r[:2] for r in rows], width).values()]
    places = {g: k for k, g in enumerate(set().union(*sets))}
    held = np.zeros((len(sets), len(places)), dtype=np.float32)
    for k, some in enumerate(sets):
        held[k, [places[g] for g in some]] = 1
    shared, sizes = held @ held.T, held.sum(axis=1)
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    label = np.arange(len(sets))
    while True:
        low = np.where(linked, label[None, :], len(sets)).min(axis=1)
        if (low == label).all():
            return label
        label = low


def test_large_buckets_of_distant_edits(spark):
    """Rounds of stars that add no link leave links behind where most edits are no link's end."""
    rows = edits(11, 1100)
    found = near_duplicates(cases.documents(spark, rows), NearDuplicates(width=2, block=100))
    label = components_by_matrix(rows, 2)
    assert 100 < len(set(label)) < 1100
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(label))


def test_larger_sets_are_compared_by_their_bins(spark):
    """Sets about the size up to which hashes are compared, and beyond, that no single centre links."""
    rng = random.Random(12)
    rows = []
    for group, size in enumerate((360, 470, 900)):
        original = [f"g{group}w{k}" for k in range(size)]
        for k in range(120):
            made = original[: size - rng.randrange(size // 20)]
            for place in rng.sample(range(len(made)), rng.randint(size // 50, size // 18)):
                made[place] = f"x{rng.randrange(20)}"
            rows.append((1000 * group + k, " ".join(made), "en", "s", 1))
    found = near_duplicates(cases.documents(spark, rows), NearDuplicates(width=2, block=40))
    label = components_by_matrix(rows, 2)
    ids = [r[0] for r in rows]
    assert 20 < len(set(label)) < 300
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: ids[c] for i, c in zip(ids, label, strict=True)}


def test_three_thousand_edits(spark):
    rows = edits(13, 3000)
    found = near_duplicates(cases.documents(spark, rows), NearDuplicates(width=2))
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(components_by_matrix(rows, 2)))


def test_empty_table(spark):
    assert near_duplicates(cases.documents(spark, [])).count() == 0


def test_hashes_do_not_depend_on_the_blocks():
    rng = random.Random(1)
    texts = [cases.prose(rng, rng.randint(0, 3000)) for _ in range(8)] + [None, "", "a" * 600_000 + " b"]
    hasher = WordHasher()
    together = list(hasher.texts(texts))
    for text, found in zip(texts, together, strict=True):
        words = WORD.findall((text or "").lower())
        assert len(found) == len(words)
        one_by_one = [hasher.words(w.encode())[1][0] for w in words[:50]]
        assert list(found[:50]) == one_by_one
    assert len(shingles(together[0][:1], 2)) == min(1, len(together[0]))
    assert len(np.unique(np.concatenate(together))) == len({w for t in texts for w in WORD.findall((t or "").lower())})


def test_a_cell_gives_a_forest_of_links_not_its_likely_pairs():
    """Large sets at a similarity of 0.74 are likely pairs and no links; of 20 linked sets, 19 links are enough."""
    settings, rng = NearDuplicates(), np.random.default_rng(15)
    sketcher, original = _Sketcher(settings), rng.integers(1 << 63, size=2000, dtype=np.uint64)

    def edited(share, copies):
        """Sets that each lack a share of the original."""
        return [np.sort(original[rng.random(2000) >= share]) for _ in range(copies)]

    def forest(sets):
        rows = [
            {
                "probe": probe,
                "n": len(s),
                "component": k,
                "hashes": None,
                "bins": sketcher.bands_of(s)[1],
                "whole": s.tobytes(),
            }
            for probe in (False, True)
            for k, s in enumerate(sets)
        ]
        types = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        schema = pa.schema(list(zip(rows[0], types, strict=True)))
        return list(_compare(pa.RecordBatch.from_pylist(rows, schema), settings))

    assert forest(edited(0.15, 40)) == []
    assert len(forest(edited(0.05, 20))) == 19
