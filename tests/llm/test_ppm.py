from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from cinestar.llm.ppm import Ppm, score_documents
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def stream(text, order):
    return bytes([255]) * order + (text or "").translate(LOWER).encode() + bytes([254])


class Trie:
    """Counts of bytes after each context, and shares by the definition."""

    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(Counter)
        for text in texts:
            data = stream(text, order)
            for k in range(order, len(data)):
                for size in range(order + 1):
                    self.after[data[k - size : k]][data[k]] += 1

    def share(self, context, byte):
        excluded, found = set(), 1.0
        for size in range(len(context), -1, -1):
            seen = self.after.get(context[len(context) - size :], {})
            left = {b: n for b, n in seen.items() if b not in excluded}
            total = sum(left.values())
            if byte in left:
                return found * (2 * left[byte] - 1) / (2 * total)
            if left:
                found *= len(left) / (2 * total)
            excluded |= set(seen)
        return found / (256 - len(excluded))


def held_out(doc_id):
    return crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("order", [0, 3, 5])
def test_equals_brute_force(spark, order):
    # The long text at the default order; half of the rows have no id, or one id.
    rows = [r[:2] for r in cases.rows() if r[0] != 306 or order == Ppm().order]
    rng = random.Random(order)
    rows += [(rng.choice([None, 77]), cases.prose(rng, rng.randint(0, 2))) for _ in range(len(rows))]
    training = [t for k, t in rows if not held_out(k)]
    trie = Trie(training, order)
    counts = Counter(w for t in training for w in [*WORD.findall((t or "").translate(LOWER)), None])
    total, kinds = sum(counts.values()), len(counts)
    expected = defaultdict(list)
    for doc_id, text in rows:
        tokens = [*WORD.findall((text or "").translate(LOWER)), None]
        data = stream(text, order)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        shares = [trie.share(data[k - order : k], data[k]) for k in range(order, len(data))]
        known = sum(counts[t] > 0 for t in tokens)
        found = (held_out(doc_id), len(tokens), known, total, base, sum(map(math.log10, shares)))
        expected[doc_id].append(found)
    frame = cases.documents(spark, [(*r, "en", "s", 1) for r in rows])
    got = score_documents(frame, Ppm(order=order, block_bytes=5000)).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(list)
    for row in got:
        by_id[row.doc_id].append(tuple(row)[1:])
    for doc_id, found in expected.items():
        for one, two in zip(sorted(by_id[doc_id]), sorted(found), strict=True):
            assert one == pytest.approx(two, rel=1e-9)
    context = b"the"[:order]
    assert math.isclose(sum(trie.share(context, b) for b in range(256)), 1.0)


def test_without_training_rows_and_without_rows(spark):
    held = next(k for k in range(100) if held_out(k))
    one = score_documents(cases.documents(spark, [(held, "ab", "en", "s", 1)])).collect()
    assert one[0].n_known == 0 and one[0].train_tokens == 0
    assert math.isclose(one[0].score, 3 * math.log10(1 / 256))
    assert score_documents(cases.documents(spark, [])).count() == 0
