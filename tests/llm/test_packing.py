from __future__ import annotations

from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from cinestar.llm.packing import Packing, best_fit, pack, placed_pieces, _Item
from cinestar.llm.vocabularies import ByteLevelIds, vocabulary_path
from tests.llm import cases


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


TEXTS = [
    "", " ", "  two  blanks ", "a\n\nb \n c", "tab\tand more   blanks", "don't we'll I'm",
    "x <|endoftext|> y<|endoftext|>", "<|endoftext|>", "日本語 のテキスト", "naïve café 𝄞𝄞", "1234 56,7 %%%",
    " lead", "trail ", "\x1c odd \x85 breaks \x0b",
]


def test_ids_equal_the_library(tokenizer):
    ours = ByteLevelIds()
    for text in TEXTS + [r[1] or "" for r in cases.rows()]:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(np.frombuffer(ours.ids(text), dtype="<u4")) == expected, text


def expected_pieces(rows, tokenizer, capacity):
    out = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        end, start, piece = (len(ids) - 1) % capacity + 1, 0, 0
        while start < len(ids):
            part = np.array(ids[start:end], dtype="<u4").tobytes()
            out[doc_id, piece, start, end - start, crc32(part)] += 1
            start, end, piece = end, end + capacity, piece + 1
    return out


@pytest.mark.parametrize(
    "settings",
    [Packing(), Packing(capacity=64, block_ids=300, merge_bins=5), Packing(capacity=3, merge_bins=50)],
)
def test_every_id_has_one_place(spark, tokenizer, settings):
    rows = [r[:2] for r in cases.rows()] + [(500 + k, t) for k, t in enumerate(TEXTS)]
    frame = cases.documents(spark, [(*r, "en", "s", 1) for r in rows], parts=5)
    found = placed_pieces(pack(frame, settings)).collect()
    pieces = Counter(tuple(r)[:5] for r in found)
    assert pieces == expected_pieces(rows, tokenizer, settings.capacity)
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= settings.capacity
    if settings == Packing():
        bound = -(-sum(r.length for r in found) // settings.capacity)
        assert len(sequences) <= bound + 1


def test_best_fit_leaves_no_two_bins_that_would_fit_together():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 100, 500)
    bins = best_fit([_Item([n], [], int(n)) for n in lengths], 100)
    assert sorted(n for b in bins for n in b.segments) == sorted(lengths)
    assert all(sum(b.segments) == b.length <= 100 for b in bins)
    low = sorted(b.length for b in bins)
    assert low[0] + low[1] > 100


def test_the_tree_is_followed_to_its_root(spark):
    """The small bins of many tasks meet, however few bins a merge takes."""
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(40)
    found = []
    for merge_bins in (10_000, 200, 50):
        lengths = sorted(r.length for r in pack(frame, Packing(merge_bins=merge_bins)).select("length").collect())
        found.append(len(lengths))
        # No two of them would fit together.
        assert lengths[0] + lengths[1] > 2048
    bound = -(-sum(lengths) // 2048)
    # 40 tasks of 12 sequences each: what a task's last bins leave free adds up to a few sequences.
    assert max(found) <= bound + 8 and max(found) - min(found) <= 1


def test_empty_table(spark):
    assert pack(cases.documents(spark, [])).count() == 0
