from __future__ import annotations

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from cinestar.llm import token_count
from cinestar.llm.vocabularies import vocabulary_path
from tests.llm import cases

TEXTS = [
    "", " ", "Don't WE'LL", "á é ́x", "<|startoftext|> a <|endoftext|>b", "12 345,6", "\x1ca\x1c b",
    "İstanbul ẞ ǅ", "日本語 テキスト", "no break   wide", "x" * 3000, "a\r\nb\tc\x0bd\x0ce",
]


def test_equals_the_library(spark):
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    rows = cases.rows() + [(900 + k, t, "en", "s", 1) for k, t in enumerate(TEXTS)]
    found = token_count.count_tokens(cases.documents(spark, rows), limit=100)
    expected = Counter()
    for row in rows:
        n = len(tokenizer.encode(row[1] or "", add_special_tokens=False))
        expected[row[0], len((row[1] or "").encode()), n, n > 100] += 1
    got = found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert Counter(map(tuple, got)) == expected
    assert token_count.count_tokens(cases.documents(spark, [])).count() == 0


def test_chunks_compose(monkeypatch):
    transducer = token_count.CountingTransducer("word_bpe_49k.json")
    rng = random.Random(2)
    texts = TEXTS + [cases.prose(rng, 4)]
    whole = [transducer.count(t) for t in texts]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(token_count, "CHUNK", size)
        assert [transducer.count(t) for t in texts] == whole


@pytest.fixture(scope="module")
def both():
    name = "word_bpe_49k.json"
    return token_count.CountingTransducer(name), Tokenizer.from_file(vocabulary_path(name))


def test_words_are_counted_without_the_library(both, monkeypatch):
    """Random words, runs of few letters (where merges of one rank meet), and words of 100,000 letters."""
    transducer, library = both
    rng = random.Random(3)
    latin = [chr(c) for c in [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x250)]]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 25))) for letters in
             (latin, "etaoinshrdlu", "ab", "a", "aA!'s1", "thein") for _ in range(500)]
    words += ["".join(rng.choices(letters, k=100_000)) for letters in ("etaoinshrdlu", "a", "1!x")]
    expected = [len(library.encode(w, add_special_tokens=False)) for w in words]
    monkeypatch.setattr(token_count, "_STATES", 500)
    found = [transducer._word(w) for w in words]
    odd = [w for w in words if any(len(c.lower()) > 1 or c.lower() > "\u024f" for c in w)]
    assert found == expected
    # Only letters whose small form lies elsewhere went to the library.
    transducer.exact = None
    for word in words:
        if word not in odd:
            transducer._word(word)
    assert transducer.exact is None


def test_compatible_tokens_are_those_that_stand_together(both):
    transducer, library = both
    merges, rng = transducer.merges, random.Random(4)
    tokens = [t for t in merges.number if t.isascii() and t.islower() and t.isalpha() and len(t) < 6]
    for _ in range(4000):
        left, right = rng.choice(tokens), rng.choice(tokens)
        # Inside a word: what follows may change the right one, so it must stand at the end.
        if right + "</w>" not in merges.number:
            continue
        right += "</w>"
        if not (merges.is_whole(left) and merges.is_whole(right)):
            continue
        word = left + right.removesuffix("</w>")
        stands = library.encode(word, add_special_tokens=False).tokens == [left, right]
        assert merges.compatible(left, right) == stands, (left, right)
