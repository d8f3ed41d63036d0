from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from cinestar.llm import spelling
from cinestar.llm.spelling import Spelling, affected_bound, decompose, one_edit, spelling_groups
from tests.llm import cases


def brute(rows, settings):
    """Each word's (word, form, root, n, n_near, form_n); near words share a one-code-point deletion or one is it."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if settings.mistakes and h % settings.mistakes == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= settings.length:
                n[run] += 1
    words = {w: k for w, k in n.items() if k >= settings.occurrences}
    shorter = defaultdict(set)
    for word in words:
        for k in range(len(word)):
            shorter[word[:k], word[k + 1 :]].add(word)
    near = defaultdict(set)
    for (left, right), group in shorter.items():
        for word in group:
            near[word] |= group - {word}
        if left + right in words:
            for word in group:
                near[word].add(left + right)
                near[left + right].add(word)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda w: (-words[w], w), default=word)
        if words[best] >= settings.lead * words[word]:
            form[word] = best
    out = Counter()
    for word, k in words.items():
        root = word
        while root in form:
            root = form[root]
        out[word, form.get(word), root, k, len(near[word]), words.get(form.get(word))] += 1
    return out


def ours(spark, rows, settings, parts=4):
    frame = cases.documents(spark, [(*r, "en", "s", 1) for r in rows], parts)
    return Counter(tuple(r) for r in spelling_groups(frame, settings).collect())


def made_rows(rng, n):
    """Texts of few stems with many edits, of letters that ASCII lower-casing leaves alone too."""
    letters = "abcÉéÿB"
    stems = ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(30)] + ["aaaaa", "ababababab"]
    rows = []
    for k in range(n):
        words = []
        for _ in range(60):
            word = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(word))
                word[at : at + rng.choice([0, 1])] = rng.choices(letters, k=rng.choice([0, 1]))
                word = word or ["a"]
            words.append("".join(word))
        rows.append((k, rng.choice([" ", "-", "9", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize(
    "settings",
    [
        Spelling(),
        Spelling(mistakes=3, occurrences=1, frequent=2, list_words=3, task_rows=500),
        Spelling(mistakes=0, occurrences=2, lead=3, shortest=1, longest=3, frequent=1, words_per_gram=2),
    ],
)
def test_equals_brute_force(spark, settings):
    rows = made_rows(random.Random(8), 120) + [r[:2] for r in cases.rows()]
    rows += [(500, "Straße STRAßE x×y÷z"), (501, "q" * 300), (502, "q" * 300), (503, "q" * 300), (504, "q" * 301)] * 3
    rows += [(600 + k, "".join(random.Random(1).choices("abc", k=45))) for k in range(9)]
    rows += [(700 + k, "".join(random.Random(1).choices("abc", k=45))[:-1]) for k in range(4)]
    assert ours(spark, rows, settings) == brute(rows, settings)


def test_bound_of_affected_grams():
    rng = random.Random(2)
    for _ in range(3000):
        word = "".join(rng.choices("ab", k=rng.randint(5, 9)))
        grams_of = lambda w: {(p, f"^{w}$"[p:e]) for p, e in decompose(f"^{w}$", frequent, 2, 5)}
        frequent = frozenset(
            "".join(rng.choices("^ab$", k=rng.randint(2, 4))) for _ in range(rng.choice([0, 5, 60]))
        )
        at, edit = rng.randrange(len(word)), rng.choice(["", "a", "b"])
        other = word[:at] + edit + word[at + 1 :]
        grams = decompose(f"^{word}$", frequent, 2, 5)
        moved = len(word) - len(other)
        there = grams_of(other)
        same = sum((p, g) in there or (p - moved, g) in there for p, g in grams_of(word))
        assert same >= len(grams) - affected_bound(grams, len(word) + 2) >= 1


def test_one_edit():
    rng = random.Random(3)
    for _ in range(3000):
        one, two = ("".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in "12")
        cuts = lambda w: {(w[:k], w[k + 1 :]) for k in range(len(w))}
        joined = lambda w: {a + b for a, b in cuts(w)}
        near = one != two and (
            (len(one) == len(two) and bool(cuts(one) & cuts(two))) or one in joined(two) or two in joined(one)
        )
        assert one_edit(one, two) == near


def test_long_texts_are_cut_between_runs(spark, monkeypatch):
    rows = made_rows(random.Random(9), 20)
    texts = [t for _, t in rows]
    monkeypatch.setattr(spelling, "_PIECE", 7)
    for text in texts:
        pieces = list(spelling._pieces(text))
        assert "".join(pieces) == text
        runs = [r for p in pieces for r in spelling.RUN.findall(p)]
        assert runs == spelling.RUN.findall(text)


def test_settings_without_sure_results_are_refused(spark):
    for settings in (Spelling(length=4), Spelling(lead=1)):
        with pytest.raises(ValueError):
            spelling_groups(cases.documents(spark, []), settings)


def test_empty_table(spark):
    assert ours(spark, [], Spelling()) == Counter()
    assert ours(spark, [(1, "one two")], Spelling()) == Counter()
