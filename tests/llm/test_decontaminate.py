from __future__ import annotations

import random
import re

import pytest

from cinestar.llm.decontaminate import Decontamination, find_leaks
from tests.llm import cases

ITEM = (
    "If the train of Anna leaves at 9 and travels 120 km before the train of Bruno leaves at 11, "
    "how many km has the train of Anna travelled when both have arrived?"
)
# The same question with other values, and one whose values contradict each other.
OTHER = ITEM.replace("Anna", "Clara").replace("Bruno", "Diego").replace("9", "7").replace("120", "300").replace("11", "8")
CLASH = OTHER.replace("train of Clara travelled", "train of Elena travelled")


def leaks_of(spark, texts, items, settings=Decontamination()):
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = find_leaks(cases.documents(spark, rows), benchmark, settings).collect()
    return {r.doc_id: {(x.item_id, x.verbatim) for x in r.leaks} for r in found}


def test_templates(spark):
    rng = random.Random(5)
    around = [cases.prose(rng), cases.prose(rng, 2000)]
    texts = [
        ITEM, f"{around[0]}\n{ITEM}\n{around[0]}", OTHER, CLASH, f"{around[1]} {ITEM} {around[1]}",
        ITEM[:60], f"{OTHER}\n\n{ITEM}", None, "", around[0],
    ]
    found = leaks_of(spark, texts, [(1, ITEM), (2, None), (3, "too short"), (4, "")])
    assert found == {
        0: {(1, True)}, 1: {(1, True)}, 2: {(1, False)}, 3: set(), 4: {(1, True)},
        5: set(), 6: {(1, True)}, 7: set(), 8: set(), 9: set(),
    }


def test_copies_in_other_case(spark):
    """Capitals make names: a copy in other capitals has other templates, but the same words."""
    street = "Auf der großen Straße fährt Ärztin Zoë um 9 Uhr nach Ελλάδα und Élise folgt ihr später"
    names = "Anna Bruno 12 Clara Diego 15 Elena Fabio 18"
    items = [(1, ITEM), (2, street), (3, names)]
    copies = [case(item) for _, item in items for case in (str.upper, str.title, str.lower)]
    found = leaks_of(spark, [*copies, names, "Anna Bruno 13 Clara Diego 16"], items)
    assert found == {
        **{k: {(k // 3 + 1, True)} for k in range(9)}, 9: {(3, True)}, 10: set(),
    }


def brute_force(text: str, items) -> set[int]:
    """Items of plain lower-case words of which the text holds 80 % of the windows."""
    def windows(body):
        words = [w.lower() for w in re.findall(r"\w+", body)]
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    mine = windows(text or "")
    return {i for i, t in items if (w := windows(t)) and len(w & mine) >= 0.8 * len(w)}


@pytest.mark.parametrize("settings", [Decontamination(), Decontamination(filter_bits=1 << 15)])
def test_equals_brute_force_with_any_filter(spark, settings):
    rng = random.Random(6)
    words = [rng.choice(cases.SYLLABLES) + rng.choice(cases.SYLLABLES) for _ in range(60)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(3, 40)))) for k in range(25)]
    items.append((25, items[0][1]))
    texts = []
    for _ in range(40):
        text = rng.choices(words, k=30)
        leaked = rng.choice(items)[1].split()
        cut = rng.choice([0, 0, 2, len(leaked) // 2])
        text[rng.randrange(30):0] = leaked[cut:]
        texts.append(" ".join(text))
    found = leaks_of(spark, texts, items, settings)
    assert {k: {i for i, _ in v} for k, v in found.items()} == {
        k: brute_force(t, items) for k, t in enumerate(texts)
    }


GERMAN = (
    "Der Händler Anton kauft in der Stadt am Montag 12 Kisten mit Äpfeln und verkauft der Nachbarin Berta davon 5, "
    "wie viele Kisten hat der Händler Anton am Abend noch im Laden übrig?"
)
FRENCH = (
    "Le fermier Luc achète 14 sacs de blé au marché et en donne 6 à son voisin Paul avant la nuit, "
    "combien de sacs reste-t-il au fermier Luc le matin suivant ?"
)
SPANISH = (
    "La maestra Eva compra 20 libros para la escuela y regala 8 a su amiga Sara antes del verano, "
    "¿cuántos libros le quedan a la maestra Eva en septiembre?"
)


def test_questions_of_other_languages_with_other_values(spark):
    other = [
        GERMAN.replace("Anton", "Gustav").replace("Berta", "Hilde").replace("12", "30").replace("5,", "11,"),
        FRENCH.replace("Luc", "Rémi").replace("Paul", "Jean").replace("14", "25").replace("6", "9"),
        SPANISH.replace("Eva", "Inés").replace("Sara", "Lola").replace("20", "31").replace("8", "4"),
    ]
    clash = other[0].replace("Händler Gustav am Abend", "Händler Kunz am Abend")
    prose = "Der Bäcker Anton fährt am Montag in der Stadt mit der Nachbarin Berta zum Markt und kauft Brot."
    items = [(1, GERMAN), (2, FRENCH), (3, SPANISH)]
    found = leaks_of(spark, [GERMAN, FRENCH, SPANISH, *other, clash, prose], items)
    assert found == {
        0: {(1, True)}, 1: {(2, True)}, 2: {(3, True)}, 3: {(1, False)}, 4: {(2, False)}, 5: {(3, False)},
        6: set(), 7: set(),
    }


def test_items_that_share_ids_or_texts(spark):
    items = [(1, ITEM), (1, ITEM), (1, GERMAN), (2, ITEM), (None, ITEM), (3, None)]
    found = leaks_of(spark, [ITEM, GERMAN, ITEM], items)
    assert found == {0: {(1, True), (2, True), (None, True)}, 1: {(1, True)}, 2: {(1, True), (2, True), (None, True)}}


def test_a_benchmark_many_times_as_large(spark):
    """Its windows fill the bitmap; nothing is lost, and the driver holds no item."""
    rng = random.Random(8)
    items = [(k, cases.sentence(rng, 30)) for k in range(1500)]
    texts = [f"{cases.sentence(rng, 5)}\n{items[k][1]}" for k in range(0, 1500, 100)]
    found = leaks_of(spark, texts, items, Decontamination(filter_bits=1 << 15))
    assert found == {k: {(100 * k, True)} for k in range(15)}


def test_empty_tables(spark):
    assert leaks_of(spark, [ITEM], []) == {0: set()}
    assert leaks_of(spark, [], [(1, ITEM)]) == {}
