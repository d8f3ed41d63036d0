"""Cleaning and parsing of collection cells, against literal rows and Python's own reader."""

from __future__ import annotations

import ast

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinestar.functions.literals import POLICIES, clean_literal, parse_literal
from cinestar.sources import schemas


def parse(spark, cells, element=schemas.ID_NAME, policy="exact"):
    rows = spark.createDataFrame(list(enumerate(cells)), "i int, cell string")
    parsed = rows.withColumn("value", parse_literal(F.col("cell"), element, policy))
    found = {row["i"]: row["value"] for row in parsed.collect()}
    return [
        None if found[i] is None else [None if e is None else tuple(e) for e in found[i]]
        for i in range(len(cells))
    ]


# (cell, policy, expected elements)
CASES = [
    ("[{'id': 1, 'name': 'x'}]", "none", [(1, "x")]),
    ("""[{'id': 1, 'name': "Director's"}]""", "none", [(1, "Director's")]),
    (r"[{'id': 1, 'name': 'a\'b'}]", "none", [(1, "a'b")]),
    ("[{'id': 1, 'name': None}]", "none", None),
    ("[{'id': 1, 'name': True}]", "none", None),
    (r"[{'id': 1, 'name': 'a\xa0b'}]", "none", None),
    ("[{'id': 'zz', 'name': 'q'}, {'id': 2, 'name': 'r'}]", "none", [(None, "q"), (2, "r")]),
    ("{'id': 7, 'name': 'o'}", "none", [(7, "o")]),
    ("[null, {'id': 1}]", "none", [None, (1, None)]),
    ("[{'id': 1, 'name': 'x', 'more': [1, {'z': 2}]}]", "none", [(1, "x")]),
    ("[]", "exact", []),
    ("abc", "exact", None),
    ("", "exact", None),
    (None, "exact", None),
    ("[{'id': 1, 'name': 'x'", "exact", None),
    ("[{'id': 1, 'name': None}]", "exact", [(1, None)]),
    ("[{'id': 1, 'name': None}]", "strip", [(1, None)]),
    ("[{'id': 1, 'name': None}]", "space", [(1, None)]),
    ("[{'id': 1, 'name': 'Bond: None shall pass'}]", "exact", [(1, "Bond: None shall pass")]),
    ("[{'id': 1, 'name': 'Bond: None shall pass'}]", "strip", [(1, "Bond: null shall pass")]),
    ("[{'id': 1, 'name': 'x: None, [True, False]'}]", "exact", [(1, "x: None, [True, False]")]),
    (r"[{'id': 1, 'name': 'a\xa0b'}]", "exact", [(1, "a\xa0b")]),
    (r"[{'id': 1, 'name': 'a\xa0b'}]", "strip", [(1, "axa0b")]),
    (r"[{'id': 1, 'name': 'a\\x41 \\\x41'}]", "exact", [(1, "a\\x41 \\A")]),
    (r"[{'id': 1, 'name': 'O\'Neil'}]", "exact", [(1, "O'Neil")]),
    (r"[{'id': 1, 'name': 'O\'Neil'}]", "strip", [(1, "ONeil")]),
    (r"[{'id': 1, 'name': 'O\'Neil'}]", "space", [(1, "O Neil")]),
    ("""[None, {'id': 2, 'name': "D's"}]""", "exact", [None, (2, "D's")]),
    ("""[None, {'id': 2, 'name': "D's"}]""", "strip", None),
    ("[{'id': None, 'name': 'None'}, None, {'id': 3}]", "exact", [(None, "None"), None, (3, None)]),
]


def test_cases(spark):
    for policy in POLICIES:
        cases = [case for case in CASES if case[1] == policy]
        found = parse(spark, [cell for cell, _, _ in cases], policy=policy)
        for (cell, _, expected), value in zip(cases, found, strict=True):
            assert value == expected, (policy, cell)


def test_unknown_policy():
    with pytest.raises(ValueError, match="unknown policy"):
        clean_literal(None, "other")


def test_huge_cell(spark):
    """A cell of several megabytes is matched without deep recursion."""
    count = 100_000
    cell = "[" + ", ".join(r"{'id': %d, 'name': 'x\'y', 'p': None}" % i for i in range(count)) + "]"
    value = parse(spark, [cell])[0]
    assert len(value) == count and value[-1] == (count - 1, "x'y")


# Everything repr() prints as itself or as \n \t \r \\ \' \xNN; characters beyond
# the basic plane that Python prints as \UNNNNNNNN have no JSON escape.
TEXT = st.text(
    st.one_of(
        st.sampled_from("'\"\\NoneTrueFalse:,[]{} x41\n\t\r\xa0\x00\x7f"),
        st.characters(max_codepoint=0xFF),
    ),
    max_size=25,
) | st.sampled_from(["None", "True", ": None,", "\\x41", "a\\", "'", '"', "'\""])
ELEMENT = st.fixed_dictionaries(
    {"id": st.none() | st.integers(-5, 5), "name": st.none() | TEXT, "flag": st.booleans() | st.none()}
)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.none() | ELEMENT, max_size=4), min_size=40, max_size=120))
def test_printed_lists_come_back(spark, collections):
    cells = [repr(collection) for collection in collections]
    expected = [
        [None if e is None else (e["id"], e["name"]) for e in ast.literal_eval(cell)]
        for cell in cells
    ]
    assert parse(spark, cells) == expected


def test_wide_escapes_become_their_characters(spark):
    """As Python prints private and unassigned characters beyond the basic plane."""
    names = ["a\U000f0000b", "\U0010ffff\U000f0000\U000f0000", "back\\slash \\U000f0000", "plain"]
    cells = [(repr([{"id": k, "name": name}]),) for k, name in enumerate(names)]
    cells += [("[{'id': 9, 'name': '\\UFFFFFFFF'}]",), ("[{'id': 8, 'name': '\\\\U000f0000'}]",)]
    assert "\\U" in cells[0][0]
    frame = spark.createDataFrame(cells, "cell string")
    parsed = frame.select(parse_literal(F.col("cell"), "id int, name string").alias("e")).collect()
    assert [row.e and row.e[0].name for row in parsed] == [*names, None, "\\U000f0000"]
