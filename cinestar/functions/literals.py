"""Python-literal text -> JSON text -> typed collections, as Column expressions.

The raw exports hold collections the way Python prints a list of dicts: single
quotes, `None`, `\\'` and `\\xNN` escapes. Spark's JSON parser already accepts
single quotes and `\\'`; what remains is turned into JSON by one of the policies:

exact   rewrite `None`, `True`, `False`, `\\xNN` and `\\UNNNNNNNN`, only outside of strings
        (the words) or only as real escapes; no text is altered
strip   `: None` -> `: null`, then drop `\\'` and every other backslash
space   like strip, but each dropped piece becomes a blank
none    parse as it is
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLICIES = ("exact", "strip", "space", "none")

# One quoted string. The possessive loops keep the matcher iterative, so a cell
# of any length is matched without recursion.
_STRING = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+\""""

# `\xNN` as the end of an odd run of backslashes is an escape; `\\xNN` is text.
# The run's first backslash is matched before the look behind it, which makes
# all other characters cheap to pass.
_HEX_ESCAPE = r"(\\(?<!\\\\)(?:\\\\)*+)x([0-9a-fA-F]{2})"


def _word_rule(word: str, json_word: str) -> tuple[str, str, str]:
    """Replace a bare word, stepping over quoted strings from match to match."""
    first, rest = word[0], word[1:]
    pattern = rf"(?s)\G((?:[^'\"{first}]++|{_STRING}|{first}(?!{rest}\b))*+){word}\b"
    return word, pattern, f"$1{json_word}"


# (text a cell must hold for the rule to apply, pattern, replacement)
_RULES = (
    ("\\x", _HEX_ESCAPE, "$1u00$2"),
    _word_rule("None", "null"),
    _word_rule("True", "true"),
    _word_rule("False", "false"),
)


def _apply_rule(text: Column, mark: str, pattern: str, replacement: str) -> Column:
    """Replace where the mark occurs: a substring test is far cheaper than a pattern.

    The lambda evaluates `text` once; in a plain `when` each of its three uses
    would evaluate it again, and so on down a chain of rules.
    """
    return F.transform(
        F.array(text),
        lambda t: F.when(t.contains(mark), F.regexp_replace(t, pattern, replacement)).otherwise(t),
    )[0]


def _wide_escapes(text: Column) -> Column:
    """`\\UNNNNNNNN` as the character itself, where it is an escape and names one.

    JSON has no such escape. Each distinct one of a cell is replaced on its own.
    """

    def put(result: Column, code: Column) -> Column:
        character = F.decode(F.unhex(code), "UTF-32")
        pattern = F.concat(F.lit(r"(?<!\\)((?:\\\\)*+)\\U"), code)
        return F.regexp_replace(result, pattern, F.concat(F.lit("$1"), character))

    codes = F.regexp_extract_all(text, F.lit(r"\\U(00(?:0[0-9a-fA-F]|10)[0-9a-fA-F]{4})"), F.lit(1))
    replaced = F.aggregate(F.array_distinct(codes), text, put)
    return F.when(text.contains("\\U"), replaced).otherwise(text)


def _exact(text: Column) -> Column:
    text = F.transform(F.array(text), _wide_escapes)[0]
    for rule in _RULES:
        text = _apply_rule(text, *rule)
    return text


def _drop_escapes(text: Column, filler: str) -> Column:
    text = F.replace(text, F.lit(": None"), F.lit(": null"))
    text = F.replace(text, F.lit("\\'"), F.lit(filler))
    return F.replace(text, F.lit("\\"), F.lit(filler))


def clean_literal(text: Column, policy: str = "exact") -> Column:
    """JSON text for a Python-literal cell (NULL stays NULL)."""
    if policy == "exact":
        return _exact(text)
    if policy == "strip":
        return _drop_escapes(text, "")
    if policy == "space":
        return _drop_escapes(text, " ")
    if policy == "none":
        return text
    raise ValueError(f"unknown policy {policy!r}; choose one of {POLICIES}")


def parse_literal(text: Column, element: T.StructType | str, policy: str = "exact") -> Column:
    """Array of structs held in a Python-literal cell; NULL where it does not parse."""
    return F.from_json(clean_literal(text, policy), _array_of(element))


def _array_of(element: T.StructType | str) -> T.ArrayType | str:
    if isinstance(element, str):
        return f"array<struct<{element}>>"
    return T.ArrayType(element)
