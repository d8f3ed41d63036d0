"""Small scalar rules of the film model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two roles, and the mark of a voice role in a character.
VOICE = "voice"
PLAYER = "actor/actress"
_VOICE_MARK = "(voice)"


def role_of(character: Column) -> Column:
    """`voice` when the character says so (case-sensitive), else `actor/actress`, also for NULL."""
    return F.when(character.contains(_VOICE_MARK), VOICE).otherwise(PLAYER)


def bare_imdb_id(imdb_id: Column) -> Column:
    """The outside id without its two-character prefix `tt`."""
    return F.substring(imdb_id, 3, 1 << 30)


def slice_of(key: Column, slices: int) -> Column:
    """Number of the worker slice, 0..slices-1, that a key belongs to."""
    if slices < 1:
        raise ValueError("slices must be at least 1")
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
