"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words without outer punctuation,
in lower case, with typed placeholders for numbers (a digit in it), for units
(after a number) and for names (a capital inside a sentence). An item of the
benchmark is known by the hashes of its windows of `width` tokens; a window
needs `min_literals` tokens that are no placeholder, else any form letter would
match it. Where capitals are common inside sentences (nouns have them in some
languages), a window needs `min_literals_capitals` only.

The windows of the items are a table, the windows of the documents are joined to
it on their hashes. Windows that lie on one diagonal (document place minus item
place) are one reading of the item, and count only if the reading is consistent:
equal slot values of the item stand for equal values in the document. So a
question with other numbers and names is caught, and text that merely has the
same shape twice with clashing values is not. An item is leaked if its document
holds `min_coverage` of its windows.

Capitals make names, so a copy in capitals, in title case or in lower case has
other templates than its item. Each item is therefore also joined by its plain
windows: `width` case-folded words, without placeholders and without a least
number of literals. The better coverage of the two counts; one by plain windows
is verbatim.

A bitmap of `filter_bits` bits tells the tasks which windows of a document can
have a partner at all, so few of them are shuffled; it is of that size however
large the benchmark, and a full one costs rows and no results. Neither the
benchmark nor its windows go to the driver. What a text leaks depends on the
text alone: texts go by a 128-bit hash, so the windows of copies are joined
once, and found leaks are joined back to all rows.

Defined results: a null or empty text leaks nothing; an item without text, or
with fewer than `width` tokens, is never found; items of equal texts are found
each, and rows equal in id and text are one item; repeated rows of documents are
judged one by one; an empty benchmark or table finds nothing. Columns named like
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.llm.frames import bitmap, fresh, slices, staged
from cinestar.llm.hashing import BLOCK, WordHasher, mix

_U = np.uint64

# Units of measure and money, as they are written after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre "
    "metres kilometer kilometers kilometre kilometres mg g kg t oz lb lbs gram grams kilogram "
    "kilograms pound pounds ton tons ml cl l liter liters litre litres gallon gallons s sec "
    "second seconds min minute minutes h hr hour hours day days week weeks month months year "
    "years km/h mph kph m/s hz khz mhz ghz w kw v a j kj kcal k c f percent usd eur gbp dollar "
    "dollars cent cents euro euros kb mb gb tb"
).split()


@dataclass(frozen=True)
class Decontamination:
    """Tokens of a window; least literals in it, and where capitals make `many_capitals` of a text's words; coverage."""

    width: int = 5
    min_literals: int = 3
    min_literals_capitals: int = 2
    many_capitals: float = 0.2
    min_coverage: float = 0.8
    filter_bits: int = 1 << 24


class Templates:
    """Template tokens of a text: hashes by which they compare, and the values in their slots."""

    NUMBER, NAME, UNIT = (int(v) for v in mix(np.array([11, 12, 13], dtype=_U)))

    def __init__(self, settings: Decontamination) -> None:
        self.settings = settings
        self.hasher = WordHasher(lower=True)
        codes = np.arange(256)
        letter = ((codes | 32) >= 97) & ((codes | 32) <= 122) | (codes >= 128)
        self.digit = (codes >= 48) & (codes <= 57)
        self.inner = letter | self.digit
        self.capital = (codes >= 65) & (codes <= 90)
        self.ends = np.isin(codes, [ord(c) for c in ".!?:"])
        self.units = np.sort(np.concatenate([self._words(u.encode())[0] for u in UNITS]))

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per word with a letter or digit: hash, has a digit, has a capital, opens a sentence."""
        raw = np.frombuffer(data, dtype=np.uint8)
        two = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)  # capitals of Latin-1
        starts, ends, first, last = self._edges(raw)
        # Folding changes no white space and leaves letters letters: the words stay the same.
        if data.isascii():
            hashes = self._hashes(raw, first, last)
        else:
            folded = np.frombuffer(data.decode().casefold().encode(), dtype=np.uint8)
            hashes = self._hashes(folded, *self._edges(folded)[2:])
        digits = np.concatenate(([0], np.cumsum(self.digit[raw])))
        capital = self.capital[raw[first]]
        wide = first < len(raw) - 1
        capital[wide] |= two[first[wide]]
        opens = np.ones(len(starts), dtype=bool)
        lines = np.concatenate(([0], np.cumsum(raw == 10)))
        opens[1:] = self.ends[raw[ends[:-1] - 1]] | (lines[starts[1:]] > lines[ends[:-1]])
        return hashes, digits[last + 1] > digits[first], capital, opens

    def _edges(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per word with a letter or digit: start, end, its first and last letter or digit."""
        word = ~self.hasher.space[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        inner = np.flatnonzero(self.inner[raw])
        low, high = np.searchsorted(inner, starts), np.searchsorted(inner, ends)
        some = low < high
        starts, ends, low, high = starts[some], ends[some], low[some], high[some]
        return starts, ends, inner[low], inner[high - 1]

    def _hashes(self, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        if len(raw) > len(self.hasher.up):
            self.hasher._grow(2 * len(raw))
        sums = np.concatenate(
            (np.zeros(1, _U), np.cumsum(self.hasher.value[raw] * self.hasher.up[: len(raw)]))
        )
        return mix((sums[last + 1] - sums[first]) * self.hasher.down[first])

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template hash, is a placeholder, value hash) of each token."""
        data = text.encode("utf-8", "replace")
        parts, at, space = [], 0, self.hasher.space
        while at < len(data):
            end = min(at + BLOCK, len(data))
            while end < len(data) and not space[data[end]]:
                end += 1
            parts.append(self._words(data[at:end]))
            at = end
        if not parts:
            return np.empty(0, _U), np.empty(0, bool), np.empty(0, _U)
        values, number, capital, opens = (np.concatenate(x) for x in zip(*parts, strict=True))
        after = np.zeros(len(values), dtype=bool)
        after[1:] = number[:-1]
        unit = after & ~number
        unit[unit] = self._is_unit(values[unit])
        name = capital & ~opens & ~number & ~unit
        template = values.copy()
        template[number], template[name], template[unit] = self.NUMBER, self.NAME, self.UNIT
        return template, number | name | unit, values

    def _is_unit(self, values: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.units, values), len(self.units) - 1)
        return self.units[place] == values

    def windows(self, template: np.ndarray, slot: np.ndarray, literals: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the windows with so many literals."""
        width = self.settings.width
        out = self.plain(template)
        if not len(out):
            return np.empty(0, np.int64), out
        slots = np.concatenate(([0], np.cumsum(slot)))
        places = np.flatnonzero(width - (slots[width:] - slots[:-width]) >= literals)
        return places, out[places]

    def literals(self, template: np.ndarray) -> int:
        """The literals that a window of this text needs."""
        names = np.count_nonzero(template == _U(self.NAME))
        many = names > self.settings.many_capitals * len(template)
        return self.settings.min_literals_capitals if many else self.settings.min_literals

    def plain(self, values: np.ndarray) -> np.ndarray:
        """The hash of each window."""
        width = self.settings.width
        n = len(values) - width + 1
        if n <= 0:
            return np.empty(0, _U)
        out = values[:n].copy()
        for k in range(1, width):
            out = mix(out * _U(3) + values[k : k + n])
        return out


_PLAIN, _TEMPLATE = 0, 1
_WINDOW = "kind int, hash bigint, place bigint, `values` array<bigint>, slots array<boolean>, size bigint"


def _batch(key: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    """Windows (row of `key`, kind, hash, place, values, slots, size) as a batch."""
    of, kind, hashed, place, values, slots, size = (
        np.concatenate(part) if part else np.empty(0) for part in zip(*rows, strict=True)
    )

    def lists(flat: np.ndarray) -> pa.Array:
        width = flat.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * width, pa.int32()), pa.array(flat.ravel()))

    return pa.RecordBatch.from_arrays(
        [
            key.take(pa.array(of)),
            pa.array(kind.astype(np.int32)),
            pa.array(hashed.view(np.int64)),
            pa.array(place),
            lists(values.view(np.int64)),
            lists(slots),
            pa.array(size),
        ],
        ["key", "kind", "hash", "place", "values", "slots", "size"],
    )


def _windows(rows: DataFrame, settings: Decontamination, passing: Broadcast | None) -> DataFrame:
    """(key, kind, hash, place, values, slots, size): windows of the rows of (key, text).

    Of items (`passing` is None) all windows, with the number of distinct ones as
    `size`; of documents those that may be an item's.
    """
    kind_of_key = rows.schema["key"].dataType.simpleString()
    width = settings.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(settings)
        bits = None if passing is None else np.frombuffer(passing.value, dtype=np.uint8)

        def may_be(hashed: np.ndarray) -> np.ndarray:
            if bits is None:
                return np.ones(len(hashed), dtype=bool)
            place = hashed & _U(8 * len(bits) - 1)
            return (bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 > 0

        for batch in slices(batches):
            out, key, size = [], batch.column("key"), 0
            for row, text in enumerate(batch.column("text").to_pylist()):
                template, slot, value = templates.tokens(text or "")
                if len(value) < width:
                    continue
                least = templates.literals(template) if bits is None else settings.min_literals_capitals
                plain = templates.plain(value)
                for kind, place, hashed in (
                    (_PLAIN, np.arange(len(plain)), plain),
                    (_TEMPLATE, *templates.windows(template, slot, least)),
                ):
                    maybe = may_be(hashed)
                    place, hashed = place[maybe], hashed[maybe]
                    if not len(hashed):
                        continue
                    each = place[:, None] + np.arange(width)
                    n = len(np.unique(hashed)) if bits is None else 0
                    out.append(
                        (
                            np.full(len(place), row), np.full(len(place), kind), hashed, place,
                            value[each], slot[each], np.full(len(place), n),
                        )
                    )
                    size += len(place)
                if size > 50_000:
                    yield _batch(key, out)
                    out, size = [], 0
            if out:
                yield _batch(key, out)

    return rows.select("key", "text").mapInArrow(run, f"key {kind_of_key}, {_WINDOW}")


def _found(matches: DataFrame, least: float) -> DataFrame:
    """(text, item, coverage, verbatim) of the leaks, from equal windows of texts and items."""
    pair = ("text", "item")
    held = matches.groupBy(*pair, "kind").agg(
        F.count_distinct("hash").alias("held"), F.first("size").alias("size")
    )
    enough = held.withColumn("coverage", F.col("held") / F.col("size")).where(F.col("coverage") >= least)
    plain = enough.where(F.col("kind") == _PLAIN).select(*pair, "coverage", F.lit(True).alias("verbatim"))
    # Readings: windows on one diagonal, with the values that stand for each other in their slots.
    readings = matches.where(F.col("kind") == _TEMPLATE).join(
        enough.where(F.col("kind") == _TEMPLATE).select(*pair), list(pair), "semi"
    )
    slots = F.filter(F.arrays_zip("item_values", "text_values", "slots"), lambda s: s["slots"])
    readings = readings.groupBy(*pair, (F.col("here") - F.col("there")).alias("diagonal")).agg(
        F.collect_set("hash").alias("hashes"),
        F.array_distinct(F.flatten(F.collect_list(slots))).alias("slots"),
        F.first("size").alias("size"),
    )
    consistent = F.size("slots") == F.size(F.array_distinct(F.col("slots.item_values")))
    exact = F.forall("slots", lambda s: s["item_values"] == s["text_values"])

    def share(which: Column) -> Column:
        some = F.array_distinct(F.flatten(F.collect_list(F.when(which, F.col("hashes")))))
        return F.size(some) / F.first("size")

    by_template = readings.groupBy(*pair).agg(
        share(consistent).alias("coverage"), (share(consistent & exact) >= least).alias("verbatim")
    )
    both = plain.union(by_template.where(F.col("coverage") >= least))
    return both.groupBy(*pair).agg(F.max("coverage").alias("coverage"), F.max("verbatim").alias("verbatim"))


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    settings: Decontamination = Decontamination(),
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Each row with `leaks`, the items in its text: array<struct<item_id, coverage, verbatim>>."""

    def digest(column: str) -> Column:
        return F.struct(F.xxhash64(F.lit(1), column).alias("one"), F.xxhash64(F.lit(2), column).alias("two"))

    asked = benchmark.select(F.col(item).alias("id"), F.col(item_text).alias("text")).distinct()
    # Items by their id and text: one id may have several texts.
    asked = asked.select(F.struct("id", digest("text").alias("own")).alias("key"), "text")
    items = staged(_windows(asked, settings, None), "item-windows")
    place = F.col("hash").bitwiseAND(F.lit(settings.filter_bits - 1))
    passing = bitmap(items.select(place.alias("place")), settings.filter_bits)

    rows = documents.select(digest(text).alias("key"), F.col(text).alias("text"))
    windows = _windows(rows, settings, passing).drop("slots", "size")
    # Copies of a text give equal windows: one of each is joined.
    windows = windows.select(
        F.col("key").alias("text"), "kind", "hash", F.col("place").alias("here"), F.col("values").alias("text_values")
    ).distinct()
    matches = windows.join(
        items.select(
            F.col("key").alias("item"), "kind", "hash", F.col("place").alias("there"),
            F.col("values").alias("item_values"), "slots", "size",
        ),
        ["kind", "hash"],
    )
    found = _found(staged(matches, "matches"), settings.min_coverage)
    leak = F.struct(F.col("item.id").alias("item_id"), "coverage", "verbatim")
    found = found.groupBy("text").agg(F.sort_array(F.collect_list(leak)).alias("leaks"))
    one, two, leaks = (fresh(documents, name) for name in ("_one", "_two", "_leaks"))
    found = staged(found.select(F.col("text.one").alias(one), F.col("text.two").alias(two), F.col("leaks").alias(leaks)), "leaks")
    keyed = documents.withColumns({one: F.xxhash64(F.lit(1), text), two: F.xxhash64(F.lit(2), text)})
    joined = keyed.join(found, [one, two], "left")
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() != "leaks"]
    empty = F.array().cast(found.schema[leaks].dataType)
    return joined.select(*kept, F.coalesce(F.col(leaks), empty).alias("leaks"))
