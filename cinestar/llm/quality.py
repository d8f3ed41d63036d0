"""Quality rules: repetition counts and divergence from a reference per language.

A document is compared with the reference of its language in two histograms, of
character classes and of common words, by the Jensen-Shannon distance (square
root of the divergence to base 2, 0 to 1). The common words of a language are its
most frequent short ones, counted over all its documents; the references are
sums over those documents of it that are long enough. Everything is DataFrame
expressions: a pass for the words and one for the sums give one row per language
each, and every document is judged where it lies. Words are counted within tasks
before they are shuffled, so a language with most of the rows costs a row per
word and task; no text is shuffled.

Defined results: a null text counts as empty and fails (no words); a null or
unknown language, or one without a long enough document, has no reference, and
only the base rules count then. Repeated rows are judged one by one. An empty
table gives no rows. Columns of the input with the name of a result column are
replaced, all others are kept. Windows of three words are compared by a 64-bit
hash within their document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinestar.llm.frames import SPACES, fresh, staged, words_of

# Character classes counted in a text: capitals, digits, symbols, other
# punctuation. The rest (lower case, letters beyond ASCII, white space) is one more.
SYMBOLS = r"[#*$%&|<>]"
CLASSES = (r"[A-Z]", r"[0-9]", SYMBOLS, r"[.,;:!?\"'()+\-/=@\[\]^_`{}~\\]")


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules.

    The `common_words` most frequent words of up to `common_letters` code points
    count for a language. A distance is judged only from `min_words` (characters) and
    `min_common_words` (common words) words on. From the divergence of the
    common words the part that chance gives a text of n words is taken off:
    (bins - 1) / (8 n ln 2).
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_class_distance: float = 0.25
    min_common_words: int = 100
    max_common_distance: float = 0.2
    common_words: int = 20
    common_letters: int = 4


def _length_of(text: Column, pattern: str) -> Column:
    """Code points of a text that match a character class given as `[...]`."""
    return F.length(F.regexp_replace(text, f"[^{pattern[1:-1]}]+", ""))


def class_histogram(text: Column) -> Column:
    counted = [_length_of(text, pattern).cast("long") for pattern in CLASSES]
    rest = F.length(text).cast("long")
    for count in counted:
        rest = rest - count
    return F.array(*counted, rest)


def common_words(documents: DataFrame, rules: QualityRules, text: str, lang: str) -> DataFrame:
    """(lang, common): each language's most frequent short words, the most frequent first.

    Ties go to the smaller word. A language of fewer words is filled up with a
    blank, which no word is.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # Words of so many code points, with nothing but white space or an end on either side.
    short = rf"(?<![^{SPACES}])[^{SPACES}]{{1,{rules.common_letters}}}(?![^{SPACES}])"
    found = F.regexp_extract_all(body, F.lit(short), F.lit(0))
    # The outer form: for the plain one Spark finds the words in a filter of its own first.
    rows = documents.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.explode_outer(found).alias("word")
    )
    counts = rows.where("word IS NOT NULL").groupBy("lang", "word").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rules.common_words)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("top"))
    places = F.sequence(F.lit(0), F.lit(rules.common_words - 1))
    filled = F.transform(places, lambda i: F.coalesce(F.get(F.col("top.word"), i), F.lit(" ")))
    return listed.select("lang", filled.alias("common"))


def common_histogram(words: Column, common: Column) -> Column:
    """Occurrences of each common word, and of all other words."""

    # One space on either side of each word, so that equal neighbours count apart.
    joined = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))

    def of_joined(text: Column) -> Column:
        def times(word: Column) -> Column:
            left = F.replace(text, F.concat(F.lit(" "), word, F.lit(" ")), F.lit(""))
            # In bytes: their number is known, code points would be counted each time.
            return ((F.octet_length(text) - F.octet_length(left)) / (F.octet_length(word) + 2)).cast("long")

        return F.transform(common, times)

    def with_others(counts: Column) -> Column:
        found = F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)
        return F.concat(counts, F.array(F.size(words) - found))

    return _let(_let(joined, of_joined), with_others)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_hashes(words: Column) -> Column:
    """A hash of each window of three words, in order."""
    hashes = F.transform(
        words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def covered_by_repeats(hashes: Column) -> Column:
    """Words that lie in a window found at least twice: equal hashes meet in sorted order."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(entry: Column, k: Column, all_: Column) -> Column:
        earlier, later = F.get(all_, k - 1)["h"], F.get(all_, k + 1)["h"]
        return F.when(entry["h"].eqNullSafe(earlier) | entry["h"].eqNullSafe(later), entry["i"])

    def covered(starts: Column) -> Column:
        width = F.transform(
            starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(width, F.lit(0), lambda total, x: total + x)

    def of_sorted(entries: Column) -> Column:
        starts = F.sort_array(F.array_compact(F.transform(entries, lambda e, k: repeated(e, k, entries))))
        return _let(starts, covered)

    count = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(placed, of_sorted))
    return F.coalesce(count, F.lit(0)).cast("long")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: an array of it is transformed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measures(frame: DataFrame, text: str, common: str, stage: str) -> DataFrame:
    """Add one struct column `stage` with words and counts of each row; `common` holds its common words."""
    body = F.coalesce(F.col(text), F.lit(""))
    words, hashes = fresh(frame, "_words"), fresh(frame, "_hashes")
    frame = frame.withColumn(words, words_of(body)).withColumn(hashes, window_hashes(F.col(words)))
    joined = F.array_join(F.col(words), "")
    return frame.withColumn(
        stage,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            _length_of(body, SYMBOLS).cast("long").alias("n_symbols"),
            duplicate_lines(body).alias("n_dup_lines"),
            covered_by_repeats(F.col(hashes)).alias("n_repeat_words"),
            class_histogram(body).alias("classes"),
            common_histogram(F.col(words), F.col(common)).alias("common"),
        ),
    ).drop(words, hashes)


def references(measured: DataFrame, rules: QualityRules, lang: str, stage: str) -> DataFrame:
    """One row per language: summed histograms of its documents of enough words."""
    found = F.col(stage)

    def totals(name: str, size: int) -> Column:
        return F.array(*(F.sum(F.get(found[name], F.lit(i))) for i in range(size))).alias(name)

    rows = measured.where(F.col(lang).isNotNull() & (found.n_words >= rules.min_words))
    return rows.groupBy(F.col(lang).alias("lang")).agg(
        totals("classes", len(CLASSES) + 1), totals("common", rules.common_words + 1)
    )


def js_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance of two histograms; null if one of them is empty."""

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("long"), lambda t, x: t + x).cast("double")

    def shares(counts: Column, whole: Column) -> Column:
        return F.transform(counts, lambda x: x / whole)

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def distance(both: Column) -> Column:
        terms = F.zip_with(both["p"], both["q"], lambda p, q: (part(p, q) + part(q, p)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda t, x: t + x)))

    def of_totals(sums: Column) -> Column:
        both = F.struct(shares(left, sums["l"]).alias("p"), shares(right, sums["r"]).alias("q"))
        return F.when((sums["l"] > 0) & (sums["r"] > 0), _let(both, distance))

    return _let(F.struct(total(left).alias("l"), total(right).alias("r")), of_totals)


def judge(
    documents: DataFrame,
    rules: QualityRules = QualityRules(),
    text: str = "text",
    lang: str = "lang",
    keep_text: bool = True,
) -> DataFrame:
    """Each row with the counts of the rules, both distances, `base_failed` and `kept`.

    The rows are measured once and written to the shared folder with their
    counts; references and verdicts are taken from there. Select the columns
    that are needed: all columns are written, the text only if `keep_text`.
    """
    stage, of, common = (fresh(documents, name) for name in ("_measures", "_of", "_common"))
    top = staged(common_words(documents, rules, text, lang), "common-words")
    top = top.select(F.col("lang").alias(of), F.col("common").alias(common))
    measured = measures(documents.join(top, F.col(lang) == F.col(of), "left"), text, common, stage)
    measured = measured.drop(of, common)
    measured = staged(measured if keep_text else measured.drop(text), "quality")
    key, side = fresh(measured, "_reference_lang"), fresh(measured, "_reference")
    reference = staged(references(measured, rules, lang, stage), "quality-references").select(
        F.col("lang").alias(key), F.struct("classes", "common").alias(side)
    )
    rows = measured.join(reference, F.col(lang) == F.col(key), "left")
    found = F.col(stage)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (found.n_words < rules.min_words) | (
        100 * found.n_repeat_words > rules.max_repeat_percent * found.n_words
    )
    by_class = F.when(
        found.n_words >= rules.min_words, js_distance(found.classes, F.col(side).classes)
    )
    far = js_distance(found.common, F.col(side).common)
    chance = rules.common_words / (8 * math.log(2)) / found.n_words
    by_common = F.when(
        found.n_words >= rules.min_common_words,
        F.sqrt(F.greatest(far * far - chance, F.lit(0.0))),
    )
    rows = rows.withColumns(
        {
            **{name: found[name] for name in names},
            "class_distance": by_class,
            "common_distance": by_common,
            "base_failed": failed,
        }
    )
    diverges = F.coalesce(F.col("class_distance") > rules.max_class_distance, F.lit(False)) | (
        F.coalesce(F.col("common_distance") > rules.max_common_distance, F.lit(False))
    )
    return rows.withColumn("kept", ~F.col("base_failed") & ~diverges).drop(stage, key, side)
