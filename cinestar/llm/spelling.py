"""Spelling variants of the corpus' words: near words by variable-length grams.

Words are the letter runs of the texts, in lower case, from a least length and
number of occurrences on. Two words are near if one edit (a code point inserted,
deleted or replaced) makes one the other. A word's form is its most frequent
near word, if that is `lead` times as frequent; its root is the end of the chain
of forms.

1. Dictionary. Grams of `shortest` code points and more are counted over the
   words, `^` before and `$` after them. A gram that occurs more than `frequent`
   times is too common to tell words apart and is extended.
2. Decomposition. From each place of a word the gram grows until it is not in
   the dictionary any more, or has `longest` code points, or the word ends. So a
   gram depends on the code points it covers only.
3. Affected grams. An edit changes the grams that cover its place. The largest
   number of grams over any place is the word's bound: of more grams than that,
   one is the same in any near word, at the same distance from the start or from
   the end. `longest` is at most the least length of a word, so every word has
   a gram more than its bound.
4. Lists. Each gram's list holds the words that have it at a place, by the
   words' lengths. A word asks for one gram more than its bound, those with the
   shortest lists, among words of its own length and of one code point less.
   Lists that may be long are split by words, and those who ask go to each part.
5. Verification. A word and a member of a list it asked for are compared if the
   letters they hold an odd number of times differ in two at most; the pair is
   near if the whole words are.

The dictionary and the table of list lengths (by hash) are bounded and go to
every task; words, lists and pairs stay distributed. Frequent grams are bounded
by `frequent`, which grows with the words.

Defined results: null and empty texts have no words; a null id counts as an
empty one in the hash; rows of one id and repeated rows count each; ties of
frequency go to the smallest word in code-point order; an empty table gives no
words. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinestar.llm.frames import slices, staged
from cinestar.llm.hashing import mix

RUN, LETTER = re.compile("[A-Za-zÀ-ÿ]+"), re.compile("[A-Za-zÀ-ÿ]")
_U = np.uint64
_COUNTED = 1 << 20  # list lengths are kept by so many values of a hash
_PIECE = 1 << 22  # code points of a text worked on at once
_WIDE = 40  # longer words are compared one by one


@dataclass(frozen=True)
class Spelling:
    """Least code points and occurrences of a word; how much more frequent a form is.

    `mistakes`: one run in so many loses a code point, by a hash; 0 for none.
    `frequent` occurrences put a gram into the dictionary; it grows to a
    `words_per_gram`-th of all words. A list has `list_words` words at most in a task.
    """

    length: int = 5
    occurrences: int = 3
    lead: int = 2
    mistakes: int = 97
    shortest: int = 2
    longest: int = 5
    frequent: int = 64
    words_per_gram: int = 20_000
    list_words: int = 20_000
    task_rows: int = 400_000


def _pieces(text: str) -> Iterator[str]:
    """The text, or parts of a long one that end between runs."""
    at = 0
    while len(text) - at > _PIECE:
        end = at + _PIECE
        while end < len(text) and LETTER.match(text[end - 1]) and LETTER.match(text[end]):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "replace").lower().decode()


def altered(doc_id: int | None, run: str, mistakes: int) -> str:
    """The run as this document spells it: some runs lose a code point, by a hash of both."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if mistakes and h % mistakes == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def word_counts(documents: DataFrame, settings: Spelling) -> DataFrame:
    """(word, n) of the rows of (doc_id, text)."""
    least, mistakes = settings.length, settings.mistakes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            words, counts = list(total), list(total.values())
            for k in range(0, len(words), 50_000):
                some = slice(k, k + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[some], pa.string()), pa.array(counts[some], pa.int64())], ["word", "n"]
                )

        for batch in slices(batches, 200):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                prefix = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in _pieces(ascii_lower(text or "")):
                    for word, n in Counter(RUN.findall(piece)).items():
                        if len(word) < least:
                            continue
                        h = crc32(word.encode(), prefix)
                        if mistakes and h % mistakes == 0:
                            word = altered(doc_id, word, mistakes)
                            if len(word) < least:
                                continue
                        total[word] = total.get(word, 0) + n
                if len(total) > 500_000:
                    yield from out()
                    total.clear()
        yield from out()

    emitted = documents.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    counts = emitted.groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= settings.occurrences)


def _counted(words: DataFrame, count, schema: str, key: str) -> DataFrame:
    """Sums of what `count` (words of a batch -> keys and numbers) gives, combined in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 20_000):
            keys, numbers = count(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(numbers, pa.int64())], [key, "n"])

    return words.select("word").mapInArrow(run, schema).groupBy(key).agg(F.sum("n").alias("n"))


def dictionary(words: DataFrame, n_words: int, settings: Spelling) -> frozenset[str]:
    """The frequent grams. Their number is bounded: `frequent` grows with the words."""
    shortest, longest = settings.shortest, settings.longest
    limit = max(settings.frequent, n_words // settings.words_per_gram)

    def count(some: list[str]) -> tuple[list[str], list[int]]:
        grams: Counter[str] = Counter()
        for word in some:
            padded = f"^{word}$"
            for size in range(shortest, longest):
                grams.update(padded[k : k + size] for k in range(len(padded) - size + 1))
        return list(grams), list(grams.values())

    counts = _counted(words, count, "gram string, n bigint", "gram").where(F.col("n") > limit)
    return frozenset(row["gram"] for row in counts.select("gram").toLocalIterator())


def decompose(padded: str, frequent: frozenset[str], shortest: int, longest: int) -> list[tuple[int, int]]:
    """(start, end) of the gram at each place of `^word$`."""
    size, grams = len(padded), []
    for start in range(size - shortest + 1):
        end = start + shortest
        while end < size and end - start < longest and padded[start:end] in frequent:
            end += 1
        grams.append((start, end))
    return grams


def affected_bound(grams: list[tuple[int, int]], size: int) -> int:
    """The largest number of grams that one edit of the word inside `^word$` can change."""
    cover = [0] * (size + 1)
    for start, end in grams:
        cover[start] += 1
        cover[end] -= 1
    most = here = 0
    for place in range(1, size - 1):
        here = here + cover[place] if place > 1 else cover[0] + cover[1]
        most = max(most, here)
    # A code point inserted just before the `$` changes the grams that hold both its neighbours.
    return max(most, sum(1 for start, end in grams if start < size - 1 and end == size))


def _token(gram: str, place: int, length: int) -> int:
    """A list: a gram's hash, its place, and the length of the words that have it."""
    return crc32(gram.encode()) << 24 ^ place << 12 ^ length


def _length_of_list(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) & _U(_COUNTED - 1)).astype(np.int64)


def list_lengths(words: DataFrame, frequent: Broadcast, settings: Spelling) -> np.ndarray:
    """Words in the lists, by a hash of the list; never too few."""

    def count(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokens = []
        for word in some:
            padded = f"^{word}$"
            for start, end in decompose(padded, frequent.value, settings.shortest, settings.longest):
                tokens.append(_token(padded[start:end], start, len(word)))
        return np.unique(_length_of_list(np.array(tokens, dtype=_U)), return_counts=True)

    counts = _counted(words, count, "list bigint, n bigint", "list").toPandas()
    lengths = np.zeros(_COUNTED, dtype=np.int64)
    lengths[counts["list"].to_numpy()] = counts["n"].to_numpy()
    return lengths


def lists(words: DataFrame, frequent: Broadcast, lengths: Broadcast, settings: Spelling) -> DataFrame:
    """(token, part, asks, word, n): members of the lists, and those who ask for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shortest, longest, most = settings.shortest, settings.longest, settings.list_words
        dictionary_, known = frequent.value, lengths.value
        for batch in slices(batches, 5_000):
            words = batch.column("word").to_pylist()
            members, member_of, asked, asked_by = [], [], [], []
            for k, word in enumerate(words):
                padded, size = f"^{word}$", len(word)
                grams = decompose(padded, dictionary_, shortest, longest)
                own = [_token(padded[start:end], start, size) for start, end in grams]
                members += own
                member_of += [k] * len(own)
                needed = affected_bound(grams, size + 2) + 1
                length = known[_length_of_list(np.array(own, dtype=_U))]
                for g in np.argsort(length, kind="stable")[:needed]:
                    start, end = grams[g]
                    gram = padded[start:end]
                    # In a word of one code point less it keeps its place before the edit, and moves after it.
                    asked += [own[g], _token(gram, start, size - 1)]
                    if start:
                        asked.append(_token(gram, start - 1, size - 1))
                    asked_by += [k] * (3 if start else 2)
            members, asked = np.array(members, dtype=_U), np.array(asked, dtype=_U)
            member_of, asked_by = np.array(member_of, dtype=np.int64), np.array(asked_by, dtype=np.int64)
            hashes = np.array([crc32(w.encode()) for w in words], dtype=np.int64)
            # A part of a list for each so many words; who asks is sent to all of them.
            parts = -(-known[_length_of_list(members)] // most)
            part = hashes[member_of] % np.maximum(parts, 1)
            ask_parts = -(-known[_length_of_list(asked)] // most)
            ends = np.cumsum(ask_parts)
            ask_part = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - ask_parts, ask_parts)
            asked, asked_by = np.repeat(asked, ask_parts), np.repeat(asked_by, ask_parts)
            rows = np.concatenate((member_of, asked_by))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((members, asked)).view(np.int64)),
                    pa.array(np.concatenate((part, ask_part))),
                    pa.array(np.repeat([False, True], [len(members), len(asked)])),
                    batch.column("word").take(pa.array(rows)),
                    batch.column("n").take(pa.array(rows)),
                ],
                ["token", "part", "asks", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(
        run, "token bigint, part bigint, asks boolean, word string, n bigint"
    )


def one_edit(one: str, two: str) -> bool:
    """Do the words differ by exactly one code point inserted, deleted or replaced?"""
    if len(one) < len(two):
        one, two = two, one
    if len(one) - len(two) > 1 or one == two:
        return False
    k = next((k for k, (a, b) in enumerate(zip(one, two, strict=False)) if a != b), len(two))
    return one[k + 1 :] == two[k + (len(one) == len(two)) :]


def _odd_letters(letters: np.ndarray) -> np.ndarray:
    """A bit for each letter (of 64 classes) that a row of codes, 0 at its end, holds an odd number of times."""
    bits = np.where(letters > 0, np.left_shift(_U(1), (letters & 63).astype(_U)), _U(0))
    return np.bitwise_xor.reduce(bits, axis=1)


def _near(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray) -> np.ndarray:
    """Are rows of codes, of n_one and n_two letters and 0 after them, one edit apart? n_one >= n_two."""
    same = one == two
    place = np.argmin(np.hstack((same, np.zeros((len(one), 1), dtype=bool))), axis=1)
    after = np.arange(one.shape[1])[None, :] > place[:, None]
    replaced = (n_one == n_two) & (same | ~after).all(axis=1) & (place < n_one)
    moved = np.hstack((one[:, 1:], np.zeros((len(one), 1), dtype=one.dtype))) == two
    at_or_after = np.arange(one.shape[1])[None, :] >= place[:, None]
    return replaced | ((n_one == n_two + 1) & (moved | ~at_or_after).all(axis=1))


def near_pairs(dealt: DataFrame, settings: Spelling) -> DataFrame:
    """(a, n_a, b, n_b) of near words in a list, from lists dealt out by token and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        token, part, asks = (rows.column(c).to_numpy() for c in ("token", "part", "asks"))
        order = np.lexsort((asks, part, token))
        token, part, asks = token[order], part[order], asks[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        members = np.add.reduceat((~asks).astype(np.int64), first)
        # Each row that asks, against all members of its list.
        asking = np.flatnonzero(asks)
        against = members[group[asking]]
        asking, against = asking[against > 0], against[against > 0]
        if not len(asking):
            return
        used = np.zeros(len(token), dtype=bool)
        used[asking] = True
        lists_ = np.unique(group[asking])
        used |= ~asks & np.isin(group, lists_)
        words = [b""] * len(token)
        text, n = rows.column("word"), rows.column("n").to_numpy()[order]
        places = np.flatnonzero(used)
        # Code points up to U+00FF: one byte each.
        for place, word in zip(places.tolist(), text.take(pa.array(order[places])).to_pylist(), strict=True):
            words[place] = word.encode("latin-1")
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = min(int(sizes.max()), _WIDE + 1)
        codes = np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)
        odd = np.zeros(len(words), dtype=_U)
        for k in range(0, len(words), 100_000):
            odd[k : k + 100_000] = _odd_letters(codes[k : k + 100_000])
        ends = np.cumsum(against)
        at = 0
        while at < len(asking):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + 1_000_000, side="right")))
            some, size = asking[at:stop], against[at:stop]
            at = stop
            one = np.repeat(some, size)
            inside = np.arange(len(one)) - np.repeat(np.cumsum(size) - size, size)
            two = np.repeat(first[group[some]], size) + inside
            wide = sizes[one] > _WIDE
            alike = (np.bitwise_count(odd[one] ^ odd[two]) <= 2) | wide
            one, two, wide = one[alike], two[alike], wide[alike]
            near = _near(codes[one], codes[two], sizes[one], sizes[two])
            for k in np.flatnonzero(wide):
                near[k] = one_edit(words[one[k]].decode("latin-1"), words[two[k]].decode("latin-1"))
            one, two = one[near], two[near]
            # Words of one length ask for each other.
            once = (sizes[one] > sizes[two]) | np.fromiter(
                (words[a] < words[b] for a, b in zip(one.tolist(), two.tolist(), strict=True)), bool, count=len(one)
            )
            one, two = one[once], two[once]
            if len(one):
                yield pa.RecordBatch.from_arrays(
                    [
                        text.take(pa.array(order[one])).combine_chunks(),
                        pa.array(n[one]),
                        text.take(pa.array(order[two])).combine_chunks(),
                        pa.array(n[two]),
                    ],
                    ["a", "n_a", "b", "n_b"],
                )

    return dealt.mapInArrow(run, "a string, n_a bigint, b string, n_b bigint").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each chain, in a number of joins like the log of its length."""
    led = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        led = staged(
            led.join(further, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if led.where("moved").isEmpty():
            return led.select("word", "root")
        led = led.select("word", "root")


def spelling_groups(
    documents: DataFrame, settings: Spelling = Spelling(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each word: (word, form, root, n, n_near, form_n)."""
    if settings.longest > settings.length:
        raise ValueError("grams may not be longer than the shortest word: else an edit may change all of a word's")
    if settings.lead <= 1:
        raise ValueError("a form must be more frequent than its word: else chains of forms may have no end")
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    words = staged(word_counts(rows, settings), "words")
    n_words = words.count()
    frequent = context.broadcast(dictionary(words, n_words, settings))
    lengths = list_lengths(words, frequent, settings)
    # Each member once, and each of about half a word's grams asks for three lists.
    n_rows = 4 * int(lengths.sum())
    parts = max(1, -(-n_rows // settings.task_rows))
    # A small table has few partitions; decomposing it is work for as many tasks as its lists.
    spread = words.repartition(min(parts, 2000))
    dealt = lists(spread, frequent, context.broadcast(lengths), settings).repartition(parts, "token", "part")
    pairs = staged(near_pairs(dealt, settings), "near")
    both = pairs.select("a", "b", F.col("n_b").alias("n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a").alias("n"))
    )
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "b")).alias("best")
    )
    led = (-F.col("best.n")) >= settings.lead * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(led, F.col("best.b")).alias("form"),
        F.when(led, -F.col("best.n")).alias("form_n"),
    )
    known = staged(known, "forms")
    ends = roots(known.where(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
