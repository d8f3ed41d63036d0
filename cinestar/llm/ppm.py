"""Language-model scores: prediction by partial matching over bytes, and add-one words.

The model is a trie of byte contexts up to `order` bytes, learned from the
training documents, kept as one table per depth. A byte that a context has seen
c times out of n, with d different bytes, has the share (2c - 1) / 2n; the
escape to the next shorter context has d / 2n (method D). After an escape the
bytes that the longer context has seen are excluded from the shorter one:
counts and kinds of those bytes are taken off. Below the empty context all
bytes not seen at all share the rest alike. A document is the byte string of
its text, A-Z in lower case, after `order` start bytes and with one end byte;
its score is the log10 of the product, its code length in decimal digits.

As work for Spark: training tasks count the words and the byte strings of
order + 1 bytes that they see and emit each once with its count; the sums are
tables that grow with the corpus and are never sent to a driver or broadcast.
Shorter contexts follow by dropping the first byte. Shares are computed depth
by depth, by joins, for every byte string that occurs in any document.

Scoring deals the documents into blocks by a hash of their id and text, so rows
without an id, or of one id, spread over blocks. A block asks for each of its
distinct words and byte strings once; the answers are joined on the key and come
back to the block, which looks them up in sorted order, many texts at once, and
sums by text. A key that all blocks ask for costs one row per block. One shuffle
of the texts serves asking and scoring. Tables of a depth are removed as soon as
the next depth is written.

Defined results: a null text counts as empty and scores its end alone; a null
id is hashed as an empty text and counts as training; repeated rows are scored
each and learned from each; with no training document every byte has the same
share and no word is known; an empty table gives no rows. Words are compared by
64-bit hashes. Ids are whole numbers or texts of such; another text ends the job.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinestar.llm.frames import discard, slices, staged
from cinestar.llm.hashing import WordHasher

_U = np.uint64
_START, _END = 0xFF, 0xFE  # bytes that UTF-8 never uses
_SYMBOLS = 256
_WORD, _GRAM, _SIZE = 0, 1, 2
_END_WORD = np.array([0x454E44], dtype=_U)  # the end token among the word hashes


@dataclass(frozen=True)
class Ppm:
    """Bytes of context; text bytes a block of documents should hold; keys counted at once."""

    order: int = 5
    block_bytes: int = 20_000_000
    counted_keys: int = 8_000_000


class _Reader:
    """Keys of texts: word hashes with the end, and byte strings as integers."""

    def __init__(self, order: int) -> None:
        self.order, self.hasher = order, WordHasher(lower=True)
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def words(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.concatenate((w, _END_WORD)).view(np.int64) for w in self.hasher.texts(texts)]

    def grams(self, text: str | None) -> np.ndarray:
        """The byte string that ends at each byte of the text and at its end."""
        data = (text or "").encode("utf-8", "replace")
        raw = np.full(len(data) + self.order + 1, _START, dtype=np.uint8)
        raw[self.order : -1] = self.lower[np.frombuffer(data, dtype=np.uint8)]
        raw[-1] = _END
        n = len(data) + 1
        out = np.zeros(n, dtype=np.int64)
        for k in range(self.order + 1):
            out <<= 8
            out |= raw[k : k + n]
        return out


def is_held_out(key: Column, modulus: int = 7, held: int = 2) -> Column:
    """crc32 of the id as text, modulo 7, is 2."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % modulus == held


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by key."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _key_batches(kind: int, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(keys), 100_000):
        some = slice(k, k + 100_000)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(keys[some]), kind, dtype=np.int32)),
                pa.array(keys[some]),
                pa.array(values[some]),
            ],
            ["kind", "key", "n"],
        )


def _grouped(arrays, size: int) -> Iterator[np.ndarray]:
    """The arrays joined to arrays of about `size`."""
    waiting, n = [], 0
    for keys in arrays:
        waiting.append(keys)
        n += len(keys)
        if n >= size:
            yield np.concatenate(waiting)
            waiting, n = [], 0
    if waiting:
        yield np.concatenate(waiting)


def corpus_counts(rows: DataFrame, settings: Ppm) -> DataFrame:
    """(kind, key, n): counts in the training rows of (text, held_out), and the size of all rows.

    Byte strings that only other rows hold are there with a count of 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, size = _Reader(settings.order), 0
        counts: dict[int, list] = {_WORD: [], _GRAM: []}

        def counter(kind: int, arrays, weight: int) -> Iterator[pa.RecordBatch]:
            """Add keys to the counts, and emit these when they get many."""
            for keys in _grouped(arrays, settings.counted_keys // 4):
                found, n = np.unique(keys, return_counts=True)
                counts[kind].append((found, n * weight))
            if sum(len(k) for k, _ in counts[kind]) > settings.counted_keys // 4:
                counts[kind] = [_merged(counts[kind])]
                if len(counts[kind][0][0]) > settings.counted_keys // 8:
                    yield from _key_batches(kind, *counts[kind][0])
                    counts[kind] = []

        for batch in slices(batches, 2000):
            texts = batch.column("text").to_pylist()
            held = batch.column("held_out").to_pylist()
            size += sum(len(t) for t in texts if t)
            training = [t for t, h in zip(texts, held, strict=True) if not h]
            others = [t for t, h in zip(texts, held, strict=True) if h]
            yield from counter(_WORD, reader.words(training), 1)
            yield from counter(_GRAM, map(reader.grams, training), 1)
            yield from counter(_GRAM, map(reader.grams, others), 0)
        for kind in (_WORD, _GRAM):
            if counts[kind]:
                yield from _key_batches(kind, *_merged(counts[kind]))
        yield from _key_batches(_SIZE, np.zeros(1, np.int64), np.array([size]))

    emitted = rows.select("text", "held_out").mapInArrow(run, "kind int, key bigint, n bigint")
    return emitted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def byte_shares(counts: DataFrame, order: int) -> DataFrame:
    """(key, share): log10 share of the last byte after the others.

    `counts` holds (key, n) of byte strings of order + 1 bytes; with a count of
    0 a string is only asked about.
    """

    def suffix(key: Column, size: int) -> Column:
        """The last `size` bytes."""
        return key.bitwiseAND(F.lit((1 << (8 * size)) - 1))

    by_size = {order + 1: counts.where("n > 0")}
    asked = {order + 1: counts.select("key")}
    for size in range(order, 0, -1):
        shorter = suffix(F.col("key"), size).alias("key")
        by_size[size] = staged(
            by_size[size + 1].groupBy(shorter).agg(F.sum("n").alias("n")), f"counts-{size}"
        )
        asked[size] = staged(asked[size + 1].select(shorter).distinct(), f"asked-{size}")

    context = F.shiftright("key", 8).alias("context")
    below = None
    for size in range(1, order + 2):
        seen = by_size[size]
        if below is None:
            total = seen.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            rows = asked[size].join(seen, "key", "left").join(F.broadcast(total))  # one row
            n, total_, kinds = F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0)), F.col("kinds")
            # Of the bytes never seen, each one's share of the escape.
            rest = -F.log10(F.greatest(_SYMBOLS - kinds, F.lit(1)))
            share = F.when(n > 0, F.log10((2.0 * n - 1) / (2 * total_))).otherwise(
                F.when(kinds > 0, F.log10(kinds / (2.0 * total_))).otherwise(0.0) + rest
            )
            below = rows.select(
                "key",
                n.alias("n"),
                total_.alias("total"),
                kinds.alias("kinds"),
                share.alias("share"),
                rest.alias("rest"),
            )
            below = staged(below, "shares")
            if order:
                discard(asked[size])
            continue
        # What a context has seen, and how often the shorter context has seen the same bytes.
        counted = by_size[size - 1].select(F.col("key").alias("short"), F.col("n").alias("short_n"))
        contexts = (
            seen.select("key", "n", context, suffix(F.col("key"), size - 1).alias("short"))
            .join(counted, "short")
            .groupBy("context")
            .agg(
                F.sum("n").alias("total"),
                F.count("*").alias("kinds"),
                F.sum("short_n").alias("excluded"),
            )
        )
        shorter = below.select(
            F.col("key").alias("short"),
            F.col("n").alias("short_n"),
            F.col("total").alias("short_total"),
            F.col("kinds").alias("short_kinds"),
            F.col("rest").alias("short_rest"),
        )
        rows = (
            asked[size]
            .select("key", context, suffix(F.col("key"), size - 1).alias("short"))
            .join(seen, "key", "left")
            .join(contexts, "context", "left")
            .join(shorter, "short")
            .na.fill(0, ["n", "total", "kinds", "excluded"])
        )
        left_kinds = F.col("short_kinds") - F.col("kinds")
        left = 2.0 * (F.col("short_total") - F.col("excluded"))
        # The share after an escape from this context: in the shorter one, without what was seen here.
        via = (
            F.when(F.col("short_n") > 0, F.log10((2.0 * F.col("short_n") - 1) / left))
            .when(left_kinds > 0, F.log10(left_kinds / left) + F.col("short_rest"))
            .otherwise(F.col("short_rest"))
        )
        whole = 2.0 * F.col("total")
        share = (
            F.when(F.col("n") > 0, F.log10((2.0 * F.col("n") - 1) / whole))
            .when(F.col("total") > 0, F.log10(F.col("kinds") / whole) + F.col("rest"))
            .otherwise(F.col("rest"))
        )
        # `via` is evaluated only where the byte is not seen here: else `left` may be 0.
        rows = rows.withColumn("rest", F.when(F.col("n") == 0, via)).withColumn("share", share)
        done = [below, by_size[size - 1]] + ([asked[size]] if size <= order else [])
        below = staged(rows.select("key", "n", "total", "kinds", "share", "rest"), "shares")
        discard(*done)
    return below.select("key", "share")


def _sorted_distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate((np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1]))]


class _Distinct:
    """Distinct keys of many arrays; what waits to be merged is bounded."""

    def __init__(self, most: int = 1_500_000) -> None:
        self.waiting: list[np.ndarray] = [np.empty(0, np.int64)]
        self.size, self.most = 0, most

    def add(self, arrays: list[np.ndarray]) -> None:
        self.waiting.append(_sorted_distinct(np.concatenate(arrays)))
        self.size += len(self.waiting[-1])
        if self.size > self.most:
            self.keys()

    def keys(self) -> np.ndarray:
        merged = _sorted_distinct(np.concatenate(self.waiting))
        self.waiting, self.size = [merged], 0
        return merged


def _asked_keys(settings: Ppm):
    def run(rows: pa.Table) -> pa.Table:
        reader = _Reader(settings.order)
        block = rows.column("block")[0].as_py()
        found = {kind: _Distinct() for kind in (_WORD, _GRAM)}
        for batch in rows.to_batches(max_chunksize=500):
            texts = batch.column("text").to_pylist()
            found[_WORD].add(reader.words(texts))
            found[_GRAM].add(list(map(reader.grams, texts)))
        found = {kind: some.keys() for kind, some in found.items()}
        keys = np.concatenate((found[_WORD], found[_GRAM]))
        sizes = [len(found[_WORD]), len(found[_GRAM])]
        kinds = np.repeat(np.array([_WORD, _GRAM], dtype=np.int32), sizes)
        blocks = np.full(len(keys), block, dtype=np.int64)
        return pa.table({"block": blocks, "kind": kinds, "key": keys})

    return run


def _by_size(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """The texts in order, so many at a time that they have about `size` characters, or one longer text."""
    some, n = [], 0
    for text in texts:
        some.append(text)
        n += len(text or "")
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


def _sums(arrays: list[np.ndarray], keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each array, the sum of its keys' values; `keys` are sorted and hold all of them.

    Looked up in order, each distinct key once: neighbours in the table are
    neighbours in memory.
    """
    flat = np.concatenate(arrays)
    order = np.argsort(flat)
    ranked = flat[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    each = np.empty(len(flat))
    each[order] = values[np.searchsorted(keys, ranked[new])][np.cumsum(new) - 1]
    ends = np.cumsum([len(a) for a in arrays])
    return np.add.reduceat(each, np.concatenate(([0], ends[:-1])))


def _score_block(settings: Ppm, words: int, kinds: int, key_type: pa.DataType):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        reader = _Reader(settings.order)
        kind = answers.column("kind").to_numpy()
        keys, values = answers.column("key").to_numpy(), answers.column("value").to_numpy()
        tables = {}
        for k in (_WORD, _GRAM):
            own = np.flatnonzero(kind == k)
            own = own[np.argsort(keys[own])]
            tables[k] = keys[own], values[own]
        word_keys, word_counts = tables[_WORD]
        word_logs = np.log10((word_counts + 1) / (words + kinds + 1))
        gram_keys, gram_logs = tables[_GRAM]
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
        for batch in rows.to_batches(max_chunksize=500):
            texts = batch.column("text").to_pylist()
            for tokens in reader.words(texts):
                place = np.searchsorted(word_keys, tokens)
                out["n_tokens"].append(len(tokens))
                out["n_known"].append(int(np.count_nonzero(word_counts[place])))
                out["base_score"].append(float(word_logs[place].sum()))
            for some in _by_size(texts, 1_000_000):
                # No text is without grams: each has its end.
                out["score"] += _sums([reader.grams(text) for text in some], gram_keys, gram_logs).tolist()
        return pa.table(
            {
                "doc_id": rows.column("doc_id").cast(key_type),
                "held_out": rows.column("held_out"),
                "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                "n_known": pa.array(out["n_known"], pa.int64()),
                "train_tokens": pa.array([words] * len(rows), pa.int64()),
                "base_score": pa.array(out["base_score"], pa.float64()),
                "score": pa.array(out["score"], pa.float64()),
            }
        )

    return run


def score_documents(
    documents: DataFrame, settings: Ppm = Ppm(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each row's (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    rows = documents.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        is_held_out(F.col(key)).alias("held_out"),
    )
    counts = staged(corpus_counts(rows, settings), "counts")
    # Three sums come to the driver.
    sums = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    found = {row["kind"]: (row["n"], row["kinds"]) for row in sums}
    words, kinds = found.get(_WORD, (0, 0))
    # As many partitions as any other shuffle has: then a block's answers come to
    # where its texts are, and the one shuffle of the texts serves both.
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-found.get(_SIZE, (0, 0))[0] // settings.block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    dealt = rows.withColumn("block", block).repartition(parts, "block")
    asked = dealt.groupBy("block").applyInArrow(
        _asked_keys(settings), "block bigint, kind int, key bigint"
    )
    shares = byte_shares(
        counts.where(F.col("kind") == _GRAM).select("key", "n"), settings.order
    )
    known = counts.where(F.col("kind") == _WORD).select(
        "kind", "key", F.col("n").cast("double").alias("value")
    )
    known = known.union(shares.select(F.lit(_GRAM), "key", "share"))
    answers = asked.join(known, ["kind", "key"], "left").select(
        "block", "kind", "key", F.coalesce("value", F.lit(0.0)).alias("value")
    )
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_score_block(settings, words, kinds, pa.int64()), schema)
    )
