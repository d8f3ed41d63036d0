"""Repeated passages of the whole corpus by suffix arrays over blocks that share keys.

Every byte that lies in a string of `length` bytes which also starts earlier
(in a document of a smaller id, or before in the same one) is removed.

1. Keys. The key of a window of `length` bytes is the smallest hash among its
   grams of `gram` bytes, so equal windows have equal keys wherever they are.
   Neighbouring windows mostly share a key: such a run, with the bytes it
   covers, is a piece of text. Keys are counted over the corpus.
2. Candidates. Only pieces whose key occurs twice or more can hold a repeated
   window. The keys that do set a bit each in a bitmap of bounded size; a piece
   that is let through for nothing costs time, not rows. Of the equal pieces of
   a task the earliest is a candidate, and the others are repeated as a whole.
3. Suffix arrays. Candidates are dealt out by key, put together in blocks, and
   each block's suffixes are ordered by two-stage sorting (`suffixes`): those
   smaller than their successors are sorted, the others induced by bucket scans.
   Neighbours whose common prefix reaches `length` form a group of equal
   windows; all but the earliest of a group are repeated.
4. Removal. The ranges found are gathered per document and cut out of it.

A key of more than `crowded` pieces (a common phrase shorter than a window,
between different neighbours) is split: its windows take the hash of their
whole bytes as their key, so only equal windows meet, and each task sends the
earliest of those it has. A third of all rows that hold one passage thus cost a
task one row for each task that has read some of them.

Defined results: null texts are empty; null ids come before all others; rows of
one id are documents of their own, in the order of a hash of their texts, and of
rows equal in both the first one counts as the earliest. Texts are taken as
UTF-8, so a removed run may end inside a character; the kept bytes are returned
as bytes. Texts shorter than `length` bytes lose nothing. An empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinestar.llm.frames import BITMAP_ROW, bitmap, discard, staged
from cinestar.llm.hashing import mix
from cinestar.llm.suffixes import share_prefix, suffix_order

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18  # bytes hashed at once: the arrays over them stay in a core's cache


@dataclass(frozen=True)
class RepeatedPassages:
    """Bytes of a passage and of a hashed gram; pieces of a key that is split.

    `crowded` grows to a millionth of the pieces whose key is repeated, so that the
    keys that are split are a million at most. `block_bytes` are ordered at once, `task_bytes` dealt
    to a task. The bitmap has `bits_per_key` bits for each repeated key, up to
    `most_bits`: beyond, more pieces pass it.
    """

    length: int = 100
    gram: int = 24
    crowded: int = 8_000
    block_bytes: int = 2_000_000
    task_bytes: int = 8_000_000
    bits_per_key: int = 16
    most_bits: int = 1 << 28


class _Keys:
    """Hashes of all grams of a width, and of the windows they lie in."""

    def __init__(self, settings: RepeatedPassages) -> None:
        self.length, self.gram = settings.length, settings.gram
        self.byte = mix(np.arange(1, 257, dtype=_U))
        # Powers of the base and of its inverse, from the 0th on.
        self.up = self.down = np.ones(1, dtype=_U)

    def grams(self, raw: np.ndarray, width: int) -> np.ndarray:
        """A hash of the `width` bytes from each position on; polynomials, put together by doubling."""
        hashed, done, size, step = None, 0, 1, self.byte[raw]
        while True:
            if width & size:
                part = step[: len(raw) - width + 1 + (width - done - size)]
                if hashed is None:
                    hashed = part
                else:
                    tail = step[done:]
                    n = min(len(hashed), len(tail))
                    hashed = hashed[:n] * _U(pow(_BASE, size, 1 << 64)) + tail[:n]
                done += size
                if done == width:
                    return mix(hashed[: len(raw) - width + 1])
            factor = _U(pow(_BASE, size, 1 << 64))
            step = step[:-size] * factor + step[size:]
            size *= 2

    def whole(self, raw: np.ndarray) -> np.ndarray:
        """The hash of each window's bytes, the smallest bit set: no key of the other kind equals it."""
        return self.grams(raw, self.length) | _U(1)

    def pieces(self, raw: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each piece, from sums up to its ends."""
        while len(self.up) < len(raw):
            self.up, self.down = (
                np.concatenate((p, p * p[-1] * _U(base))) for p, base in ((self.up, _BASE), (self.down, _INVERSE))
            )
        sums = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(self.byte[raw] * self.up[: len(raw)])))
        return mix((sums[first + sizes] - sums[first]) * self.down[first] + sizes.astype(_U))

    def windows(self, grams: np.ndarray) -> np.ndarray:
        """The key of each window: the smallest hash of its grams, with the smallest bit clear."""
        least, width = grams, self.length - self.gram + 1
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            rest = width - size
            least = np.minimum(least[: len(least) - rest], least[rest:])
        return least & ~_U(1)


def _chunks(texts: pa.Array, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of whole texts, or of parts of a longer one, some hundred KB at a time.

    Gives (bytes, row of each text, where it begins here, where this part begins
    in it). Parts of a text overlap by `overlap` bytes.
    """
    parts, rows, starts, offsets, size = [], [], [], [], 0

    def out():
        return np.concatenate(parts), np.array(rows), np.array(starts), np.array(offsets)

    for row, text in enumerate(texts):
        buffer = text.as_buffer()
        if buffer is None or len(buffer) <= overlap:
            continue
        raw = np.frombuffer(buffer, dtype=np.uint8)
        for at in range(0, len(raw) - overlap, _CHUNK):
            part = raw[at : at + _CHUNK + overlap]
            if size and size + len(part) > _CHUNK + overlap:
                yield out()
                parts, rows, starts, offsets, size = [], [], [], [], 0
            parts.append(part)
            rows.append(row)
            starts.append(size)
            offsets.append(at)
            size += len(part)
    if parts:
        yield out()


def _runs(keys: np.ndarray, starts: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first window, windows) of each run of one key; no window crosses the end of a text."""
    n = len(keys)
    # The last length - 1 places of each text begin no window.
    ends = np.append(starts[1:], size)
    edges = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends - length + 1, -1)
    valid = np.cumsum(edges[:n]) > 0
    cut = np.ones(n, dtype=bool)
    cut[1:] = (keys[1:] != keys[:-1]) | ~valid[1:] | ~valid[:-1]
    cut[starts[starts < n]] = True
    first = np.flatnonzero(cut)
    count = np.diff(np.append(first, n))
    keep = valid[first]
    return first[keep], count[keep]


def _goes_on(keys: np.ndarray, grams: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which runs go on with the same key after a gram of that hash has left the window.

    Only such a run can hold two equal windows: the text between them has a
    period, and so has the gram that is their key.
    """
    left = np.concatenate(([0], np.cumsum((grams[: len(keys)] & ~_U(1)) == keys)))
    return left[first + count - 1] > left[first]


def key_counts(rows: DataFrame, settings: RepeatedPassages) -> DataFrame:
    """(key, n): pieces of each key in the rows of (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer, waiting, size = _Keys(settings), [], 0

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for raw, _, starts, _ in _chunks(texts, settings.length - 1):
                grams = keyer.grams(raw, settings.gram)
                keys = keyer.windows(grams)
                first, count = _runs(keys, starts, len(raw), settings.length)
                twice = first[_goes_on(keys, grams, first, count)]
                waiting.append(keys[np.concatenate((first, twice))])
                size += len(first)
                if size > 200_000:
                    yield out()
                    waiting, size = [], 0
        if waiting:
            yield out()

    emitted = rows.select("text").mapInArrow(run, "key bigint, n bigint")
    return emitted.groupBy("key").agg(F.sum("n").alias("n"))


class _Seen:
    """The earliest place of each piece of a task, by a hash of its bytes; of bounded size."""

    PLACE = [("null", "?"), ("id", "i8"), ("tie", "i8"), ("start", "i8")]

    def __init__(self, most: int = 4_000_000) -> None:
        self.most = most
        self.hashes = np.empty(0, dtype=_U)
        self.places = np.empty(0, dtype=self.PLACE)

    @staticmethod
    def _compare(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each place on the left before, at or after the one on the right; nulls first."""
        out = np.zeros(len(left), dtype=np.int8)
        for name, sign in (("null", -1), ("id", 1), ("tie", 1), ("start", 1)):
            a, b = left[name], right[name]
            out = np.where(out == 0, sign * ((a > b).astype(np.int8) - (a < b)), out)
        return out

    def sort_out(self, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each piece: 0, the earliest of its text so far; 1, a later one; 2, the earliest once more."""
        if len(self.hashes) > self.most:
            self.__init__(self.most)
        by = np.lexsort((places["start"], places["tie"], places["id"], ~places["null"], hashes))
        ranked, at = hashes[by], places[by]
        lead = np.ones(len(by), dtype=bool)
        lead[1:] = ranked[1:] != ranked[:-1]
        leaders = np.flatnonzero(lead)
        leader = leaders[np.cumsum(lead) - 1]
        kind = np.where(self._compare(at, at[leader]) == 0, 2, 1)
        # The leaders against what earlier calls have seen.
        hashed, found = ranked[leaders], np.searchsorted(self.hashes, ranked[leaders])
        known = np.zeros(len(leaders), dtype=bool)
        inside = found < len(self.hashes)
        known[inside] = self.hashes[found[inside]] == hashed[inside]
        order = np.full(len(leaders), -1, dtype=np.int8)
        order[known] = self._compare(at[leaders[known]], self.places[found[known]])
        kind[leaders] = np.choose(order + 1, [0, 2, 1])
        earlier = known & (order < 0)
        self.places[found[earlier]] = at[leaders[earlier]]
        new = ~known
        self.hashes = np.insert(self.hashes, found[new], hashed[new])
        self.places = np.insert(self.places, found[new], at[leaders[new]])
        out = np.empty(len(by), dtype=np.int8)
        out[by] = kind
        return out


_CANDIDATE = pa.schema(
    [
        ("key", pa.int64()),
        ("doc_id", pa.int64()),
        ("tie", pa.int64()),
        ("start", pa.int64()),
        ("size", pa.int64()),
        ("text", pa.binary()),
    ]
)


def candidates(rows: DataFrame, passing: Broadcast, crowded: Broadcast, settings: RepeatedPassages) -> DataFrame:
    """(key, doc_id, tie, start, size, text) of pieces that may be repeated; text null: they are."""
    length = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer, seen = _Keys(settings), _Seen()
        bits = np.frombuffer(passing.value, dtype=np.uint8)
        mask = _U(8 * len(bits) - 1)
        crowds = np.frombuffer(crowded.value, dtype=np.int64).view(_U)
        waiting, pieces, size = [], 0, 0

        def among_crowds(keys: np.ndarray) -> np.ndarray:
            if not len(crowds):
                return np.zeros(len(keys), dtype=bool)
            return crowds[np.minimum(np.searchsorted(crowds, keys), len(crowds) - 1)] == keys

        def out() -> Iterator[pa.RecordBatch]:
            """Of the pieces that wait, the earliest of each text, and all others without their text."""
            hashes, places, keys, firsts, sizes = (np.concatenate([w[k] for w in waiting]) for k in range(1, 6))
            chunk_of = np.repeat(np.arange(len(waiting)), [len(w[1]) for w in waiting])
            kind = seen.sort_out(hashes, places)
            told = np.flatnonzero(kind < 2)
            for k in range(0, len(told), 20_000):
                some = told[k : k + 20_000]
                place = places[some]
                texts = [
                    None if later else waiting[chunk][0][first : first + n]
                    for later, chunk, first, n in zip(
                        *(a[some].tolist() for a in (kind, chunk_of, firsts, sizes)), strict=True
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[some].view(np.int64)),
                        pa.array(place["id"], mask=place["null"]),
                        pa.array(place["tie"]),
                        pa.array(place["start"]),
                        pa.array(sizes[some]),
                        pa.array(texts, pa.binary()),
                    ],
                    schema=_CANDIDATE,
                )

        for batch in batches:
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            numbers, ties = ids.fill_null(0).to_numpy(), batch.column("tie").to_numpy()
            texts = batch.column("text").cast(pa.large_binary())
            for raw, of, starts, offsets in _chunks(texts, length - 1):
                keys = keyer.windows(keyer.grams(raw, settings.gram))
                first, count = _runs(keys, starts, len(raw), length)
                key = keys[first]
                place = (key & (mask << _U(1) | _U(1))) >> _U(1)
                passed = (bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 > 0
                first, count, key = first[passed], count[passed], key[passed]
                crowd = among_crowds(key)
                if crowd.any():
                    # Each window of a crowded key on its own.
                    each = np.repeat(first[crowd], count[crowd])
                    each += np.arange(len(each)) - np.repeat(np.cumsum(count[crowd]) - count[crowd], count[crowd])
                    first = np.concatenate((first[~crowd], each))
                    count = np.concatenate((count[~crowd], np.ones(len(each), dtype=count.dtype)))
                    key = np.concatenate((key[~crowd], keyer.whole(raw)[each]))
                if not len(first):
                    continue
                sizes = count + length - 1
                text_of = np.searchsorted(starts, first, side="right") - 1
                row = of[text_of]
                place = np.empty(len(first), dtype=seen.PLACE)
                place["null"], place["id"], place["tie"] = null[row], numbers[row], ties[row]
                place["start"] = first - starts[text_of] + offsets[text_of]
                waiting.append((raw.tobytes(), keyer.pieces(raw, first, sizes), place, key, first, sizes))
                pieces, size = pieces + len(first), size + len(raw)
                if pieces > 100_000 or size > 8_000_000:
                    yield from out()
                    waiting, pieces, size = [], 0, 0
        if waiting:
            yield from out()

    schema = "key bigint, doc_id bigint, tie bigint, start bigint, size bigint, text binary"
    return rows.select("doc_id", "tie", "text").mapInArrow(run, schema)


def _repeated_in_block(
    text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int
) -> np.ndarray:
    """The places in `text`, pieces laid end to end in the order of the documents, of repeated windows."""
    wanted = -np.bincount(starts + sizes - length + 1, minlength=len(text) + 1)
    wanted[starts] += 1
    order = suffix_order(text, np.cumsum(wanted[:-1]) > 0, length)
    if not len(order):
        return order
    same = share_prefix(text, order, length)
    group = np.concatenate(([0], np.cumsum(~same)))
    firsts = np.flatnonzero(np.concatenate(([True], ~same)))
    earliest = np.minimum.reduceat(order, firsts)
    return np.sort(order[order != earliest[group]])


def repeated_ranges(found: DataFrame, settings: RepeatedPassages) -> DataFrame:
    """(doc_id, tie, start, end) of the bytes under repeated windows, from candidates dealt out by key."""
    length = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        del batches
        table = table.sort_by([(c, "ascending") for c in ("key", "null", "doc_id", "tie", "start")])
        key, null, ids, ties, places, sizes = (
            table.column(c).to_numpy() for c in ("key", "null", "doc_id", "tie", "start", "size")
        )
        # A document that is there twice gives its pieces twice; they are one occurrence.
        again = np.zeros(len(key), dtype=bool)
        again[1:] = np.logical_and.reduce([a[1:] == a[:-1] for a in (key, null, ids, ties, places)])
        once = np.flatnonzero(~again)
        texts = table.column("text").take(pa.array(once))
        key, null, ids, ties, places, sizes = (a[once] for a in (key, null, ids, ties, places, sizes))
        firsts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        upto = np.append(np.cumsum(sizes)[firsts[1:] - 1], sizes.sum())
        # Blocks of whole keys.
        at = 0
        while at < len(firsts):
            done = upto[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, done + settings.block_bytes, side="right")))
            low, high = firsts[at], firsts[stop] if stop < len(firsts) else len(key)
            at = stop
            raw = np.frombuffer(b"".join(texts.slice(low, high - low).to_pylist()), dtype=np.uint8)
            size = sizes[low:high]
            starts = np.cumsum(size) - size
            windows = _repeated_in_block(raw, starts, size, length)
            if not len(windows):
                continue
            piece = np.searchsorted(starts, windows, side="right") - 1
            new = np.ones(len(windows), dtype=bool)
            new[1:] = (windows[1:] != windows[:-1] + 1) | (piece[1:] != piece[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(windows)) - 1
            of = piece[begin]
            origin = places[low:high][of] - starts[of]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[low:high][of], mask=null[low:high][of] == 0),
                    pa.array(ties[low:high][of]),
                    pa.array(windows[begin] + origin),
                    pa.array(windows[last] + origin + length),
                ],
                ["doc_id", "tie", "start", "end"],
            )

    # Null ids come first, in the order of a number that says so.
    dealt = found.select(
        "key",
        F.when(F.col("doc_id").isNull(), 0).otherwise(1).alias("null"),
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        "tie",
        "start",
        "size",
        "text",
    )
    return dealt.mapInArrow(run, "doc_id bigint, tie bigint, start bigint, end bigint")


def _cut(rows: DataFrame) -> DataFrame:
    """Each row of (doc_id, text, ranges) without the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            out = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept")}
            for text, ranges in zip(texts, batch.column("ranges"), strict=True):
                data = text.as_py() or b""
                removed = spans = 0
                if ranges.is_valid and len(ranges.values):
                    start = ranges.values.field("start").to_numpy()
                    end = ranges.values.field("end").to_numpy()
                    by = np.argsort(start)
                    start, end = start[by], np.maximum.accumulate(end[by])
                    new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
                    start, end = start[new], end[np.append(new[1:], len(end)) - 1]
                    removed, spans = int((end - start).sum()), len(start)
                    edges = zip([0, *end.tolist()], [*start.tolist(), len(data)], strict=True)
                    kept = b"".join(data[a:b] for a, b in edges)
                else:
                    kept = data
                for name, value in zip(out, (len(data), removed, spans, kept), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tie"),
                    *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                    pa.array(out["kept"], pa.binary()),
                ],
                ["doc_id", "tie", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = "doc_id bigint, tie bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return rows.mapInArrow(run, schema)


def remove_repeats(
    documents: DataFrame,
    settings: RepeatedPassages = RepeatedPassages(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each row's (doc_id, n_bytes, n_removed, n_spans, kept); `kept` are the bytes that stay."""
    spark = documents.sparkSession
    text_ = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text_).alias("tie"), text_.alias("text")
    )
    repeated = staged(key_counts(rows, settings).where("n > 1"), "keys")
    # Two numbers come to the driver, then the keys that are split, a million at most.
    total, n_repeated = repeated.agg(F.sum("n"), F.count("*")).first()
    crowd = max(settings.crowded, (total or 0) // 1_000_000)
    split = repeated.where(F.col("n") > crowd).select("key").toPandas()["key"].to_numpy(dtype=np.int64)
    crowded = spark.sparkContext.broadcast(np.sort(split.view(_U)).tobytes())
    bits = BITMAP_ROW
    while bits < min(settings.bits_per_key * n_repeated, settings.most_bits):
        bits *= 2
    # The smallest bit of a key only tells its kind.
    place = F.shiftright(F.col("key").bitwiseAND(F.lit(2 * bits - 1)), 1)
    passing = bitmap(repeated.select(place.alias("place")), bits)
    discard(repeated)

    found = staged(candidates(rows, passing, crowded, settings), "candidates")
    size = found.agg(F.sum(F.when(F.col("text").isNotNull(), F.col("size")))).first()[0] or 0
    parts = max(1, -(-size // settings.task_bytes))
    dealt = found.where(F.col("text").isNotNull()).repartition(parts, "key")
    whole = found.where(F.col("text").isNull()).select(
        "doc_id", "tie", "start", (F.col("start") + F.col("size")).alias("end")
    )
    ranges = repeated_ranges(dealt, settings).union(whole)
    ranges = ranges.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    ranges = ranges.withColumnsRenamed({"doc_id": "d", "tie": "t"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))
    return _cut(rows.join(ranges, same, "left").select("doc_id", "tie", "text", "ranges"))


def repeats_report(kept: DataFrame, settings: RepeatedPassages = RepeatedPassages()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256); rows equal in id and text after the first go whole."""
    digest = kept.select(
        "doc_id", "tie", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
    names = digest.columns
    rows = digest.groupBy(names).agg(F.count("*").alias("rows"))
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    goes = (F.col("row") > 1) & (F.col("n_bytes") >= settings.length)
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(goes, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(goes, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(goes, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
