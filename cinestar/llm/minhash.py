"""Near-duplicate detection: one-permutation MinHash, banded buckets, stars.

1. Sketch. A document is the set of its distinct word shingles (64-bit hashes).
   One permutation splits the hash range into `bands * rows` bins, the smallest
   hash of a bin is its value, and an empty bin takes the value of the first
   full bin in an order of its own, the same for all documents (densification).
   Each run of `rows` bins is a band.
2. Copies. Documents with equal sets (128-bit digest) form a class, represented
   by its smallest id. Only representatives go on.
3. Buckets. Representatives that agree in a band meet in a bucket. A bucket of
   any size gives a star: its centre against each other member, so the pairs
   grow with the rows, never with a bucket's square. The centre is the member
   that meets most others over all its buckets: among copies that were each
   changed in their own way that is their original, which is closer to every
   copy than the copies are to each other. Pairs whose sizes rule the
   similarity out are left out.
4. Confirmation. A pair is a link if its full sets are similar enough. Before
   the sets are fetched, a byte of each bin is compared: where both sets are
   large enough to fill the bins, fewer than `likely` equal bytes are five
   standard deviations below the limit, and the pair is dropped.
5. Components of the links. A star misses a link whose two ends are both too far
   from its centre, so buckets that hold members of several components are gone
   through once more, exactly: the bucket's largest component is its body, all
   other members are its rest, and each one of the rest is compared with every
   member of another component. A bucket is dealt into cells of `block` members
   and `block` of its rest, or fewer of larger sets. In a cell the shingles' lists
   (of sets up to `filled` shingles) give the shared numbers; larger sets are
   compared as a whole where their bins do not rule a link out. Only a spanning
   forest of a cell's links comes out, never all pairs.

With 40 bands of 5 rows two documents at similarity 0.8 share no bucket with a
probability of 1.3e-7, at 0.85 of 2e-10.

Copies, buckets and labels are combined within tasks before they are shuffled;
the remaining joins have one small side per hot key, and Spark splits the other.

Defined results: a null, empty or blank text has an empty set, links with
nothing and is its own component. Rows of the same id are one document: they
share a component. A row with a null id takes no part: null component, kept.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinestar.llm.components import components
from cinestar.llm.frames import discard, slices, staged
from cinestar.llm.hashing import WordHasher, mix, shingles
from cinestar.session import ensure_checkpoint_dir

_U = np.uint64


@dataclass(frozen=True)
class NearDuplicates:
    """Words in a shingle; least similarity in percent; bands and rows of the sketch.

    From `filled` shingles on, the share of equal bins estimates the similarity
    well enough to drop pairs below `likely` percent. `block` members of a bucket
    are compared with as many others of its rest in one place, and these have
    about `shingles` shingles on either side at most.
    """

    width: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    filled: int = 400
    likely: int = 65
    block: int = 512
    shingles: int = 1 << 21


class _Sketcher:
    def __init__(self, settings: NearDuplicates) -> None:
        self.bands, self.rows = settings.bands, settings.rows
        self.bins = settings.bands * settings.rows
        each = np.arange(self.bins, dtype=_U)
        # For each bin, all bins in the order in which it tries them.
        self.order = np.argsort(mix(each[:, None] * _U(1 << 32) + each[None, :] + _U(1)), axis=1)

    def bands_of(self, values: np.ndarray) -> tuple[np.ndarray, bytes]:
        """One hash per band, and a byte per bin, for a sorted, non-empty set."""
        places = ((values >> _U(32)) * _U(self.bins) >> _U(32)).astype(np.int64)
        first = np.ones(len(values), dtype=bool)
        first[1:] = places[1:] != places[:-1]
        sketch = np.zeros(self.bins, dtype=_U)
        full = np.zeros(self.bins, dtype=bool)
        sketch[places[first]] = values[first]
        full[places[first]] = True
        empty = np.flatnonzero(~full)
        if len(empty):
            order = self.order[empty]
            chosen = order[np.arange(len(empty)), np.argmax(full[order], axis=1)]
            sketch[empty] = sketch[chosen]
        table = sketch.reshape(self.bands, self.rows)
        out = np.arange(1, self.bands + 1, dtype=_U)
        for k in range(self.rows):
            out = mix(out * _U(3) + table[:, k])
        return out.view(np.int64), mix(sketch).astype(np.uint8).tobytes()


def sketches(documents: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, bins) of each row of (doc_id, text)."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketcher = WordHasher(), _Sketcher(settings)
        for batch in slices(batches):
            counts, digests, bands, bins = [], [], [], []
            for words in hasher.texts(batch.column("text").to_pylist()):
                found = shingles(words, settings.width)
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                band, each = sketcher.bands_of(found) if len(found) else (None, None)
                bands.append(band)
                bins.append(each)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bins, pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "bands", "bins"],
            )

    schema = f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>, bins binary"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _sets(documents: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(doc_id, value): the whole set of each row, as bytes of sorted 64-bit hashes."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches):
            texts = hasher.texts(batch.column("text").to_pylist())
            values = [shingles(words, settings.width).tobytes() for words in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.binary())], ["doc_id", "value"]
            )

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, value binary")


def _both(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Pairs (a, b) with the value of either end: `left`, `right`."""
    for end, name in (("b", "right"), ("a", "left")):
        side = values.select(F.col("doc_id").alias(end), F.col("value").alias(name))
        pairs = pairs.join(side, end)
    return pairs


def _likely(pairs: DataFrame, bins: DataFrame, settings: NearDuplicates) -> DataFrame:
    """The pairs (a, b, n) that their bins do not rule out; n is the size of the smaller set."""
    kind = pairs.schema["a"].dataType.simpleString()
    least = settings.likely * settings.bands * settings.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(
                    batch.num_rows, -1
                )
                for c in ("left", "right")
            )
            small = batch.column("n").to_numpy() < settings.filled
            keep = small | (100 * np.count_nonzero(left == right, axis=1) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = _both(pairs, bins).select("a", "b", "n", "left", "right")
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def _similar(left: pa.Scalar, right: pa.Scalar, percent: int) -> bool:
    """Whether two whole sets are similar enough."""
    both = np.concatenate([np.frombuffer(v.as_buffer(), dtype=_U) for v in (left, right)])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ends = zip(batch.column("left"), batch.column("right"), strict=True)
            keep = [_similar(left, right, percent) for left, right in ends]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = _both(pairs, sets).select("a", "b", "left", "right")
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def _stars(buckets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b, n): each bucket's member that meets most others, with each other member.

    `buckets` holds (bucket, doc_id, n, met).
    """
    me = F.struct((-F.col("met")).alias("p"), "doc_id", "n")
    centres = buckets.groupBy("bucket").agg(F.min(me).alias("c"))
    pairs = buckets.join(centres, "bucket").where(F.col("doc_id") != F.col("c.doc_id"))
    fits = 100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")
    return (
        pairs.where(fits)
        .select(
            F.least("doc_id", "c.doc_id").alias("a"),
            F.greatest("doc_id", "c.doc_id").alias("b"),
            F.least("n", "c.n").alias("n"),
        )
        .distinct()
    )


def _crossing(labelled: DataFrame) -> DataFrame:
    """(bucket, body, size, total, rest, rest_total) of the buckets with members of several components.

    `labelled` holds (bucket, doc_id, n, component); totals are sums of n.
    """
    parts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    whole = parts.groupBy("bucket").agg(
        F.max(F.struct("size", "component", "total")).alias("body"),
        F.sum("size").alias("size"),
        F.sum("total").alias("total"),
    )
    return whole.where(F.col("size") > F.col("body.size")).select(
        "bucket",
        F.col("body.component").alias("body"),
        "size",
        "total",
        (F.col("size") - F.col("body.size")).alias("rest"),
        (F.col("total") - F.col("body.total")).alias("rest_total"),
    )


def _values(sets: DataFrame, classes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(doc_id, hashes, bins, whole): a smaller set as 32-bit hashes, a set that fills its bins with them.

    A set too large for the first has the second, and so has any set of a size
    that allows a link with it.
    """
    kind = sets.schema["doc_id"].dataType.simpleString()
    small = -(-100 * settings.filled // settings.percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, bins, sets_ = [], [], []
            for whole, each in zip(batch.column("whole"), batch.column("bins"), strict=True):
                found = np.frombuffer(whole.as_buffer(), dtype=_U)
                hashes.append((found >> _U(32)).astype("<u4").tobytes() if len(found) <= small else None)
                full = len(found) >= settings.filled
                bins.append(each.as_py() if full else None)
                sets_.append(whole.as_py() if full else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, pa.binary()) for v in (hashes, bins, sets_))],
                ["doc_id", "hashes", "bins", "whole"],
            )

    both = sets.withColumnRenamed("value", "whole").join(
        classes.select("doc_id", F.col("value").alias("bins")), "doc_id"
    )
    schema = f"doc_id {kind}, hashes binary, bins binary, whole binary"
    return both.select("doc_id", "whole", "bins").mapInArrow(run, schema)


def _cells(labelled: DataFrame, crossing: DataFrame, values: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(bucket, block, asks, probe, doc_id, n, component, hashes, bins, whole): cells of members and of rest."""

    def parts(rows: str, total: str):
        return F.greatest(F.ceil(F.col(rows) / settings.block), F.ceil(F.col(total) / settings.shingles))

    dealt = {"blocks": parts("size", "total"), "asks_of": parts("rest", "rest_total")}
    members = labelled.join(crossing.withColumns(dealt), "bucket").select(
        "bucket",
        "doc_id",
        "n",
        F.xxhash64("component").alias("component"),
        (F.col("component") != F.col("body")).alias("in_rest"),
        "blocks",
        "asks_of",
    )
    own, asks = F.pmod(F.xxhash64("doc_id"), "blocks"), F.pmod(F.xxhash64("doc_id"), "asks_of")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    rows = ("doc_id", "n", "component")
    in_blocks = members.select(
        "bucket", own.alias("block"), each("asks_of").alias("asks"), F.lit(False).alias("probe"), *rows
    )
    probes = members.where("in_rest").select(
        "bucket", each("blocks").alias("block"), asks.alias("asks"), F.lit(True).alias("probe"), *rows
    )
    return in_blocks.union(probes).join(values, "doc_id")


class _Forest:
    """Which components are joined already."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        while (above := self.up.get(node, node)) != node:
            self.up[node] = self.up.get(above, above)
            node = above
        return node

    def join(self, one: int, two: int) -> bool:
        """Whether they were apart."""
        one, two = self.root(one), self.root(two)
        self.up[one] = two
        return one != two


def _shared(members: list[bytes], asking: list[bytes]) -> Iterator[np.ndarray]:
    """For each set that asks, how many hashes it shares with each member; sets as 32-bit hashes."""
    flat = np.frombuffer(b"".join(members + asking), dtype="<u4")
    _, number = np.unique(flat, return_inverse=True)
    cuts = np.cumsum([len(v) // 4 for v in members + asking])
    owner = np.repeat(np.arange(len(members)), np.diff(cuts[: len(members)], prepend=0))
    order = np.argsort(number[: len(owner)], kind="stable")
    # Each hash's members, one list after the other.
    listed = owner[order]
    starts = np.searchsorted(number[: len(owner)][order], np.arange(len(flat) + 1))
    for low, high in zip(cuts[len(members) - 1 : -1], cuts[len(members) :], strict=True):
        mine = number[low:high]
        length = starts[mine + 1] - starts[mine]
        at = np.arange(length.sum()) + np.repeat(starts[mine] - (np.cumsum(length) - length), length)
        yield np.bincount(listed[at], minlength=len(members))


def _compare(cell: pa.RecordBatch, settings: NearDuplicates) -> Iterator[tuple[int, int]]:
    """Rows of a cell that are linked: a spanning forest of its components' links."""
    probe = cell.column("probe").to_numpy(zero_copy_only=False)
    n, component = (cell.column(c).to_numpy() for c in ("n", "component"))
    hashes, bins, whole = (cell.column(c) for c in ("hashes", "bins", "whole"))
    small, large = (~v.is_null().to_numpy(zero_copy_only=False) for v in (hashes, bins))
    forest = _Forest()

    members, asking = np.flatnonzero(~probe & small), np.flatnonzero(probe & small)
    if len(members) and len(asking):
        shared_by = _shared(*(hashes.take(pa.array(rows)).to_pylist() for rows in (members, asking)))
        for one, shared in zip(asking.tolist(), shared_by, strict=True):
            fits = 100 * shared >= settings.percent * (n[members] + n[one] - shared)
            for two in members[fits & (component[members] != component[one])].tolist():
                if forest.join(int(component[one]), int(component[two])):
                    yield one, two

    members, asking = np.flatnonzero(~probe & large), np.flatnonzero(probe & large)
    if len(members) and len(asking):
        theirs, ours = (
            np.frombuffer(b"".join(bins.take(pa.array(rows)).to_pylist()), dtype=np.uint8).reshape(len(rows), -1)
            for rows in (members, asking)
        )
        for one, mine in zip(asking.tolist(), ours, strict=True):
            equal = np.count_nonzero(theirs == mine, axis=1)
            low, high = np.minimum(n[members], n[one]), np.maximum(n[members], n[one])
            fits = (100 * equal >= settings.likely * theirs.shape[1]) & (100 * low >= settings.percent * high)
            fits &= (component[members] != component[one]) & ~(small[members] & small[one])
            for two in members[fits].tolist():
                ends = int(component[one]), int(component[two])
                if forest.root(ends[0]) != forest.root(ends[1]) and _similar(whole[one], whole[two], settings.percent):
                    forest.join(*ends)
                    yield one, two


def _across(cells: DataFrame, settings: NearDuplicates) -> DataFrame:
    """Distinct pairs (a, b) from the cells."""
    kind = cells.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None

        def pairs(cell: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = np.array(list(_compare(cell, settings)), dtype=np.int64).reshape(-1, 2)
            if len(found):
                ids = cell.column("doc_id")
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(found[:, k])) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = [batch.column(c).to_numpy() for c in ("bucket", "block", "asks")]
            new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            for low, high in zip(cuts, cuts[1:], strict=False):
                yield from pairs(batch.slice(low, high - low))
            rest = batch.slice(cuts[-1]) if batch.num_rows else None
        if rest is not None:
            yield from pairs(rest)

    key = ("bucket", "block", "asks")
    dealt = cells.repartition(*key).sortWithinPartitions(*key)
    pairs = dealt.mapInArrow(run, f"a {kind}, b {kind}")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    documents: DataFrame,
    settings: NearDuplicates = NearDuplicates(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each row's (doc_id, n_shingles, component_id, kept)."""
    ensure_checkpoint_dir(documents.sparkSession)
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sketched = staged(sketches(rows, settings), "sketches")
    sizes = staged(sketched.select("doc_id", "n_shingles", "digest"), "sizes")
    taking_part = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    known = sizes.where(taking_part)
    classes = staged(
        sketched.where(taking_part)
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("bins").alias("value"),
            F.count("*").alias("copies"),
        ),
        "copies",
    )
    discard(sketched)
    members = known.select("doc_id", "digest").join(
        classes.where("copies > 1").select("digest", F.col("doc_id").alias("a")), "digest"
    )
    members = staged(members.where("doc_id <> a").select("a", F.col("doc_id").alias("b")), "members")
    # An id whose rows have different texts lies in several classes and links them.
    several = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = several.where("low <> high").select(F.col("doc_id").alias("b"))
    bridges = staged(members.join(several, "b", "semi").select("a", "b"), "bridges")

    buckets = classes.select("doc_id", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    counted = staged(buckets.join(shared, "bucket"), "counted")
    met = staged(counted.groupBy("doc_id").agg(F.sum("size").alias("met")), "met")
    buckets = staged(counted.drop("size").join(met, "doc_id"), "buckets")
    discard(counted)
    classes_ = staged(classes.select("doc_id", "value").join(met.select("doc_id"), "doc_id", "semi"), "bins")
    discard(classes)

    pairs = staged(_stars(buckets, settings.percent), "pairs")
    sets = staged(_sets(rows.join(met.select("doc_id"), "doc_id", "semi").distinct(), settings), "sets")
    new = staged(_confirm(_likely(pairs, classes_, settings), sets, settings.percent), "links")
    discard(pairs, met)
    links = bridges.union(new)
    labels = components(links)
    labelled = staged(
        buckets.drop("met")
        .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id")),
        "labelled",
    )
    discard(buckets)
    crossing = staged(_crossing(labelled), "crossing")
    left = labelled.join(crossing.select("bucket"), "bucket", "semi").select("doc_id").distinct()
    values = staged(_values(sets.join(left, "doc_id", "semi"), classes_, settings), "values")
    rest = staged(_across(_cells(labelled, crossing, values, settings), settings), "rest")
    discard(labelled, crossing, values, classes_)
    more = staged(_confirm(rest, sets, settings.percent), "last-links")
    discard(rest, sets)
    if not more.isEmpty():
        labels = components(links.union(more))
    return _result(sizes, members, labels)


def _result(sketched: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of the representatives, carried to their copies and to all rows."""
    near = labels.select("node", "component")
    copies = members.join(near.withColumnRenamed("node", "a"), "a", "left").select(
        F.col("b").alias("doc_id"), F.coalesce("component", "a").alias("component")
    )
    found = (
        copies.union(near.select(F.col("node").alias("doc_id"), "component"))
        .groupBy("doc_id")
        .agg(F.min("component").alias("component"))
    )
    rows = sketched.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
