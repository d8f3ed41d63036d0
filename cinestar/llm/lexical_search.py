"""Ranked lexical search over K2-treaps of terms and documents.

Index. Documents are taken in blocks of about `block_postings` postings, as
they are read, without a shuffle. A block's grid has its terms as rows, the
frequent ones first, its documents as columns, by id, and as values the impacts
(the part of a document's score that does not depend on how rare the term is).
Its quadtree of maxima (`treap`) is made and searched in the same task: it is
larger than the text it comes from is to read again, so it is not written. The
numbers that impacts need, documents and terms in all, and how many documents
hold a term, are counted over all documents first.

Search. An item's terms and weights go down the quadtrees together, best first
over document ranges, until no range can hold one of its `most` best documents.
A task goes through its blocks one after the other and carries each item's limit
on, so later blocks are entered less deeply; it gives out `most` rows an item at
most, and a window over these ranks them. Items are the stated query set: they
are taken in blocks of `query_terms` terms, each searched by a job of its own,
so that the driver and the tasks hold one block at a time.

A score is the sum over an item's distinct terms of weight times impact, in
64-bit integers, so a bound is exact and no document is missed.

Defined results: a null or termless text has no terms and is never found; it
does not count as a document. Rows of one id are documents of their own; a null
id comes after all others of the same score. Rows of items equal in id and text
are one item; items without known terms have no rows; an empty table on either
side gives none. Terms are compared by 64-bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinestar.llm.frames import slices, staged
from cinestar.llm.hashing import WordHasher
from cinestar.llm.treap import Treap, best_columns


@dataclass(frozen=True)
class LexicalSearch:
    """Documents returned an item; postings of a quadtree; terms of a block of items.

    `items_at_once` go down a quadtree together.
    """

    most: int = 50
    block_postings: int = 300_000
    query_terms: int = 1_000_000
    items_at_once: int = 16


class TermHasher(WordHasher):
    """Hashes of terms: runs of ASCII letters, digits and anything beyond ASCII; A-Z count as a-z."""

    def __init__(self) -> None:
        super().__init__(lower=True)
        code = np.arange(256)
        letter = (code >= 0x80) | ((code >= 48) & (code < 58)) | ((code | 32) >= 97) & ((code | 32) < 123)
        self.space = ~letter
        self.value[self.space] = 0


def _postings(batch: pa.RecordBatch, hasher: TermHasher) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct terms, occurrences of each) of the texts that have terms."""
    for row, words in enumerate(hasher.texts(batch.column("text").to_pylist())):
        if len(words):
            yield row, *np.unique(words, return_counts=True)


def term_counts(documents: DataFrame) -> DataFrame:
    """(term, df, n): documents that hold a term; for the null term, documents and their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, waiting, size, documents_, length = TermHasher(), [], 0, 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            terms, df = np.unique(np.concatenate(waiting), return_counts=True)
            for k in range(0, len(terms), 100_000):
                some = slice(k, k + 100_000)
                n = np.zeros(len(terms[some]), dtype=np.int64)
                arrays = [pa.array(terms[some].view(np.int64)), pa.array(df[some]), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, ["term", "df", "n"])

        for batch in slices(batches):
            for _, terms, tf in _postings(batch, hasher):
                waiting.append(terms)
                size += len(terms)
                documents_ += 1
                length += int(tf.sum())
            if size > 4_000_000:
                yield from out()
                waiting, size = [], 0
        if waiting:
            yield from out()
        arrays = [pa.array([None], pa.int64()), pa.array([documents_]), pa.array([length])]
        yield pa.RecordBatch.from_arrays(arrays, ["term", "df", "n"])

    emitted = documents.select("text").mapInArrow(run, "term bigint, df bigint, n bigint")
    return emitted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term's occurrences in a document of n terms are worth, before the term's weight."""
    m = 100 - 50 + (50 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class _Block:
    """The quadtree of some documents, (id, terms, occurrences) each."""

    def __init__(self, documents: list[tuple], n_documents: int, length: int) -> None:
        # Columns in the order of the ids, null ids last.
        documents.sort(key=lambda d: (d[0] is None, d[0] or 0))
        self.ids = pa.array([d[0] for d in documents], pa.int64())
        counts = np.array([len(d[1]) for d in documents])
        terms, tf = (np.concatenate([d[k] for d in documents]) for k in (1, 2))
        column = np.repeat(np.arange(len(documents)), counts)
        n = np.array([int(d[2].sum()) for d in documents])[column]
        self.terms, of, df = np.unique(terms, return_inverse=True, return_counts=True)
        # Frequent terms first: cells of rare terms are mostly empty, so their bounds are close.
        self.row = np.empty(len(self.terms), dtype=np.int64)
        self.row[np.argsort(-df, kind="stable")] = np.arange(len(self.terms))
        self.treap = Treap.build(self.row[of], column, impacts(tf, n, n_documents, length))

    def rows_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of each term, is it there)."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return self.row[at], self.terms[at] == terms


class _Best:
    """The best documents of each item so far, and the score from which on another one counts."""

    def __init__(self, items: int, most: int) -> None:
        self.items, self.most, self.least = items, most, np.ones(items, dtype=np.int64)
        self.place, self.score, self.id = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.null = np.empty(0, dtype=bool)

    def add(self, place: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        self.place, self.score = np.concatenate((self.place, place)), np.concatenate((self.score, score))
        self.id = np.concatenate((self.id, ids.fill_null(0).to_numpy(zero_copy_only=False)))
        self.null = np.concatenate((self.null, ids.is_null().to_numpy(zero_copy_only=False)))

    def cut(self) -> None:
        order = np.lexsort((self.id, self.null, -self.score, self.place))
        first = np.searchsorted(self.place[order], self.place[order])
        order = order[np.arange(len(order)) - first < self.most]
        self.place, self.score, self.id, self.null = (a[order] for a in (self.place, self.score, self.id, self.null))
        full = np.flatnonzero(np.bincount(self.place, minlength=self.items) == self.most)
        last = np.searchsorted(self.place, full, side="right") - 1
        self.least[full] = np.maximum(self.least[full], self.score[last])


def weighted_terms(items: DataFrame, counts: DataFrame, n_documents: int) -> DataFrame:
    """(item, terms): the known terms of each (item, text) with their weights."""
    kind = items.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = TermHasher()
        for batch in slices(batches):
            for row, terms, _ in _postings(batch, hasher):
                item = batch.column("item").slice(row, 1).take(pa.array(np.zeros(len(terms), dtype=np.int64)))
                yield pa.RecordBatch.from_arrays([item, pa.array(terms.view(np.int64))], ["item", "term"])

    asked = items.select("item", "text").mapInArrow(run, f"item {kind}, term bigint")
    share = F.lit(float(2 * n_documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(1000 * F.log(share)).cast("long")
    known = asked.join(counts.where(F.col("term").isNotNull()).select("term", "df"), "term")
    return known.groupBy("item").agg(F.collect_list(F.struct("term", weight.alias("weight"))).alias("terms"))


def _blocks_of(items: DataFrame, size: int) -> Iterator[list]:
    """The rows of (item, terms), so many at a time that they hold about `size` terms."""
    block, terms = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        terms += len(row["terms"])
        if terms >= size:
            yield block
            block, terms = [], 0
    if block:
        yield block


def search_block(
    documents: DataFrame, block: list, n_documents: int, length: int, settings: LexicalSearch
) -> DataFrame:
    """(place, doc_id, score): each task's best documents for the items of a block, by their place in it."""
    sizes = np.array([len(row["terms"]) for row in block])
    terms = np.array([t["term"] for row in block for t in row["terms"]], dtype=np.int64).view(np.uint64)
    weights = np.array([t["weight"] for row in block for t in row["terms"]], dtype=np.int64)
    shared = documents.sparkSession.sparkContext.broadcast((sizes, terms, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, terms, weights = shared.value
        owner = np.repeat(np.arange(len(sizes)), sizes)
        hasher, best = TermHasher(), _Best(len(sizes), settings.most)

        def enter(documents: list[tuple]) -> None:
            grid = _Block(documents, n_documents, length)
            row, there = grid.rows_of(terms)
            for low in range(0, len(sizes), settings.items_at_once):
                high = min(low + settings.items_at_once, len(sizes))
                some = np.arange(*np.searchsorted(owner, (low, high)))
                some = some[there[some]]
                item, column, score = best_columns(
                    grid.treap, len(grid.ids), row[some], weights[some], owner[some] - low,
                    best.least[low:high], settings.most,
                )
                best.add(item + low, score, grid.ids.take(pa.array(column)))
            best.cut()

        waiting, size = [], 0
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            for row, found, tf in _postings(batch, hasher):
                waiting.append((ids[row], found, tf))
                size += len(found)
                if size >= settings.block_postings:
                    enter(waiting)
                    waiting, size = [], 0
        if waiting:
            enter(waiting)
        arrays = [pa.array(best.place), pa.array(best.id, mask=best.null), pa.array(best.score)]
        yield pa.RecordBatch.from_arrays(arrays, ["place", "doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "place bigint, doc_id bigint, score bigint")


def search(
    documents: DataFrame,
    items: DataFrame,
    settings: LexicalSearch = LexicalSearch(),
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Each item's best documents: (item, rank, doc_id, score)."""
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).distinct()
    kind = asked.schema["item"].dataType.simpleString()
    # An item's own key: rows of one id with different texts are different items.
    asked = asked.select(F.struct("item", F.xxhash64("item", "text").alias("own")).alias("item"), "text")
    counts = staged(term_counts(rows), "terms")
    # Two numbers come to the driver.
    total = counts.where(F.col("term").isNull()).first()
    n_documents, length = (total["df"], total["n"]) if total else (0, 0)
    schema = f"item struct<item:{kind},own:bigint>, doc_id bigint, score bigint"
    found = spark.createDataFrame([], schema)
    if n_documents:
        known = staged(weighted_terms(asked, counts, n_documents), "items")
        for block in _blocks_of(known, settings.query_terms):
            best = search_block(rows, block, n_documents, length, settings)
            names = spark.createDataFrame(
                [(k, tuple(row["item"])) for k, row in enumerate(block)],
                f"place bigint, item struct<item:{kind},own:bigint>",
            )
            best = best.join(F.broadcast(names), "place").select("item", "doc_id", "score")
            found = found.union(staged(best, "found"))
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= settings.most)
    return best.select("item.item", "rank", "doc_id", "score")
