"""Ranked lexical search by buckets of vector lengths, scored exactly in integers.

An item's score of a document is the sum, over the item's terms, of a term's weight times its impact in the document. With the square
root of the weight moved to each side, this is the inner product of a document vector and an item vector. One pass over the
documents keeps their occurrences of the items' terms; the vectors are then dealt by range and sorted by length, longest
first, and cut into buckets. The longest vectors are searched first; the score of the last place each item has
then is the least that a later document needs:

* by Cauchy-Schwarz, a bucket whose longest vector times the item's length stays below it is skipped, and vectors too short
  for every item are not even read;
* inside a bucket, the item's heaviest coordinates are summed; what the others can add is bounded by the lengths of what is left of
  both vectors, and documents that can't reach the least score go;
* the rest are scored exactly, in 64-bit integers.

Bounds are rounded up, so nothing that belongs into a result is pruned. Items are taken in blocks of bounded size, each against all
documents; nothing of a document but its best scores leaves a task.

Null texts have no terms; an item without terms, or one no document scores for, has no rows; repeated items are
items of their own, repeated documents rank next to each other. Equal scores come by ascending doc_id, null last. Long
texts are cut into terms piece by piece. An empty table on either side gives no rows; columns of other names are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookfuse.llm.common import stored, term_lists, term_table

TOP = 50
#: Terms of the items in one block; what is broadcast grows with it.
BLOCK_TERMS = 500_000
#: Vectors in a bucket, and the share of the longest that is searched first.
BUCKET = 4096
FIRST_SHARE = 0.04
#: Share of an item vector's squared length in the coordinates summed before the bound.
FOCUS = 0.6

_TERMS = term_table(digits=True)
_LAST = np.iinfo(np.int64).max
#: What rounding in doubles may take from a bound.
_SLACK = 1 + 1e-9


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = (c.to_pylist() for c in batch.columns)
        terms = [sorted({t for found in term_lists(text, _TERMS) for t in found}) for text in texts]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])


def _postings(vocabulary):
    """For each document: all its terms' number, and the numbers and occurrences of the terms in ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            sizes, ids, counts, ends = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                size, found = 0, Counter()
                for terms in term_lists(text, _TERMS):
                    size += len(terms)
                    found.update(terms)
                known = sorted((number[t], c) for t, c in found.items() if t in number)
                sizes.append(size)
                ids.extend(k for k, _ in known)
                counts.extend(c for _, c in known)
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return run


def _document_counts(size: int):
    """How many documents of a task hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], ["term", "docs"])

    return run


def _impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def _lengths(weights, documents: int, terms: int):
    """The vectors' lengths, and m, by which a document's size enters its impacts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value.astype(np.float64)
        for batch in batches:
            m = np.array([50 + (50 * n * documents) // terms for n in batch.column(1).to_pylist()], np.int64)
            ids, counts = batch.column(2), batch.column(3)
            each = np.diff(ids.offsets.to_numpy())
            impacts = _impacts(counts.flatten().to_numpy(), np.repeat(m, each)).astype(np.float64)
            squares = np.concatenate([[0.0], w[ids.flatten().to_numpy()] * impacts * impacts])
            # A sum for each document on its own: differences of running sums would not be exact enough.
            rows = np.repeat(np.arange(len(m)), each)
            lengths = np.sqrt(np.bincount(rows, squares[1:], len(m)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m), ids, counts, pa.array(lengths)], ["doc_id", "m", "terms", "counts", "length"])

    return run


class _Item:
    """An item's terms, heaviest first, and the best documents found so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, least: int, top: int):
        order = np.argsort(-weights[terms], kind="stable")
        self.terms = terms[order]
        w = weights[self.terms].astype(np.float64)
        self.length = math.sqrt(w.sum())
        focus = int(np.searchsorted(np.cumsum(w), FOCUS * w.sum())) + 1
        self.focus, self.rest_length = self.terms[:focus], math.sqrt(w[focus:].sum())
        self.given, self.least, self.top = least, least, top
        self.scores, self.docs = np.zeros(0, np.int64), np.zeros((2, 0), np.int64)

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs], 1)
        # By score, then by id; the first row of docs tells null ids, which are last.
        order = np.lexsort((docs[1], docs[0], -scores))[: self.top]
        self.scores, self.docs = scores[order], docs[:, order]
        if len(order) == self.top:
            self.least = max(self.given, int(self.scores[-1]))


def _search_bucket(items: list[_Item], weights: np.ndarray, docs: np.ndarray, m: np.ndarray, ids: np.ndarray, counts: np.ndarray, each: np.ndarray, lengths: np.ndarray) -> None:
    rows = np.repeat(np.arange(len(m)), each)
    impacts = _impacts(counts, np.repeat(m, each))
    starts = np.concatenate([[0], np.cumsum(each)])
    order = np.argsort(ids, kind="stable")
    by_term, row_of, impact_of = ids[order], rows[order], impacts[order]
    longest, squared = float(lengths.max()), lengths * lengths
    own = np.zeros(len(weights), np.int64)
    for item in items:
        if item.length * longest * _SLACK < item.least:
            continue
        lows, highs = np.searchsorted(by_term, item.focus), np.searchsorted(by_term, item.focus, "right")
        at = np.concatenate([np.arange(low, high) for low, high in zip(lows, highs, strict=True)])
        found = np.repeat(weights[item.focus], highs - lows)
        hit, impact = row_of[at], impact_of[at].astype(np.float64)
        part = np.bincount(hit, found * impact, len(m))
        left = np.maximum(squared * _SLACK - np.bincount(hit, found * impact * impact, len(m)), 0)
        survivors = np.flatnonzero((part + item.rest_length * np.sqrt(left)) * _SLACK >= max(item.least, 1))
        if not len(survivors):
            continue
        own[item.terms] = weights[item.terms]
        n = each[survivors]
        offsets = np.concatenate([[0], np.cumsum(n)[:-1]])
        cells = np.repeat(starts[survivors] - offsets, n) + np.arange(n.sum())
        # bincount adds in doubles; this adds in integers. Survivors have a term each, so no run is empty.
        scores = np.add.reduceat(own[ids[cells]] * impacts[cells], offsets)
        own[item.terms] = 0
        kept = scores >= max(item.least, 1)
        if kept.any():
            item.offer(scores[kept], docs[:, survivors[kept]])


def _search(block, weights, least: dict[int, int], top: int):
    """The best documents of a task's vectors, which come longest first, for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        items = {number: _Item(terms, w, least.get(number, 0), top) for number, terms in block.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                ids, m, terms, counts, lengths = part.columns
                docs = np.stack([ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(_LAST).to_numpy()])
                each = np.diff(terms.offsets.to_numpy())
                _search_bucket(list(items.values()), w, docs, m.to_numpy(), terms.flatten().to_numpy(), counts.flatten().to_numpy(), each, lengths.to_numpy())
        for number, item in items.items():
            if len(item.scores):
                found = pa.array(item.docs[1], pa.int64(), mask=item.docs[0] == 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), number, np.int64)), found, pa.array(item.scores)], ["item", "doc_id", "score"])

    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(documents: DataFrame, items: dict[int, list[bytes]], top: int) -> DataFrame:
    """(item, doc_id, score, rank) for a block of items, by number."""
    spark = documents.sparkSession
    context = spark.sparkContext
    names = sorted({t for terms in items.values() for t in terms})
    vocabulary = {t: i for i, t in enumerate(names)}
    fields = "doc_id long, n long, terms array<int>, counts array<long>"
    indexed = stored(documents.mapInArrow(_postings(context.broadcast(vocabulary)), fields), "postings")
    held, terms = indexed.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = indexed.select("terms").mapInArrow(_document_counts(len(names)), "term int, docs long")
    docs = np.zeros(len(names), np.int64)
    for term, number in counted.groupBy("term").agg(F.sum("docs")).toLocalIterator():
        docs[term] = number
    weights = np.array([math.floor(1000 * math.log((2 * held + 2) / (2 * d + 1))) for d in docs.tolist()], np.int64)
    weights_sent = context.broadcast(weights)
    block = context.broadcast({number: np.array([vocabulary[t] for t in terms], np.int64) for number, terms in items.items()})

    fields = "doc_id long, m long, terms array<int>, counts array<long>, length double"
    vectors = indexed.where("size(terms) > 0").mapInArrow(_lengths(weights_sent, held, terms), fields)
    vectors = vectors.repartitionByRange(F.desc("length"), "doc_id").sortWithinPartitions(F.desc("length"))
    vectors = stored(vectors, "vectors")
    found = "item long, doc_id long, score long"
    cut = vectors.approxQuantile("length", [1 - FIRST_SHARE], FIRST_SHARE / 4)
    if not cut:
        return spark.createDataFrame([], f"{found}, rank int")
    # The longest first: what the last of an item's best has is the least that the others need.
    longest = vectors.where(F.col("length") >= cut[0]).mapInArrow(_search(block, weights_sent, {}, top), found)
    longest = stored(_best(longest, top), "best")
    least = {r.item: r.score for r in longest.where(F.col("rank") == top).select("item", "score").toLocalIterator()}
    lengths = {n: math.sqrt(float(weights[ids].sum())) for n, ids in block.value.items()}
    shortest = min((least.get(n, 0) / (length * _SLACK) for n, length in lengths.items() if length), default=0.0)
    others = vectors.where((F.col("length") < cut[0]) & (F.col("length") >= shortest / _SLACK))
    others = others.mapInArrow(_search(block, weights_sent, least, top), found)
    return _best(longest.drop("rank").unionByName(others), top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    documents = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    queries = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    queries = queries.mapInArrow(_item_terms, "item_id long, terms array<binary>").withColumn("item", F.monotonically_increasing_id())
    queries = stored(queries.where("size(terms) > 0"), "items")
    size = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = math.ceil(size / block_terms)
    results = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for number in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        held = {r.item: [bytes(t) for t in r.terms] for r in block.select("item", "terms").toLocalIterator()}
        if held:
            results = results.unionByName(_search_block(documents, held, top))
    return results.join(queries.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
