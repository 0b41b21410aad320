"""Benchmark items inside documents: containment search by size-partitioned MinHash sketches, verified exactly.

An item is contained in a document if at least ``threshold`` of the item's distinct shingles are among the document's.
Items are partitioned by the size of their shingle set (sizes double from one partition to the next). A partition
whose largest item has u shingles keeps of each item the k = u - ceil(threshold * u) + 1 smallest hashes of its
shingles. If a document lacks fewer than k of an item's shingles, it has one of those k, so a document is compared
only with the items of which it has a sketch hash, and no contained item is missed, however long the document.

The items are a stated query set: they are taken in blocks of bounded size, each broadcast to one pass over all
documents. A pass shuffles nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookfuse.llm.common import window_hashes, word_hashes, words

WIDTH = 5
THRESHOLD = 0.8
#: Characters of benchmark text in one block, and so in one broadcast.
BLOCK_CHARS = 8_000_000


def shingles(found: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``width`` words; the whole sequence if there are fewer."""
    if not found:
        return set()
    return {tuple(found[i : i + width]) for i in range(max(len(found) - width, 0) + 1)}


def _hashes(found: list[bytes], width: int) -> np.ndarray:
    hashes = word_hashes(found)
    if len(found) < width:
        return window_hashes(hashes + np.uint64(len(found)), len(found))
    return window_hashes(hashes, width)


class ItemIndex:
    """Sketches of a block of items, and the items' words for the exact test."""

    def __init__(self, items: list[tuple[int, bytes]], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.items = [(item, words(text)) for item, text in items]
        self.items = [(item, found) for item, found in self.items if found]
        sets = [np.unique(_hashes(found, width)) for _, found in self.items]
        # The least share that counts as reached: of 10 shingles at 0.8, exactly 8.
        sketch, owner = [], []
        for number, own in enumerate(sets):
            largest = 2 ** (int(len(own)).bit_length()) - 1  # of the item's partition
            kept = own[: largest - math.ceil(threshold * largest - 1e-9) + 1]
            sketch.append(kept)
            owner.append(np.full(len(kept), number, np.int64))
        self.sketch = np.concatenate(sketch) if sketch else np.zeros(0, np.uint64)
        order = np.argsort(self.sketch, kind="stable")
        self.sketch = self.sketch[order]
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int64))[order]
        # A byte for each value of the first 16 bits keeps most look-ups from the search.
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.sketch >> np.uint64(48)).astype(np.int64)] = True
        self.exact: dict[int, set] = {}

    def matches(self, text: bytes | None) -> list[tuple[int, int, int]]:
        """(item id, its shingles, those the text has) of the contained items."""
        found = words(text)
        if not found or not len(self.sketch):
            return []
        own = _hashes(found, self.width)
        own = np.unique(own[self.seen[(own >> np.uint64(48)).astype(np.int64)]])
        left, right = np.searchsorted(self.sketch, own, "left"), np.searchsorted(self.sketch, own, "right")
        hit = right > left
        if not hit.any():
            return []
        candidates = np.unique(np.concatenate([self.owner[a:b] for a, b in zip(left[hit], right[hit], strict=True)]))
        mine, out = shingles(found, self.width), []
        for number in candidates.tolist():
            if number not in self.exact:
                self.exact[number] = shingles(self.items[number][1], self.width)
            want = self.exact[number]
            shared = len(want & mine)
            if shared >= self.threshold * len(want) - 1e-9:
                out.append((self.items[number][0], len(want), shared))
        return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of about ``block_chars`` characters, one at a time on the driver."""
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text")
    ).where("item_id is not null and text is not null").distinct()
    block, size = [], 0
    for row in items.toLocalIterator():
        if block and size + len(row.text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row.item_id, bytes(row.text)))
        size += len(row.text)
    if block:
        yield block


def find_contained(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    keep: list[str] | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``keep`` columns of each document (doc_id by default) with matches: item_id, item_shingles, shared, containment.

    Words are lower-cased (A-Z). An item or document with fewer than ``width`` words has one shingle, its whole
    sequence, so a shorter item is found only as a whole document. Null and empty texts match nothing; rows without an
    item_id are no items; equal items each match; an item id with several texts counts once for each text. Repeated
    documents each give their rows. Other columns don't matter, whatever their names. Without items or documents the
    result is empty.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").cast("binary").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema)
    schema = fields + ", item_id bigint, item_shingles bigint, shared bigint"
    sc = docs.sparkSession.sparkContext
    found = None
    for block in _blocks(benchmark, item_id, item_text, block_chars):
        shared = sc.broadcast((block, width, threshold))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*shared.value)
            for batch in batches:
                at, hits = [], []
                for i, value in enumerate(batch.column(len(keep))):
                    for hit in index.matches(value.as_py()):
                        at.append(i)
                        hits.append(hit)
                columns = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:-1]]
                values = np.array(hits, np.int64).reshape(len(hits), 3)
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(values[:, k]) for k in range(3))], names=[*keep, "item_id", "item_shingles", "shared"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` whose text contains no item, as :func:`find_contained` finds them; columns as they are.

    Each row is decided by its own text where it is read; nothing is shuffled. Null and empty texts stay.
    """
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text)
    kept = docs
    for block in _blocks(benchmark, item_id, item_text, block_chars):
        shared = sc.broadcast((block, width, threshold))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*shared.value)
            for batch in batches:
                clean = [not index.matches(x.as_py()) for x in batch.column(at).cast(pa.binary())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
