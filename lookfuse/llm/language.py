"""Language identification by rank order of n-grams.

A language's profile is its ``PROFILE`` most frequent n-grams (of 1 to 3 characters of lower-cased words, each word
with a space on either side) in rank order; so is a document's. The out-of-place distance adds, over the document's
n-grams, how far each stands from its rank in the language's profile, or the profile's length if it isn't there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 400
ORDERS = (1, 2, 3)
#: Characters counted at once; a longer text goes in stretches, whose counts add up to those of the whole.
PIECE = 1 << 20
_BITS = 21
_SPACE = 32


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One count for each gram of several counts."""
    grams, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)


def _letters(codes: np.ndarray, known: dict[int, bool]) -> np.ndarray:
    values, inverse = np.unique(codes, return_inverse=True)
    for v in values.tolist():
        if v not in known:
            known[v] = chr(v).isalpha()
    return np.array([known[v] for v in values.tolist()], bool)[inverse]


class GramCounter:
    """Counts of a text's n-grams as (gram, count), most frequent first, ties by gram. A gram is up to three code points of 21 bits."""

    def __init__(self):
        self.known: dict[int, bool] = {}
        # Letters of the basic plane, looked up without a sort.
        self.table = np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(1 << 16)])

    def grams(self, text: str) -> np.ndarray:
        """All grams of the text; empty without a letter."""
        return np.concatenate([np.zeros(0, np.uint64), *self.pieces(text)])

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """The same in parts, each of a stretch of the text and of the two characters before it."""
        text = text.lower()
        before = np.array([_SPACE], np.uint64)
        for start in range(0, len(text), PIECE):
            codes = np.frombuffer(text[start : start + PIECE].encode("utf-32-le", "replace"), np.uint32)
            low = codes < (1 << 16)
            letter = self.table[np.where(low, codes, 0)]
            if not low.all():
                letter = np.where(low, letter, _letters(codes, self.known))
            # Anything but letters is one space.
            end = [_SPACE] if start + PIECE >= len(text) else []
            spaced = np.concatenate([before, np.where(letter, codes, _SPACE), end]).astype(np.uint64)
            keep = np.ones(len(spaced), bool)
            keep[1:] = (spaced[1:] != _SPACE) | (spaced[:-1] != _SPACE)
            spaced, n = spaced[keep], len(before)
            before = spaced[-2:]
            pairs = (spaced[:-1] << np.uint64(_BITS)) | spaced[1:]
            triples = (pairs[:-1] << np.uint64(_BITS)) | spaced[2:]
            first = max(n - 2, 0)
            middle = spaced[first + 1 : -1] != _SPACE  # no gram across two words
            own = spaced[n:]
            yield np.concatenate([own[own != _SPACE], pairs[n - 1 :], triples[first:][middle]])

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if not text:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(text) <= PIECE:
            return np.unique(self.grams(text), return_counts=True)
        return _summed([np.unique(grams, return_counts=True) for grams in self.pieces(text)])

    def ranked(self, text: str | None, size: int = PROFILE) -> np.ndarray:
        grams, counts = self.count(text)
        return grams[np.lexsort((grams, -counts))[:size]]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """The profile of each language, from every text whose language is known.

    Counts are summed in each task, then over tasks by (language, gram). The driver gets ``size`` grams a language.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")).where("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = GramCounter()
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1)
            for one in dict.fromkeys(langs):
                grams, pending, parts = [], 0, []
                for i in np.flatnonzero(langs == one):
                    for found in counter.pieces(texts[int(i)].as_py()):
                        grams.append(found)
                        pending += len(found)
                        if pending > 4 * PIECE:
                            parts.append(np.unique(np.concatenate(grams), return_counts=True))
                            grams, pending = [], 0
                parts.append(np.unique(np.concatenate([*grams, np.zeros(0, np.uint64)]), return_counts=True))
                values, counts = _summed(parts)
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])

    counts = rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for row in best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("grams")).collect():
        profiles[row.lang] = [g.gram for g in row.grams]
    return dict(sorted(profiles.items()))


class Profiles:
    """Distances to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size, self.langs = size, list(profiles)
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)  # the last row is for unknown grams
        for i, grams in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.grams, np.array(grams, np.uint64)), i] = np.arange(len(grams))
        self.counter = GramCounter()

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and how near: 1 less the distance as a share of the largest that could be."""
        own = self.counter.ranked(text, self.size)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.grams, own)
        at = np.where((at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == own), at, len(self.grams))
        ranks = self.ranks[at]
        away = np.where(ranks >= 0, np.abs(ranks - np.arange(len(own))[:, None]), self.size)
        total = away.sum(0)
        best = int(total.argmin())  # ties go to the first name
        return self.langs[best], float(1 - total[best] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", keep: list[str] | None = None, size: int = PROFILE) -> DataFrame:
    """``keep`` columns (doc_id by default) with lang_pred and score (0 to 1), for every row from its whole text.

    ``und`` and 0 for a null text, one without a letter, or if there are no profiles. Ties go to the first language by
    name. Repeated rows get equal answers; other columns don't matter; an empty table gives an empty result.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema]
    shared = docs.sparkSession.sparkContext.broadcast((profiles, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(*shared.value)
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column(len(keep))]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))
