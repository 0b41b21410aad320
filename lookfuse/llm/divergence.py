"""How sources of a language differ in their words: iceberg search for frequent terms, then exact divergences.

Terms are runs of letters (any character from 0x80 on counts as one), A-Z lower-cased. A language keeps the terms that at least
``min_docs`` of its documents hold. They are found by refining byte prefixes: a pass over the documents counts, for each
language, the documents that hold a term of at most the level's length, and those that hold a longer term with such a prefix. A
prefix in too few documents is discarded, since no term with it can be in enough; the next pass extends those that stay
to twice the length, until none stays. Full terms are only ever counted behind a prefix that is frequent
enough, so the long tail of rare words never reaches a shuffle.

Frequent prefixes reach the next pass as a bit array of their hashes, of at most ``MAX_BITS`` bits whatever their number. A clash
of hashes keeps a prefix too many, never drops one; terms are held to the threshold by their exact counts.

Documents without text, lang or source count as having '' there; repeated rows are documents of their own. Other columns are
not read. A language without kept terms has pairs of value 0 and no terms; an empty table gives no rows. Long texts are cut
into terms piece by piece.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.llm.common import stored, term_lists, term_table

MIN_DOCS = 30
TOP = 50
SMOOTHING = 5
SCALE = 1_000_000_000
#: Bytes of the shortest prefix.
FIRST_LENGTH = 6
#: Bits a prefix gets in the filter, and the largest filter (16 MB).
BITS_EACH = 16
MAX_BITS = 1 << 27
#: Bytes of text a task holds before it hands their counts on, texts it takes out of a batch at once, and answers of a filter it remembers.
HELD = 14_000_000
HELD_TEXTS = 1000
REMEMBERED = 500_000
#: Sources compared at once, and the tasks each language's terms are dealt to for that.
SOURCES = 256
SALTS = 64

_TERMS = term_table(digits=False)
_SEED = 42  # of Spark's xxhash64


class PrefixFilter:
    """A bit array of hashes of (lang, prefix)."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, len(bits) * 8 - 1

    @staticmethod
    def of(rows: DataFrame, number: int) -> PrefixFilter:
        """Of ``number`` rows (lang, unit); the driver sees no more than the array."""
        size = min(max(1 << 15, 1 << (max(number, 1) * BITS_EACH - 1).bit_length()), MAX_BITS)
        at = F.xxhash64(F.concat(F.col("lang").cast("binary"), F.lit(b"\x00"), F.col("unit"))).bitwiseAND(F.lit(size - 1).cast("long")) + 1
        sets = rows.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("set"))
        bits = np.zeros(size // 8, np.uint8)
        for part, found in sets.toLocalIterator():
            start = (part - 1) * 4096
            bits[start : start + 4096] = np.frombuffer(found, np.uint8)[: len(bits) - start]
        return PrefixFilter(bits)

    def __call__(self, lang: bytes, unit: bytes) -> bool:
        at = xxhash.xxh64_intdigest(lang + b"\x00" + unit, _SEED) & self.mask
        return bool(self.bits[at >> 3] >> (at & 7) & 1)


class _Known(dict):
    """Answers of a filter for one language, remembered."""

    def __init__(self, test: PrefixFilter, lang: bytes):
        self.test, self.lang = test, lang

    def __missing__(self, unit: bytes) -> bool:
        if len(self) >= REMEMBERED:
            self.clear()
        self[unit] = answer = self.test(self.lang, unit)
        return answer


class _Run:
    """The terms of documents of one language: their names, and each occurrence's name and row by number."""

    def __init__(self, texts: list[bytes]):
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        self.names = coded.dictionary.view(pa.large_binary())
        # Space at the ends of a text leaves an empty name, which is no term.
        self.length = pc.binary_length(self.names).to_numpy()
        self.term = coded.indices.to_numpy()
        self.row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(lists.offsets.to_numpy()))


def _runs(batches: Iterator[pa.RecordBatch], long_text) -> Iterator[tuple[str, _Run, list[tuple]]]:
    """For documents of about ``HELD`` bytes at a time, each language's terms and other columns.

    A text of more than ``HELD`` bytes goes through ``long_text``, which gives another text for it or none.
    """
    langs, held = {}, 0

    def found():
        # What is handed on is let go.
        while langs:
            lang, (texts, rows) = langs.popitem()
            terms = _Run(texts)
            del texts
            yield lang, terms, rows

    for batch in (whole.slice(start, HELD_TEXTS) for whole in batches for start in range(0, whole.num_rows, HELD_TEXTS)):
        for text, lang, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = (text or b"").translate(_TERMS) if len(text or b"") <= HELD else long_text(text, lang, *row)
            texts, rows = langs.setdefault(lang, ([], []))
            texts.append(text)
            rows.append(row)
            held += len(text)
            if held > HELD:
                yield from found()
                held = 0
    yield from found()


def _sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``keys`` and how often each is there."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _distinct(text: bytes, *_) -> bytes:
    return b" ".join({t for terms in term_lists(text, _TERMS) for t in terms})


def _level(shorter: int, length: int, passed):
    """Counts of documents by terms of up to ``length`` bytes and by longer terms' prefixes, behind the prefixes of the level before."""
    schema = pa.schema([("lang", pa.string()), ("unit", pa.binary()), ("whole", pa.bool_()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for lang, found, _ in _runs(batches, _distinct):
            if passed is not None and lang not in known:
                known[lang] = _Known(passed.value, lang.encode())
            taken = found.length > shorter
            if passed is not None:
                # Each prefix of the level before is looked up once.
                alive, prefix = known[lang], pc.binary_slice(found.names, 0, shorter).dictionary_encode()
                passes = np.array([alive[p] for p in prefix.dictionary.to_pylist()], bool)
                taken &= passes[prefix.indices.to_numpy()] if len(passes) else taken
            whole, longer = np.flatnonzero(taken & (found.length <= length)), np.flatnonzero(taken & (found.length > length))
            prefix = pc.binary_slice(found.names.take(pa.array(longer)), 0, length).dictionary_encode()
            number = len(whole) + len(prefix.dictionary)
            unit_of = np.full(len(found.names), -1, np.int64)
            unit_of[whole], unit_of[longer] = np.arange(len(whole)), len(whole) + prefix.indices.to_numpy()
            # A document counts once for a unit, however many of its terms have it.
            unit = unit_of[found.term]
            stays = unit >= 0
            each, _ = _sorted_counts(found.row[stays].astype(np.int64) * max(number, 1) + unit[stays])
            docs = np.bincount(each % max(number, 1), minlength=number)
            names = pa.concat_arrays([found.names.take(pa.array(whole)), prefix.dictionary]).cast(pa.binary())
            columns = [pa.repeat(lang, number), names, pa.array(np.arange(number) < len(whole)), pa.array(docs)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, docs): the terms that at least ``min_docs`` rows of ``docs`` (lang, source, text as bytes) of a language hold."""
    context = docs.sparkSession.sparkContext
    found, shorter, length, passed = [], 0, FIRST_LENGTH, None
    while True:
        counted = docs.select("text", "lang").mapInArrow(_level(shorter, length, passed), "lang string, unit binary, whole boolean, docs long")
        level = stored(counted.groupBy("lang", "unit", "whole").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs), "prefixes")
        found.append(level.where("whole").select("lang", F.col("unit").alias("term"), "docs"))
        prefixes = level.where("not whole")
        number = prefixes.count()
        if passed is not None:
            passed.unpersist()
        if not number:
            break
        passed = context.broadcast(PrefixFilter.of(prefixes, number))
        shorter, length = length, 2 * length
    terms = found[0]
    for more in found[1:]:
        terms = terms.unionByName(more)
    return terms


def _occurrences(passed):
    """Occurrences by (lang, source, term) of the terms the filter knows."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("count", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, long = {}, []

        def alive(lang: str) -> _Known:
            return known.setdefault(lang, _Known(passed.value, lang.encode()))

        def counted(text: bytes, lang: str, source: str) -> bytes:
            # A long text's terms are counted piece by piece, and it leaves none to count with the others'.
            counts = Counter()
            for terms in term_lists(text, _TERMS):
                counts.update(terms)
            kept = {t: c for t, c in counts.items() if alive(lang)[t]}
            n = len(kept)
            long.append(pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array([source] * n), pa.array(kept, pa.binary()), pa.array(kept.values(), pa.int64())], schema=schema))
            return b""

        for lang, found, rows in _runs(batches, counted):
            known_terms = alive(lang)
            kept = np.array([bool(name) and known_terms[name] for name in found.names.to_pylist()], bool)
            if not kept.any():
                continue
            sources = {}
            of = np.array([sources.setdefault(row[0], len(sources)) for row in rows], np.int64)
            stays = kept[found.term]
            cells, counts = _sorted_counts(of[found.row[stays]] * len(kept) + found.term[stays])
            source = pa.array(list(sources), pa.string()).take(pa.array(cells // len(kept)))
            term = found.names.take(pa.array(cells % len(kept))).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(cells)), source, term, pa.array(counts)], schema=schema)
            yield from long
            long.clear()
        yield from long

    return run


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over terms of |p - q| for the pairs of two blocks of sources.

    Rows come by (lang, block a, block b, salt): first the sources' numbers with their p of an absent term, then for each term
    the numbers of the sources that have it and their p. A block's sums are one matrix.
    """
    schema = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])
    key, numbers, base, split, sums, waiting = None, None, None, 0, None, []

    def settle() -> None:
        nonlocal waiting
        if waiting:
            dense = np.repeat(base[None, :], len(waiting), 0)
            for row, (at, p) in enumerate(waiting):
                dense[row, at] = p
            left, right = dense[:, :split], dense[:, split:] if split < len(base) else dense
            for i in range(split):
                sums[i] += np.abs(right - left[:, i : i + 1]).sum(0)
        waiting = []

    def rows() -> pa.RecordBatch:
        settle()
        right = numbers[split:] if split < len(numbers) else numbers
        a, b = np.repeat(numbers[:split], len(right)), np.tile(right, split)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(sums.ravel())], schema=schema)

    for batch in batches:
        langs, block_a, block_b, salts = (batch.column(i).to_pylist() for i in range(4))
        firsts = batch.column(4).to_pylist()
        cells = batch.column(5)
        ends = cells.offsets.to_numpy()
        values = cells.values
        at_all, p_all = values.field(0).to_numpy(), values.field(1).to_numpy()
        for i, found in enumerate(zip(langs, block_a, block_b, salts, strict=True)):
            at, p = at_all[ends[i] : ends[i + 1]], p_all[ends[i] : ends[i + 1]]
            if firsts[i]:
                if key is not None:
                    yield rows()
                key, order = found, np.lexsort((at, at // SOURCES != found[1]))
                numbers, base = at[order], p[order].astype(np.int64)
                split = int((numbers // SOURCES == found[1]).sum())
                sums = np.zeros((split, len(base) - split if split < len(base) else split), np.int64)
                place = {int(n): k for k, n in enumerate(numbers)}
                continue
            waiting.append(([place[int(n)] for n in at], p))
            if len(waiting) >= 256:
                settle()
    if key is not None:
        yield rows()


def _share(count: str, total: str, terms: str):
    """p = 1 + floor(SCALE * (count + 5) / (total + 5 * terms)) in exact decimals."""
    return F.expr(f"1 + (cast({SCALE} as decimal(11,0)) * cast({count} + {SMOOTHING} as decimal(20,0))) div cast({total} + {SMOOTHING} * {terms} as decimal(20,0))")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others, and its most typical terms.

    ``part`` 'pair': ``item`` is another source of the language, ``value`` the sum over all kept terms of the distance of their
    shares, all ranks. 'term': ``item`` is a kept term of the source that is commoner there than in the language, ``value`` by how
    much, the ``top`` first. Ranks are by value, then by item.
    """
    docs = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    terms = stored(kept_terms(docs, min_docs), "terms")
    units = terms.select("lang", F.col("term").alias("unit"))
    passed = docs.sparkSession.sparkContext.broadcast(PrefixFilter.of(units, units.count()))
    counted = docs.select("text", "lang", "source").mapInArrow(_occurrences(passed), "lang string, source string, term binary, count long")
    counts = counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"))
    counts = stored(counts.join(terms.select("lang", "term"), ["lang", "term"], "left_semi"), "occurrences")

    sizes = counts.groupBy("lang", "source").agg(F.sum("count").alias("size"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("kept", F.lit(0)).alias("kept"), number.alias("number"))
    groups = stored(groups, "groups")

    sized = counts.join(groups, ["lang", "source"]).withColumn("p", _share("count", "size", "kept"))
    whole = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    totals = groups.groupBy("lang").agg(F.sum("size").alias("lang_size"))

    # Terms: those above the language's share.
    above = sized.join(whole.join(totals, "lang"), ["lang", "term"]).withColumn("value", F.col("p") - _share("lang_count", "lang_size", "kept")).where("value > 0")
    typical = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    typical = typical.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # Pairs: every term's shares are compared in blocks of sources, the terms of a language dealt to many tasks.
    def cell(p):
        return F.collect_list(F.struct("number", p.alias("p")))

    blocks = F.expr(f"flatten(transform(sequence(0, n div {SOURCES}), a -> transform(sequence(a, n div {SOURCES}), b -> struct(a, b))))")
    inside = f"filter(cells, c -> c.number div {SOURCES} = a or c.number div {SOURCES} = b)"
    last = groups.where("kept > 0").groupBy("lang").agg(F.max("number").alias("n"), cell(_share("0", "size", "kept")).alias("cells")).where("n > 0")
    first = last.select("lang", F.explode(blocks).alias("at"), "cells").select("lang", F.col("at.a").cast("int").alias("a"), F.col("at.b").cast("int").alias("b"), "cells")
    first = first.select("lang", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("first"), F.expr(inside).alias("cells"))
    shares = sized.groupBy("lang", "term").agg(cell(F.col("p")).alias("cells")).join(last.select("lang", "n"), "lang")
    shares = shares.select("lang", F.explode(blocks).alias("at"), "cells", F.pmod(F.hash("term"), F.lit(SALTS)).alias("salt"))
    shares = shares.select("lang", F.col("at.a").cast("int").alias("a"), F.col("at.b").cast("int").alias("b"), "salt", F.lit(False).alias("first"), "cells")
    shares = shares.select("lang", "a", "b", "salt", "first", F.expr(inside).alias("cells"))
    dealt = first.unionByName(shares).repartition("lang", "a", "b", "salt").sortWithinPartitions("lang", "a", "b", "salt", F.desc("first"))
    sums = dealt.mapInArrow(_pair_sums, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")).distinct()
    named = groups.select("lang", "source", "kept", F.col("number").alias("a"))
    pairs = named.join(groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b")), "lang").where("a <> b")
    pairs = pairs.join(both, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("kept") > 0, F.col("value")).otherwise(0).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(typical)
