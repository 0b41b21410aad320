"""The best lookup row in a range, without its pairs: blocks of cells with their best, cells at the ends row by row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import COUNT, HIT, LOOKUP_BOUND, SALT
from lookfuse.functions.names import col
from lookfuse.functions.types import family
from lookfuse.operators.attach import attach
from lookfuse.operators.lookup import Payload, merged
from lookfuse.operators.pairs import matching_pairs
from lookfuse.operators.ranges import Scale
from lookfuse.operators.skew import MAX_PARTS, Splitter, literal_numbers, range_number, range_part

_LOW, _HIGH, _CELL, _LEVEL, _AT = (f"{SALT}_{name}" for name in ("low", "high", "cell", "level", "entry"))
_LOW_IN, _HIGH_IN = f"{_LOW}_in", f"{_HIGH}_in"
_BLOCK = f"{SALT}_block"
_LEVEL_BITS = 6


def best_in_ranges(
    probes: DataFrame,
    probe_keys: Sequence[str],
    lower: str,
    upper: str,
    lookup: DataFrame,
    lookup_keys: Sequence[str],
    test: Column,
    payload: Payload,
    splitter: Splitter,
    raw_probes: DataFrame,
    inner: tuple[str, str] | None = None,
    bound_as: Column | None = None,
) -> DataFrame:
    """The best lookup row, and the number of them, between two bounds of each probe: its columns, HIT, COUNT and the payload.

    For picks by an order no pair has to be made of rows well inside a range. A range is two end cells and the cells between;
    those between are taken apart into blocks of 2**j cells that begin at multiples of their size, at most two a level, and each
    block's best and count are had once, by aggregation. Only rows in end cells are tested. The work of a probe grows with
    the logarithm of its range, however many rows match. ``lookup`` has ``LOOKUP_BOUND``, not NULL, as are the probes' columns.
    Where the test passes everywhere only between the two columns ``inner``, all cells outside these are end cells. ``bound_as``
    is the bound under the name and type that the test has for it.
    """
    scale = Scale.of(
        raw_probes.select(F.explode(F.array(col(lower), col(upper))).alias("value")).unionByName(lookup.select(col(LOOKUP_BOUND).alias("value"))),
        _most(lookup, lookup_keys),
    )
    own = list(probes.columns)
    bounds = {_LOW: col(lower), _HIGH: col(upper)} | ({_LOW_IN: col(inner[0]), _HIGH_IN: col(inner[1])} if inner else {})
    low, high = (_LOW_IN, _HIGH_IN) if inner else (_LOW, _HIGH)
    probes = scale.with_cells(probes, bounds)
    raw = scale.with_cells(raw_probes, bounds)
    keys = [f"{SALT}_key{i}" for i in range(len(lookup_keys))]
    one = F.lit(1).cast("bigint").alias(COUNT)
    # Copies of a value are merged before they meet the probes.
    lookup = lookup.select(*[col(k).alias(n) for k, n in zip(lookup_keys, keys)], col(LOOKUP_BOUND), *payload.minimum_columns(), one)
    lookup = scale.with_cells(merged(lookup, [*keys, LOOKUP_BOUND], payload), {_CELL: col(LOOKUP_BOUND)})
    tested = lookup if bound_as is None else lookup.select("*", bound_as)

    at_ends = F.array(col(_LOW), col(_HIGH))
    if inner:
        first, last = F.least(col(_LOW), col(_HIGH)), F.greatest(col(_LOW), col(_HIGH))
        apart = (first <= col(low)) & (col(low) < col(high)) & (col(high) <= last)
        at_ends = F.when(apart, F.concat(F.sequence(first, col(low)), F.sequence(col(high), last))).otherwise(F.sequence(first, last))
    ends = probes.withColumn(_AT, F.explode(F.array_distinct(at_ends)))
    pairs, _ = matching_pairs(ends, [*probe_keys, _AT], tested, [*keys, _CELL], test, splitter, entered=True)
    found = pairs.select(*[col(c) for c in own], *[col(n) for n in payload.minimum_names()], col(COUNT))

    # Blocks between the end cells, and of the lookup those of the levels that are asked for.
    widest = raw.agg(F.max(col(high) - col(low))).first()[0] or 0
    if widest > 1:
        cells = merged(lookup, [*keys, _CELL], payload)
        level = F.explode(F.array(*[F.lit(j) for j in range((widest - 1).bit_length())])).alias(_LEVEL)
        blocks = cells.select("*", level).withColumn(_CELL, F.call_function("shiftright", col(_CELL), col(_LEVEL)))
        blocks = merged(blocks, [*keys, _LEVEL, _CELL], payload)
        asked = probes.select(*[col(c) for c in own], F.explode(_blocks(low, high)).alias("block")).select(*[col(c) for c in own], F.col("block.level").alias(_LEVEL), F.col("block.cell").alias(_CELL))
        found = found.unionByName(_met(asked, own, probe_keys, blocks, keys, payload, splitter))
    best = merged(found, own, payload)
    return best.select(*[col(c) for c in own], F.lit(True).alias(HIT), col(COUNT), *payload.unpack())


def best_around(
    probes: DataFrame,
    probe_keys: Sequence[str],
    at: str,
    lookup: DataFrame,
    lookup_keys: Sequence[str],
    lower: str,
    upper: str,
    test: Column,
    payload: Payload,
    splitter: Splitter,
    raw_probes: DataFrame,
) -> DataFrame:
    """The best lookup row, and the number of them, whose range from ``lower`` to ``upper`` holds the probe's value ``at``.

    The same with the sides changed: a lookup row is entered in the blocks that make up its range, each block's best and count
    are had by aggregation, and a probe asks for the one block of each level that holds it. Only the two end cells of a row
    are tested. ``lookup`` has both ends, not NULL, as are the probes' columns.
    """
    lookup = lookup.where(col(lower) <= col(upper))
    values = lookup.select(F.explode(F.array(col(lower), col(upper))).alias("value")).unionByName(raw_probes.select(col(at).alias("value")))
    scale = Scale.of(values, _most(probes, probe_keys))
    bounds = {_LOW: col(lower), _HIGH: col(upper)}
    widest = scale.with_cells(lookup, bounds).agg(F.max(col(_HIGH) - col(_LOW))).first()[0] or 0
    own = list(probes.columns)
    keys = [f"{SALT}_key{i}" for i in range(len(lookup_keys))]
    one = F.lit(1).cast("bigint").alias(COUNT)
    best = payload.minimum_names()
    # Copies of a range are merged before they meet the probes.
    lookup = lookup.select(*[col(k).alias(n) for k, n in zip(lookup_keys, keys)], col(lower), col(upper), *payload.minimum_columns(), one)
    lookup = scale.with_cells(merged(lookup, [*keys, lower, upper], payload), bounds)
    probes = scale.with_cells(probes, {_AT: col(at)})

    ends = lookup.withColumn(_CELL, F.explode(F.array_distinct(F.array(col(_LOW), col(_HIGH)))))
    pairs, _ = matching_pairs(probes, [*probe_keys, _AT], ends, [*keys, _CELL], test, splitter, entered=True)
    found = pairs.select(*[col(c) for c in own], *[col(n) for n in best], col(COUNT))
    if widest > 1:
        blocks = lookup.select(*[col(c) for c in [*keys, *best, COUNT]], F.explode(_blocks(_LOW, _HIGH)).alias("block"))
        blocks = blocks.select(*[col(c) for c in [*keys, *best, COUNT]], F.col("block.level").alias(_LEVEL), F.col("block.cell").alias(_CELL))
        blocks = merged(blocks, [*keys, _LEVEL, _CELL], payload)
        level = F.explode(F.array(*[F.lit(j) for j in range((widest - 1).bit_length())])).alias(_LEVEL)
        asked = probes.select("*", level).withColumn(_CELL, F.call_function("shiftright", col(_AT), col(_LEVEL))).drop(_AT)
        found = found.unionByName(_met(asked, own, probe_keys, blocks, keys, payload, splitter))
    picked = merged(found, own, payload)
    return picked.select(*[col(c) for c in own], F.lit(True).alias(HIT), col(COUNT), *payload.unpack())


def few_values(values: DataFrame) -> list[float] | None:
    """The numbers of a one-column DataFrame's different values, in order, if these are few and no other value has one of them."""
    (field,) = values.schema.fields
    kind = field.dataType
    if family(kind) not in ("integral", "fractional", "date-time") or isinstance(kind, T.DecimalType):
        return None
    # Beyond, neighbours share a double; local timestamps are numbered in seconds, others that count in their smallest step.
    exact = math.inf if isinstance(kind, (T.FloatType, T.DoubleType)) else 2**32 if isinstance(kind, T.TimestampNTZType) else 2**53
    found = values.where(col(field.name).isNotNull()).distinct().select(range_number(col(field.name), kind, 0)).limit(MAX_PARTS + 1).collect()
    numbers = sorted({number for (number,) in found if abs(number) < exact})
    return numbers if numbers and len(numbers) == len(found) <= MAX_PARTS else None


def best_around_values(
    probes: DataFrame,
    probe_keys: Sequence[str],
    at: str,
    values: Sequence[float],
    lookup: DataFrame,
    lookup_keys: Sequence[str],
    lower: str,
    lower_op: str,
    upper: str,
    upper_op: str,
    payload: Payload,
) -> DataFrame:
    """The best lookup row whose range holds the probe's value ``at``, one of a few ``values``: the probe's columns, HIT and the payload.

    A cell for each value: ends lie between cells, so no row is tested. As the best of overlapping parts is the best of all, a row is
    entered in two parts of 2**j cells that cover its range, and only the parts' bests, merged where they are read, are taken
    apart into blocks. A key, level and cell has as many probes as there are values at most, so no key is too hot for a task.
    """
    own, best = list(probes.columns), payload.minimum_names()
    keys = [f"{SALT}_key{i}" for i in range(len(lookup_keys))]
    dtype = probes.schema[at].dataType
    one = F.lit(1).cast("bigint")
    # In steps, so that Spark reckons what is used several times once.
    rows = lookup.select(
        *[col(k).alias(n) for k, n in zip(lookup_keys, keys)],
        *payload.minimum_columns(),
        range_number(col(lower), dtype, 0).alias(_LOW),
        range_number(col(upper), dtype, 0).alias(_HIGH),
    )
    low, high = _place(col(_LOW), values, after=lower_op == "<"), _place(col(_HIGH), values, after=upper_op == ">=")
    # Without an end, a range is empty: none below ``high``, or no ``low`` below its end.
    rows = rows.withColumns({_LOW: F.when(col(_LOW).isNull(), F.lit(len(values)).cast("bigint")).otherwise(low), _HIGH: high})
    rows = rows.withColumn(_LEVEL, F.when(col(_HIGH) > col(_LOW), F.length(F.bin(col(_HIGH) - col(_LOW))) - 1))
    rows = rows.withColumn(_AT, col(_HIGH) - F.call_function("shiftleft", one, col(_LEVEL)))

    def entry(start: str) -> Column:
        return F.call_function("shiftleft", col(start), F.lit(_LEVEL_BITS)) + col(_LEVEL)

    entries = F.when(col(_AT) == col(_LOW), F.array(entry(_LOW))).when(col(_AT) > col(_LOW), F.array(entry(_LOW), entry(_AT)))
    parts = rows.select(*[col(c) for c in [*keys, *best]], F.explode(entries).alias(_BLOCK), one.alias(COUNT))
    parts = merged(parts, [_BLOCK, *keys], payload)
    size = F.call_function("shiftleft", one, col(_BLOCK).bitwiseAND((1 << _LEVEL_BITS) - 1).cast("int"))
    start = F.call_function("shiftright", col(_BLOCK), F.lit(_LEVEL_BITS))
    parts = parts.withColumns({_LOW: start - 1, _HIGH: start + size})
    blocks = parts.select(*[col(c) for c in [*keys, *best, COUNT]], F.explode(_blocks(_LOW, _HIGH)).alias("block"))
    blocks = blocks.select(*[col(c) for c in [*keys, *best, COUNT]], F.col("block.level").alias(_LEVEL), F.col("block.cell").alias(_CELL))
    blocks = merged(blocks, [_CELL, _LEVEL, *keys], payload)
    levels = F.explode(F.array(*[F.lit(j) for j in range(len(values).bit_length())])).alias(_LEVEL)
    asked = probes.withColumn(_AT, range_number(col(at), dtype, 0)).withColumn(_AT, _place(col(_AT), values)).select("*", levels)
    asked = asked.withColumn(_CELL, F.call_function("shiftright", col(_AT), col(_LEVEL))).drop(_AT)
    picked = merged(_met(asked, own, probe_keys, blocks, keys, payload, Splitter(False)), own, payload)
    return picked.select(*[col(c) for c in own], F.lit(True).alias(HIT), *payload.unpack())


def _place(number: Column, values: Sequence[float], after: bool = False) -> Column:
    """How many of ``values`` lie below a number, or, with ``after``, not above it."""
    place = F.coalesce(range_part(number, T.DoubleType(), (0, list(values))), F.lit(0))  # never NULL, or joins would test it early
    if after:
        place = place + F.coalesce((F.get(literal_numbers(values), place) == number).cast("int"), F.lit(0))
    return place.cast("bigint")


def _most(df: DataFrame, keys: Sequence[str]) -> int:
    """The rows of the key that has most."""
    return df.groupBy(*[col(k) for k in keys]).count().agg(F.max("count")).first()[0] or 0


def _met(asked: DataFrame, own: Sequence[str], probe_keys: Sequence[str], blocks: DataFrame, keys: Sequence[str], payload: Payload, splitter: Splitter) -> DataFrame:
    """The blocks that probes ask for by key, level and cell, with the probes' ``own`` columns."""
    blocks = blocks.withColumn(HIT, F.lit(True)).withColumnsRenamed({_LEVEL: _AT, _CELL: f"{_AT}_cell"})
    met = attach(asked, [*probe_keys, _LEVEL, _CELL], blocks, [*keys, _AT, f"{_AT}_cell"], splitter, entered=True).where(col(HIT))
    return met.select(*[col(c) for c in own], *[col(n) for n in payload.minimum_names()], col(COUNT))


def _blocks(low: str, high: str) -> Column:
    """(level, cell) of the blocks that make up the cells between ``low`` and ``high``, both left out."""
    levels = F.sequence(F.lit(0), F.greatest(F.length(F.bin(F.greatest(col(high) - col(low), F.lit(0)))), F.lit(1)))

    def of_level(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        first = F.call_function("shiftright", col(low) + size, level)  # the next block's number, rounded up
        end = F.call_function("shiftright", col(high), level)
        left = F.when((first < end) & (first.bitwiseAND(1) == 1), F.struct(level.alias("level"), first.alias("cell")))
        right = F.when((first < end) & (end.bitwiseAND(1) == 1), F.struct(level.alias("level"), (end - 1).alias("cell")))
        return F.array_compact(F.array(left, right))

    return F.flatten(F.transform(levels, of_level))
