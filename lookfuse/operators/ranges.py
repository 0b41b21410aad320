"""Joins of two sides by ranges that meet: a lookup row within a request's range, a range around a request, or two ranges.

A request admits a lookup row if ``lookup.x <= request.a`` and ``lookup.y >= request.b``. Then the range from the smaller to the
larger of x and y meets the one from the smaller to the larger of a and b, whatever the order within the pairs, so rows are
brought together by these ranges and tested afterwards.

Values become cells, finer where there are more values. At level j, 2**j cells are one. Every row has a home level, the lowest
where its range lies in at most two; it is entered there, and at higher levels where the other side has homes. Two
ranges that meet do so at the higher of their homes, in the later of their first cells, and there only. A narrow range therefore
meets few rows that do not match, a wide one is not cut into many pieces, and the join is one on equal columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import SALT
from lookfuse.functions.names import col
from lookfuse.operators.skew import common_prefix, literal_numbers, range_number, range_part

_CUTS = 1024
_CELL_ROWS = 2
_MAX_FINE_BITS = 24
_LOW, _HIGH, _AT = f"{SALT}_low", f"{SALT}_high", f"{SALT}_entries"


@dataclass(frozen=True)
class Range:
    """Two expressions over a side's rows, in either order, and their type."""

    one: Column
    other: Column
    dtype: T.DataType


@dataclass(frozen=True)
class Scale:
    """From values to cells: cut points that share the values out evenly, even steps between them."""

    dtype: T.DataType
    skip: int
    cuts: tuple[float, ...]
    bits: int

    @classmethod
    def of(cls, values: DataFrame, most: int | None = None) -> Scale:
        """For a one-column DataFrame; the driver sees at most ``_CUTS`` numbers and a count.

        Copies of a value lie in one cell however fine it is, so cells follow the number of different values, and ``most``,
        where no key has more rows to be told apart.
        """
        (field,) = values.schema.fields
        skip = common_prefix(values)
        number = range_number(col(field.name), field.dataType, skip)
        shares = literal_numbers(i / _CUTS for i in range(_CUTS + 1))
        found = values.agg(F.percentile_approx(number, shares, F.lit(4 * _CUTS)).alias("cuts"), F.approx_count_distinct(number).alias("n")).first()
        cuts = sorted({c for c in found["cuts"] or [] if math.isfinite(c)})
        wanted = max((found["n"] if most is None else min(found["n"], most)) / _CELL_ROWS, 1)
        cuts = tuple(cuts[:: max(int(len(cuts) / wanted), 1)])
        cells = wanted / max(len(cuts), 1)
        return cls(field.dataType, skip, cuts, min(_MAX_FINE_BITS, math.ceil(math.log2(cells))) if cells > 1 else 0)

    def with_cells(self, df: DataFrame, values: dict[str, Column]) -> DataFrame:
        """Each value's cell, by column name; in steps, so that Spark reckons what is used several times once."""
        if not self.cuts:
            return df.withColumns({name: F.lit(0).cast("bigint") for name in values})
        places = (self.skip, list(self.cuts))
        df = df.withColumns({name: range_part(value, self.dtype, places).cast("bigint") for name, value in values.items()})
        if not self.bits:
            return df
        table, steps = literal_numbers(self.cuts), 1 << self.bits
        ends = {f"{name}_from": F.get(table, (col(name) - 1).cast("int")) for name in values} | {f"{name}_to": F.get(table, col(name).cast("int")) for name in values}
        df = df.withColumns(ends)
        df = df.withColumns(
            {
                f"{name}_share": (range_number(value, self.dtype, self.skip) - col(f"{name}_from")) / (col(f"{name}_to") - col(f"{name}_from"))
                for name, value in values.items()
            }
        )

        def step(name: str) -> Column:
            # Outside the outermost cuts there is no share; NaN is above every number.
            share = col(f"{name}_share")
            inside = F.least(F.floor(share * steps).cast("bigint"), F.lit(steps - 1).cast("bigint"))
            return F.when(share >= 1, F.lit(steps - 1).cast("bigint")).when(share > 0, inside).otherwise(F.lit(0).cast("bigint"))

        df = df.withColumns({name: col(name) * steps + step(name) for name in values})
        return df.drop(*[f"{name}_{part}" for name in values for part in ("from", "to", "share")])


def _with_cells(df: DataFrame, scale: Scale, span: Range) -> DataFrame:
    one, other = f"{SALT}_one", f"{SALT}_other"
    df = scale.with_cells(df, {one: span.one.cast(span.dtype), other: span.other.cast(span.dtype)})
    return df.withColumns({_LOW: F.least(col(one), col(other)), _HIGH: F.greatest(col(one), col(other))}).drop(one, other)


def _home() -> Column:
    """The lowest level at which the range lies in at most two cells."""
    width = col(_HIGH) - col(_LOW)
    return F.when(width <= 1, F.lit(0)).otherwise(F.length(F.bin(width - 1)))


def _entered(df: DataFrame, own: set[int], others: set[int], prefix: str) -> DataFrame:
    """A row for each entry: level, cell, whether it is the home, and the range's first cell at the level."""
    levels = F.array(*[F.lit(level) for level in sorted(own | others)])
    visits = F.array(*[F.lit(level) for level in sorted(others)])
    home = _home()

    def entries(level: Column) -> Column:
        first, last = (F.call_function("shiftright", col(end), level) for end in (_LOW, _HIGH))
        return F.transform(
            F.sequence(first, last),
            lambda cell: F.struct(level.alias("level"), cell.alias("cell"), (level == home).alias("home"), first.alias("first")),
        )

    wanted = F.filter(levels, lambda level: (level == home) | ((level > home) & F.array_contains(visits, level)))
    df = df.withColumn(_AT, F.explode(F.flatten(F.transform(wanted, entries))))
    parts = {f"{prefix}_{name}": col(_AT).getField(name) for name in ("level", "cell", "home", "first")}
    return df.withColumns(parts).drop(_LOW, _HIGH, _AT)


def enter_ranges(
    probes: DataFrame, probe_range: Range, lookup: DataFrame, lookup_range: Range, raw_probes: DataFrame | None = None
) -> tuple[DataFrame, list[str], DataFrame, list[str], Column]:
    """Both sides with their entries, the columns that have to be equal on each, and what else a pair of entries needs.

    Rows with a NULL end are left out. ``raw_probes`` are rows with the probes' columns to take statistics from.
    """
    sides = []
    for df, span in ((probes, probe_range), (lookup, lookup_range), (raw_probes if raw_probes is not None else probes, probe_range)):
        sides.append(df.where(span.one.isNotNull() & span.other.isNotNull()))
    probes, lookup, raw = sides

    def values(df: DataFrame, span: Range) -> DataFrame:
        return df.select(F.explode(F.array(span.one.cast(span.dtype), span.other.cast(span.dtype))).alias("value"))

    scale = Scale.of(values(raw, probe_range).unionByName(values(lookup, lookup_range)))
    probes, lookup, raw = _with_cells(probes, scale, probe_range), _with_cells(lookup, scale, lookup_range), _with_cells(raw, scale, probe_range)
    levels = raw.select(F.lit(0).alias("side"), _home().alias("level")).unionByName(lookup.select(F.lit(1).alias("side"), _home().alias("level")))
    homes = [{0}, {0}]
    for side, level in levels.distinct().collect():
        homes[side].add(level)
    probes = _entered(probes, homes[0], homes[1], f"{SALT}_probe")
    lookup = _entered(lookup, homes[1], homes[0], f"{SALT}_lookup")
    a, b = ({name: f"{SALT}_{side}_{name}" for name in ("level", "cell", "home", "first")} for side in ("probe", "lookup"))
    meet = (col(a["home"]) | col(b["home"])) & (col(a["cell"]) == F.greatest(col(a["first"]), col(b["first"])))
    return probes, [a["level"], a["cell"]], lookup, [b["level"], b["cell"]], meet
