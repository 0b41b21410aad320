"""Orders over lookup rows: as sort expressions, and as values that compare the same way."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.functions.names import col
from lookfuse.functions.types import family

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_TERM = re.compile(r"^(.+?)(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?$", re.IGNORECASE)


@dataclass(frozen=True)
class OrderTerm:
    """One column of an order. Without a stated NULL place, NULLs come last."""

    column: str
    descending: bool = False
    nulls_first: bool = False

    def sort(self, source: str | None = None) -> Column:
        c = col(source or self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def parse_order(order: str | Sequence[str]) -> list[OrderTerm]:
    """Parse ``["last_login desc nulls last", "id"]``."""
    terms = []
    for text in [order] if isinstance(order, str) else order:
        match = _TERM.match(text.strip())
        if not match:
            raise ValueError(f"Cannot read the order term {text!r}")
        name, direction, nulls = match.groups()
        terms.append(
            OrderTerm(name.strip("` "), (direction or "").lower() == "desc", (nulls or "").lower() == "first")
        )
    return terms


def ascending_values(term: OrderTerm, value: Column, dtype: T.DataType) -> list[Column] | None:
    """Values whose ascending order is the term's order, or None if the type has no such form.

    A running ``min`` has one direction for all its columns, so a descending term is turned round here.
    """
    null_rank = F.when(value.isNull(), F.lit(0 if term.nulls_first else 2)).otherwise(F.lit(1))
    if not term.descending:
        return [null_rank, value]
    kind = family(dtype)
    if kind == "integral":
        return [null_rank, F.bitwise_not(value)]
    if isinstance(dtype, T.DecimalType):
        return [null_rank, -value]
    if kind == "fractional":
        return [null_rank, F.when(F.isnan(value), F.lit(0)).otherwise(F.lit(1)), -value]
    if isinstance(dtype, T.TimestampNTZType):
        return [null_rank, F.expr(_EPOCH) - value]
    if kind == "date-time":
        return [null_rank, -as_number(value, dtype)]
    if isinstance(dtype, T.BooleanType):
        return [null_rank, ~value]
    if kind == "string" and dtype == T.StringType():
        # Complemented hex digits sort the other way; the last letter puts a prefix after its extensions.
        return [null_rank, F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    return None


def as_number(value: Column, dtype: T.DataType) -> Column:
    """A number that grows with the value (not strictly: close values may share one)."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(dtype, T.TimestampNTZType):
        return (value - F.expr(_EPOCH)).cast("interval second").cast("decimal(20,6)").cast("double")
    if isinstance(dtype, T.BooleanType):
        return value.cast("int")
    return value.cast("double")
