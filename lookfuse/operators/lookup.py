"""The lookup side, prepared for matching."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import COUNT, LOOKUP_PREFIX, ORDER_PREFIX
from lookfuse.functions.names import col
from lookfuse.functions.ordering import OrderTerm, ascending_values
from lookfuse.functions.types import is_orderable

BEST = "__best"
BEST_OTHER = "__best_other"


@dataclass(frozen=True)
class Payload:
    """The selected lookup columns, as ``LOOKUP_PREFIX + output name``, and the order that picks a row.

    The order ends with all selected columns that can be sorted, so that the pick does not depend on how the
    data are partitioned.
    """

    schema: T.StructType  # output names
    terms: tuple[OrderTerm, ...] = ()
    term_types: dict[str, T.DataType] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [LOOKUP_PREFIX + n for n in self.schema.names]

    @property
    def order_columns(self) -> list[str]:
        return [ORDER_PREFIX + t.column for t in self.terms]

    def sort_order(self) -> list[Column]:
        return [t.sort(ORDER_PREFIX + t.column) for t in self.terms] + self.tie_break()

    def tie_break(self) -> list[Column]:
        return [
            col(LOOKUP_PREFIX + f.name).asc_nulls_first() for f in self.schema.fields if is_orderable(f.dataType)
        ]

    def row(self) -> Column:
        """The lookup row as a struct of output columns."""
        return F.struct(*[col(LOOKUP_PREFIX + n).alias(n) for n in self.schema.names])

    # The same pick as a mergeable minimum, for aggregates and running windows.

    def can_take_minimum(self) -> bool:
        return self._order_values() is not None

    def minimum_columns(self) -> list[Column]:
        sortable = [f.name for f in self.schema.fields if is_orderable(f.dataType)]
        other = [f.name for f in self.schema.fields if not is_orderable(f.dataType)]
        order = [v.alias(f"o{i}") for i, v in enumerate(self._order_values())]
        best = F.struct(*order, *[col(LOOKUP_PREFIX + n).alias(f"c_{n}") for n in sortable], F.lit(0).alias("end"))
        columns = [best.alias(BEST)]
        if other:
            columns.append(F.struct(*[col(LOOKUP_PREFIX + n).alias(f"c_{n}") for n in other]).alias(BEST_OTHER))
        return columns

    def minimum(self) -> list[tuple[str, Column]]:
        aggregates = [(BEST, F.min(col(BEST)))]
        if self._has_other():
            aggregates.append((BEST_OTHER, F.min_by(col(BEST_OTHER), col(BEST))))
        return aggregates

    def minimum_names(self) -> list[str]:
        return [BEST, BEST_OTHER] if self._has_other() else [BEST]

    def unpack(self) -> list[Column]:
        """Payload columns out of the minimum."""
        return [
            col(BEST if is_orderable(f.dataType) else BEST_OTHER).getField(f"c_{f.name}").alias(LOOKUP_PREFIX + f.name)
            for f in self.schema.fields
        ]

    def _has_other(self) -> bool:
        return any(not is_orderable(f.dataType) for f in self.schema.fields)

    def _order_values(self) -> list[Column] | None:
        values: list[Column] = []
        for term in self.terms:
            encoded = ascending_values(term, col(ORDER_PREFIX + term.column), self.term_types[term.column])
            if encoded is None:
                return None
            values += encoded
        return values


def merged(df: DataFrame, keys: Sequence[str], payload: Payload) -> DataFrame:
    """One row for each key of rows with minimum columns and COUNT: the smallest, and the sum."""
    return df.groupBy(*[col(k) for k in keys]).agg(*[a.alias(n) for n, a in payload.minimum()], F.sum(col(COUNT)).alias(COUNT))


def best_per_key(df: DataFrame, keys: Sequence[str], payload: Payload) -> DataFrame:
    """First row and match count of each key in one aggregation with map-side merging."""
    return (
        df.select(*[col(k) for k in keys], *payload.minimum_columns())
        .groupBy(*[col(k) for k in keys])
        .agg(*[a.alias(n) for n, a in payload.minimum()], F.count("*").alias(COUNT))
        .select(*[col(k) for k in keys], *payload.unpack(), col(COUNT))
    )
