"""Reductions of the request side: representatives, first of duplicates, distinct probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookfuse.functions.names import col
from lookfuse.functions.ordering import parse_order
from lookfuse.functions.types import is_orderable
from lookfuse.operators.skew import Splitter, spread

_PART = "__part"
_LOCAL = "__local"
_RANK = "__rank"


def total_order(df: DataFrame, order: Sequence[str]):
    """The caller's order, ended with all sortable columns."""
    rest = [col(f.name).asc_nulls_first() for f in df.schema.fields if is_orderable(f.dataType)]
    return [t.sort() for t in parse_order(order)] + rest


def mark_first(df: DataFrame, keys: Sequence[str], sort, name: str, splitter: Splitter) -> DataFrame:
    """Add a column that is true for exactly one row of each key, the first one.

    With splitting on, rows are ranked within parts of a key first; only the first row of each part goes on
    to the ranking of the whole key.
    """
    parts = splitter.parts if splitter.enabled else 1
    df = df.withColumn(_PART, spread(df, F.lit(parts)) if parts > 1 else F.lit(0))
    if parts > 1:
        local = Window.partitionBy(*[col(k) for k in keys], col(_PART)).orderBy(*sort)
        df = df.withColumn(_LOCAL, F.row_number().over(local) == 1)
        # Losers keep a part of their own, so a hot key's rows do not meet in one task.
        df = df.withColumn(_PART, F.when(col(_LOCAL), F.lit(-1)).otherwise(col(_PART)))
    else:
        df = df.withColumn(_LOCAL, F.lit(True))
    window = Window.partitionBy(*[col(k) for k in keys], col(_PART)).orderBy(*sort)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .withColumn(name, col(_LOCAL) & (col(_RANK) == 1))
        .drop(_PART, _LOCAL, _RANK)
    )


def distinct_probes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each combination of probe values once, merged on the map side before the shuffle."""
    return df.select(*[col(c) for c in columns]).distinct()
