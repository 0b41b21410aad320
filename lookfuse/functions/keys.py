"""Row keys and cache keys of requests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.constants import INVALID_CACHE_KEY
from lookfuse.functions.names import NameIndex, col
from lookfuse.functions.rows import ColumnRow


def key_columns(
    df: DataFrame,
    fields: Sequence[str] | None = None,
    condition_value_fn: Callable[[ColumnRow], dict[str, Column]] | None = None,
) -> dict[str, Column]:
    """Key parts by name, in name order; a field the rows do not have is NULL."""
    if bool(fields) == bool(condition_value_fn):
        raise ValueError("Give exactly one of `fields` or `condition_value_fn`")
    if condition_value_fn:
        parts = condition_value_fn(ColumnRow(df.columns, col)) or {}
    else:
        index = NameIndex.of(df)
        parts = {f: col(index.find(f)) if f in index else F.lit(None).cast("string") for f in fields}
    return dict(sorted(parts.items()))


def row_key(df: DataFrame, fields=None, condition_value_fn=None) -> Column:
    """The key as a struct of its parts; NULL when there is none.

    A NULL field means no key. Parts from a ``condition_value_fn`` are taken as they are.
    """
    parts = key_columns(df, fields, condition_value_fn)
    if not parts:
        return F.lit(None).cast("struct<>")
    key = F.struct(*[c.alias(n) for n, c in parts.items()])
    if condition_value_fn:
        return key
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in parts.values()]), key)


def cache_key(df: DataFrame, fields=None, condition_value_fn=None) -> Column:
    """The key as JSON text, or a fixed text for a row without a key."""
    if not key_columns(df, fields, condition_value_fn):
        return F.lit(INVALID_CACHE_KEY)
    text = F.to_json(row_key(df, fields, condition_value_fn), {"ignoreNullFields": "false"})
    return F.coalesce(text, F.lit(INVALID_CACHE_KEY))
