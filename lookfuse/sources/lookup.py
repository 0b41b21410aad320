"""Lookup tables: resolving names, and cutting the scan to the keys that are asked for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookfuse.functions.names import NameIndex, col
from lookfuse.functions.types import common_type, has_exact_literals


def resolve_lookup(
    spark: SparkSession,
    table: str | DataFrame,
    *,
    format: str | None = None,
    max_parallel: int | None = None,
    **options: str,
) -> DataFrame:
    """A lookup as a DataFrame.

    ``table`` is a DataFrame, a ``catalog.database.table`` name, or a path. With ``format`` the name or path goes to
    that reader together with ``options`` (billing project, credentials and the like are such options).
    ``max_parallel`` caps how many tasks read it at the same time.
    """
    if isinstance(table, DataFrame):
        found = table
    elif not isinstance(table, str) or not table.strip():
        raise ValueError("The lookup table must be given: a DataFrame, a catalog.database.table name or a path")
    elif format is not None:
        found = spark.read.format(format).options(**options).load(table)
    elif "/" in table:
        found = spark.read.options(**options).load(table)
    elif len(table.split(".")) == 3 and all(table.split(".")):
        found = spark.table(table)
    else:
        raise ValueError(f"Invalid lookup table name {table!r}: expected catalog.database.table or a path")
    if max_parallel is not None:
        if max_parallel < 1:
            raise ValueError("max_parallel must be at least 1")
        found = found.coalesce(max_parallel)
    return found


def scan_lookup(
    lookup: DataFrame, column_names: list[str] | None = None, restriction: str | None = None
) -> DataFrame:
    """The plain scan: named (and renamed) columns of the rows that pass a constant restriction."""
    from lookfuse.functions.columns import output_columns, parse_column_names

    parsed = parse_column_names(column_names)
    rows = lookup.where(restriction) if restriction else lookup
    selected = output_columns(parsed, NameIndex.of(lookup), lookup.columns)
    return rows.select(*[col(source).alias(out) for source, out in selected])


def restrict_to_requests(
    lookup: DataFrame, requests: DataFrame, keys: Mapping[str, str], max_keys: int = 1000
) -> DataFrame:
    """Lookup rows whose key some request has. ``keys`` maps request fields to lookup columns.

    Up to ``max_keys`` values of a single key become a literal list, which a source can apply while it reads; no
    more than that many are ever brought to the driver. More keys, several columns, and types that don't come back
    from Python as they were (timestamps, floats, binary, nested ones) become a semi-join.
    """
    mine, theirs = NameIndex.of(requests), NameIndex.of(lookup)
    names = {}
    for request_field, lookup_column in keys.items():
        if request_field not in mine or lookup_column not in theirs:
            raise ValueError(f"No such key pair: {request_field!r} in requests, {lookup_column!r} in lookup")
        names[mine.find(request_field)] = theirs.find(lookup_column)
    casts = {}
    for m, t in names.items():
        shared = common_type(requests.schema[m].dataType, lookup.schema[t].dataType)
        if shared is None:
            raise ValueError(f"Key {m!r} and lookup column {t!r} have types that are never equal")
        casts[m] = shared
    asked = requests.select(*[col(m).cast(casts[m]).alias(f"__asked{i}") for i, m in enumerate(names)])
    for name in asked.columns:
        asked = asked.where(col(name).isNotNull())
    asked = asked.distinct()
    if len(names) == 1 and has_exact_literals(next(iter(casts.values()))):
        ((mine_, column),) = names.items()
        found = [r[0] for r in asked.limit(max_keys + 1).collect()]
        if len(found) <= max_keys:
            return lookup.where(col(column).cast(casts[mine_]).isin(found))
    condition = F.lit(True)
    for i, (m, t) in enumerate(names.items()):
        condition = condition & (col(t).cast(casts[m]) == col(f"__asked{i}"))
    return lookup.join(asked, condition, "left_semi")
