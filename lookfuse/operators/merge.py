"""Request columns and the picked lookup row, put together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import (
    CHOSEN,
    COUNT,
    HIT,
    LOOKUP_PREFIX,
    MATCH_COUNT_COLUMN,
    STATUS_COLUMN,
    STATUS_DECLINED,
    STATUS_NO_MATCH,
    STATUS_SUCCESS,
)
from lookfuse.functions.names import NameIndex, col
from lookfuse.plans.options import ADD_NESTED, OVERWRITE, PAIRS, Options


def merge(joined: DataFrame, request_columns: Sequence[str], schema: T.StructType, options: Options) -> DataFrame:
    """Project a joined row to the output of the chosen mode.

    Whether a request was matched is read from the marker columns, never from data, which may be NULL.
    """
    spark = joined.sparkSession
    hit = col(HIT).isNotNull() & col(HIT)
    chosen = hit & F.coalesce(col(CHOSEN), F.lit(False)) if CHOSEN in joined.columns else hit
    values = {f.name: F.when(chosen, col(LOOKUP_PREFIX + f.name)) for f in schema.fields}
    response = F.when(chosen, F.struct(*[col(LOOKUP_PREFIX + n).alias(n) for n in schema.names]))

    added = []
    if options.with_status:
        status = F.when(~hit, STATUS_NO_MATCH).when(~chosen, STATUS_DECLINED).otherwise(STATUS_SUCCESS)
        added.append(status.alias(STATUS_COLUMN))
    if options.match_count:
        added.append(F.when(hit, col(COUNT)).otherwise(F.lit(0)).cast("bigint").alias(MATCH_COUNT_COLUMN))

    if options.mode == PAIRS:
        request = F.struct(*[col(c).alias(c) for c in request_columns])
        return joined.select(request.alias("request"), response.alias("response"), *added)

    reserved = [n for n, on in ((STATUS_COLUMN, options.with_status), (MATCH_COUNT_COLUMN, options.match_count)) if on]
    reserved_index = NameIndex(reserved, spark)
    own = [c for c in request_columns if c not in reserved_index]
    if options.mode == ADD_NESTED:
        nested = NameIndex([options.nested_key], spark)
        kept = [col(c) for c in own if c not in nested]
        return joined.select(*kept, response.alias(options.nested_key), *added)

    own_index = NameIndex(own, spark)
    lookup_index = NameIndex(schema.names, spark)
    columns = []
    for name in own:
        source = lookup_index.find(name) if options.mode == OVERWRITE else None
        replaced = F.when(chosen, col(LOOKUP_PREFIX + source)).otherwise(col(name)) if source else col(name)
        columns.append(replaced.alias(name))
    fresh = [v.alias(n) for n, v in values.items() if n not in own_index and n not in reserved_index]
    return joined.select(*columns, *fresh, *added)
