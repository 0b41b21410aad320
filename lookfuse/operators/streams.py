"""Selection from groups that are read as streams: no group is ever an array, however many rows it has."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lookfuse.constants import CHOSEN, COUNT, FIELD_PREFIX, HIT
from lookfuse.functions.names import col
from lookfuse.operators.selectors import StreamSelector

_ROW = "__row"
_NAN = object()
_SENT_ROWS = 1000


def select_from_streams(df: DataFrame, keys: Sequence[str], sort: Sequence[Column], row: Column, selector: StreamSelector, schema: T.StructType) -> DataFrame:
    """Apply the selector to each group's rows in order: ``keys``, HIT, COUNT, CHOSEN.

    Groups are dealt by key and sorted; a task holds a batch of rows and what the selector keeps. A hot key is one
    task's, since the selector has to see its rows one after the other.
    """
    dealt = df.repartition(*[col(k) for k in keys]).sortWithinPartitions(*[col(k) for k in keys], *sort)
    rows = dealt.select(*[col(k) for k in keys], row.alias(_ROW))
    out = T.StructType(
        [
            *[rows.schema[k] for k in keys],
            T.StructField(HIT, T.BooleanType()),
            T.StructField(COUNT, T.LongType()),
            T.StructField(CHOSEN, selector.result_type(schema)),
        ]
    )
    arrow, request_at = to_arrow_schema(out), [i for i, k in enumerate(keys) if k.startswith(FIELD_PREFIX)]
    request_names = [keys[i][len(FIELD_PREFIX) :] for i in request_at]
    pick = selector.picker(schema)
    with_request = selector.with_request

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *values, found in zip(*columns, strict=True):
                yield values, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        # NaN keys are one group, as they are to Spark.
        for _, group in groupby(read(batches), key=lambda r: [_NAN if v != v else v for v in r[0]]):
            values, first = next(group)
            count = 0

            def stream(first=first, group=group) -> Iterator[dict]:
                nonlocal count
                count = 1
                yield first
                for _, found in group:
                    count += 1
                    yield found

            offered = stream()
            request = (dict(zip(request_names, (values[i] for i in request_at))),) if with_request else ()
            chosen = pick(first, offered, *request)
            for _ in offered:  # the rest is counted
                pass
            held.append((*values, True, count, chosen))
            if len(held) >= _SENT_ROWS:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return rows.mapInArrow(run, out)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
