"""Range lookups without pairs: the best lookup row on one side of each request's bound.

For ``lookup.x <= request.b`` (or ``<``, ``>=``, ``>``) beside equal keys, both sides are put into one sorted
run for each key; the answer for a request is the running minimum of the lookup rows before it. The work is one
shuffle and one sort of the two inputs, while joining on the key would test requests times lookup rows for each
key. It serves any pick order, as-of picks among them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookfuse.constants import COUNT, HIT, LOOKUP_BOUND
from lookfuse.functions.names import col
from lookfuse.operators.lookup import Payload, merged
from lookfuse.operators.skew import Splitter, find_hot_keys, key_hash, range_cuts, range_part

_AT = "__at"
_FROM, _TO = "__from", "__to"
_SIDE = "__side"
_PART = "__part"
_REQUEST = "__request"
_CARRIED, _LOOKUP_INCLUDED, _ASKING, _LOOKUP_EXCLUDED = -1, 0, 1, 2


def pick_by_bound(
    requests: DataFrame,
    request_keys: Sequence[str],
    bound: str,
    op: str,
    lookup: DataFrame,
    lookup_keys: Sequence[str],
    payload: Payload,
    splitter: Splitter,
    undistinct: DataFrame | None = None,
) -> DataFrame:
    """All columns of ``requests`` plus HIT, COUNT and the payload columns.

    ``lookup`` holds its keys, ``LOOKUP_BOUND`` and the payload and order columns, all keys and bounds
    non-NULL and of the types of the request side. With splitting on, request bounds have to be non-NULL too,
    and requests distinct; ``undistinct`` are the rows they come from, for key statistics without a shuffle.
    """
    keys = [f"__key{i}" for i in range(len(lookup_keys))]
    ascending = op in ("<", "<=")
    lookup_side = _LOOKUP_INCLUDED if "=" in op else _LOOKUP_EXCLUDED

    candidates = lookup.select(
        *[col(k).alias(n) for k, n in zip(lookup_keys, keys)],
        col(LOOKUP_BOUND).alias(_AT),
        *payload.minimum_columns(),
        F.lit(1).cast("bigint").alias(COUNT),
    )
    asking = requests.select(
        *[col(k).alias(n) for k, n in zip(request_keys, keys)],
        col(bound).alias(_AT),
        F.struct(*[col(c) for c in requests.columns]).alias(_REQUEST),
    )
    part = F.lit(0)
    carried = None
    if splitter.enabled:
        raw = candidates.select(*keys, _AT).unionByName(
            (requests if undistinct is None else undistinct).select(
                *[col(k).alias(n) for k, n in zip(request_keys, keys)], col(bound).alias(_AT)
            )
        )
        # Copies of a lookup row are merged before they meet in one task.
        candidates = merged(candidates, [*keys, _AT], payload)
        part, carried = _split_hot_keys(candidates, raw, keys, payload, ascending, splitter)

    run = (
        candidates.select("*", part.alias(_PART), F.lit(lookup_side).alias(_SIDE))
        .unionByName(
            asking.select("*", part.alias(_PART), F.lit(_ASKING).alias(_SIDE)), allowMissingColumns=True
        )
    )
    if carried is not None:
        run = run.unionByName(carried, allowMissingColumns=True)
    at = col(_AT).asc_nulls_first() if ascending else col(_AT).desc_nulls_first()
    window = (
        Window.partitionBy(*[col(k) for k in keys], col(_PART))
        .orderBy(at, col(_SIDE))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = run.select(
        _SIDE,
        _REQUEST,
        *[a.over(window).alias(n) for n, a in payload.minimum()],
        F.sum(col(COUNT)).over(window).alias(COUNT),
    )
    return before.where(col(_SIDE) == _ASKING).select(
        *[col(_REQUEST).getField(c).alias(c) for c in requests.columns],
        F.when(col(payload.minimum_names()[0]).isNotNull(), F.lit(True)).alias(HIT),
        F.coalesce(col(COUNT), F.lit(0)).alias(COUNT),
        *payload.unpack(),
    )


def best_intervals(lookup: DataFrame, lookup_keys: Sequence[str], op: str, payload: Payload) -> DataFrame:
    """The same answers as a table: for each key, ranges of the bound with the best lookup row for each.

    A request's bound lies in at most one range of its key (:func:`in_interval`). Where this table can be broadcast,
    requests are answered as they are read, without a shuffle.
    """
    ascending = op in ("<", "<=")
    candidates = merged(
        lookup.select(
            *[col(k) for k in lookup_keys],
            col(LOOKUP_BOUND),
            *payload.minimum_columns(),
            F.lit(1).cast("bigint").alias(COUNT),
        ),
        [*lookup_keys, LOOKUP_BOUND],
        payload,
    )
    order = col(LOOKUP_BOUND).asc() if ascending else col(LOOKUP_BOUND).desc()
    run = Window.partitionBy(*[col(k) for k in lookup_keys]).orderBy(order)
    before = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return candidates.select(
        *[col(k) for k in lookup_keys],
        col(LOOKUP_BOUND).alias(_FROM),
        F.lead(col(LOOKUP_BOUND)).over(run).alias(_TO),
        *[a.over(before).alias(n) for n, a in payload.minimum()],
        F.sum(col(COUNT)).over(before).alias(COUNT),
    ).select(
        *[col(k) for k in lookup_keys], _FROM, _TO, F.lit(True).alias(HIT), col(COUNT), *payload.unpack()
    )


def in_interval(bound: str, op: str) -> Column:
    """Whether a request's bound lies in a range of :func:`best_intervals`."""
    value, start, end = col(bound), col(_FROM), col(_TO)
    started, ended = {
        "<=": (start <= value, end <= value),
        "<": (start < value, end < value),
        ">=": (start >= value, end >= value),
        ">": (start > value, end > value),
    }[op]
    return started & (end.isNull() | ~ended)


def _split_hot_keys(
    candidates: DataFrame,
    raw: DataFrame,
    keys: Sequence[str],
    payload: Payload,
    ascending: bool,
    splitter: Splitter,
) -> tuple[Column, DataFrame | None]:
    """Cut each hot key's run at even points of the range column.

    Every part is a run of its own; a carried row at its start stands for all lookup rows of the parts before.
    Carried rows exist for hot keys only, one for each part.
    """
    hot = find_hot_keys(raw.select(key_hash(keys).alias("h")), splitter)
    if not hot:
        return F.lit(0), None
    cuts = range_cuts(raw.where(hot.has(keys)).select(_AT), splitter.parts)
    fine_parts = len(cuts[1]) + 1
    fine = range_part(col(_AT), raw.schema[_AT].dataType, cuts)
    parts = F.least(hot.parts(keys), F.lit(fine_parts))
    # A key with fewer parts than there are cuts joins neighbours.
    part = F.when(parts > 1, F.floor(fine.cast("bigint") * parts / F.lit(fine_parts)).cast("int")).otherwise(F.lit(0))

    sums = merged(candidates.where(hot.has(keys)).withColumn(_PART, part), [*keys, _PART], payload)
    every_part = (
        sums.select(*keys)
        .distinct()
        .select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias(_PART))
    )
    sums = merged(sums.unionByName(every_part, allowMissingColumns=True), [*keys, _PART], payload)
    order = col(_PART).asc() if ascending else col(_PART).desc()
    earlier = (
        Window.partitionBy(*[col(k) for k in keys]).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = sums.select(
        *keys,
        _PART,
        *[a.over(earlier).alias(n) for n, a in payload.minimum()],
        F.sum(col(COUNT)).over(earlier).alias(COUNT),
        F.lit(_CARRIED).alias(_SIDE),
    ).where(col(payload.minimum_names()[0]).isNotNull())
    return part, carried
