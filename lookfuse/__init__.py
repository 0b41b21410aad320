"""Enrich rows from large lookup tables with Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lookfuse.functions.keys import cache_key, row_key
from lookfuse.operators.collect import group_rows
from lookfuse.operators.selectors import ColumnSelector, PythonSelector, StreamSelector
from lookfuse.plans.enrich import build
from lookfuse.plans.options import Options
from lookfuse.presets import KeyedEnrichment, LookupHandler
from lookfuse.session import scratch_folder, session
from lookfuse.sources.bucketed import open_lookup, store_lookup
from lookfuse.sources.lookup import resolve_lookup, restrict_to_requests, scan_lookup
from lookfuse.sources.requests import Flush, requests_from_files, requests_from_rows
from lookfuse.streaming.sink import read_sink
from lookfuse.streaming.stream import enrich_stream

__all__ = [
    "ColumnSelector",
    "Flush",
    "KeyedEnrichment",
    "LookupHandler",
    "PythonSelector",
    "StreamSelector",
    "cache_key",
    "enrich",
    "enrich_stream",
    "group_rows",
    "open_lookup",
    "read_sink",
    "requests_from_files",
    "requests_from_rows",
    "resolve_lookup",
    "restrict_to_requests",
    "row_key",
    "scan_lookup",
    "scratch_folder",
    "session",
    "store_lookup",
]


def enrich(requests: DataFrame, lookup: DataFrame | str, **options) -> DataFrame:
    """Add to each request the columns of one matching lookup row.

    Matching
        ``join_key``: the request field to match on; through ``column_names=["id as user_id"]`` it may have
        another name in the lookup. ``keys``: several fields, a dict of request field to lookup column, or
        ``"condition_values"`` (the values of ``condition_value_fn``, computed on both sides).
        ``cast_keys``: ``{key: type}`` to compare keys of different types; failing casts match nothing.
        ``restriction``: a template such as ``"status = 'open' AND ts <= '{ts}'"`` over lookup columns and
        condition values; a function ``fn(values, row)`` or ``fn(values, primary_keys, row)``, called once with
        columns, that returns a Column, a template, a ``(column, operator, value)`` tuple or a list of these; or a
        dict of templates, of which the field ``template_id`` names each request's own.
        ``fields`` and ``additional_condition_fields``, or ``condition_value_fn(row) -> {name: Column}``: where
        the values come from. A NULL value leaves the request unmatched, except with a function and ``fields``.
        ``allow_theta``: permit a restriction without any equality.
        ``scope="any_request"``: a lookup row counts if any request's restriction admits it, and is attached by
        the keys alone. ``representative=[order]``: the first request of a key asks for all of them.
        ``duplicates="first"`` with ``request_order``: only the first request of a key is answered.
        ``null_keys``: ``"drop"`` or ``"keep"`` requests with a NULL key.

    Picking
        ``select``: ``"first"``; an order such as ``["ts desc", "id"]``; a function of an array column (and the
        request struct) or a :class:`ColumnSelector`; a :class:`PythonSelector`, or a :class:`StreamSelector` for groups of any size. Names are output names.

    Output
        ``column_names``: lookup columns with optional aliases; all by default. ``primary_keys`` are added.
        ``mode``: ``"merge_new"`` (request wins), ``"overwrite"`` (lookup wins), ``"add_nested"`` under
        ``nested_key``, or ``"pairs"``. ``status`` and ``match_count`` switch the two extra columns.

    Scale
        ``split``: ``"auto"`` splits hot keys when the inputs are larger than one task should hold, which reads
        key statistics when the plan is built; ``True`` and ``False`` force it.
        ``semi_reduce``: cut the lookup to requested keys before reducing it; ``"auto"`` does so when the keys
        are small enough to be broadcast and the lookup is not; ``"bloom"`` by a filter of bounded size that drops
        rows at the scan, for keys too many to be broadcast.
        ``pushdown_keys``: send the keys to the lookup's source as a literal list if there are at most this many.

    Plans for large inputs read their sources once for the result and, narrowly, for key statistics; store
    requests that are expensive to compute, or say ``split=False``.
    """
    return build(requests, resolve_lookup(requests.sparkSession, lookup), Options(**options))
