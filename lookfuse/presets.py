"""Two ready-made forms: a keyed enrichment of rows, and a handler that answers requests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from lookfuse.functions.keys import cache_key, row_key
from lookfuse.plans.enrich import build
from lookfuse.plans.options import ADD_NESTED, CONDITION_VALUES, MERGE_NEW, PAIRS, Options
from lookfuse.sources.lookup import resolve_lookup


def _exactly_one_restriction(template, fn) -> None:
    if bool(template) == bool(fn):
        raise ValueError("Give exactly one of `row_restriction_template` or `row_restriction_template_fn`")


def _exactly_one_source(fields, condition_value_fn) -> None:
    if bool(fields) == bool(condition_value_fn):
        raise ValueError("Give exactly one of `fields` or `condition_value_fn`")


@dataclass(frozen=True)
class KeyedEnrichment:
    """Rows in, enriched rows out: ``requests.transform(KeyedEnrichment(...))``.

    One key; requests without it are dropped, unmatched ones are kept and say so in the status column. ``more`` has
    further options of :func:`lookfuse.enrich` (representative, duplicates, scope, pushdown_keys, split and so on).
    """

    table_name: str | DataFrame
    join_key_field: str
    row_restriction_template: str | None = None
    row_restriction_template_fn: Callable[..., Any] | None = None
    fields: Sequence[str] | None = None
    additional_condition_fields: Sequence[str] | None = None
    column_names: Sequence[str] | None = None
    condition_value_fn: Callable[..., dict] | None = None
    select: Any = "first"
    enrichment_mode: str = MERGE_NEW
    nested_key: str | None = None
    reader: dict = field(default_factory=dict)
    more: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.join_key_field:
            raise ValueError("`join_key_field` must be given")
        if self.table_name is None or self.table_name == "":
            raise ValueError("`table_name` must be given")
        _exactly_one_restriction(self.row_restriction_template, self.row_restriction_template_fn)
        _exactly_one_source(self.fields, self.condition_value_fn)
        if self.enrichment_mode not in (MERGE_NEW, ADD_NESTED):
            raise ValueError(f"Invalid enrichment_mode {self.enrichment_mode!r}")
        self.options()

    def options(self) -> Options:
        return Options(
            join_key=self.join_key_field,
            restriction=self.row_restriction_template or self.row_restriction_template_fn,
            fields=self.fields,
            additional_condition_fields=self.additional_condition_fields,
            condition_value_fn=self.condition_value_fn,
            column_names=self.column_names,
            select=self.select,
            mode=self.enrichment_mode,
            nested_key=self.nested_key,
            **self.more,
        )

    def __call__(self, requests: DataFrame) -> DataFrame:
        return build(requests, resolve_lookup(requests.sparkSession, self.table_name, **self.reader), self.options())


@dataclass(frozen=True)
class LookupHandler:
    """Answers requests with (request, response) pairs; the response is NULL where nothing matched.

    The key is all ``fields``, or the values of ``condition_value_fn``. With ``by_key=False`` the restriction
    alone decides, as for single requests; ``allow_theta=False`` then refuses one without an equality. ``more`` has
    further options of :func:`lookfuse.enrich`.
    """

    table_name: str | DataFrame
    row_restriction_template: str | None = None
    row_restriction_template_fn: Callable[..., Any] | None = None
    fields: Sequence[str] | None = None
    additional_condition_fields: Sequence[str] | None = None
    column_names: Sequence[str] | None = None
    condition_value_fn: Callable[..., dict] | None = None
    latest_value_selector: Any = "first"
    primary_keys: Sequence[str] | None = None
    by_key: bool = True
    max_parallel_streams: int | None = None
    allow_theta: bool | None = None
    reader: dict = field(default_factory=dict)
    more: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.table_name is None or self.table_name == "":
            raise ValueError("`table_name` must be given")
        _exactly_one_restriction(self.row_restriction_template, self.row_restriction_template_fn)
        _exactly_one_source(self.fields, self.condition_value_fn)
        self.options()

    def options(self, mode: str = PAIRS) -> Options:
        keys = None
        if self.by_key:
            keys = list(self.fields) if self.fields else CONDITION_VALUES
        return Options(
            keys=keys,
            restriction=self.row_restriction_template or self.row_restriction_template_fn,
            fields=self.fields,
            additional_condition_fields=self.additional_condition_fields,
            condition_value_fn=self.condition_value_fn,
            primary_keys=self.primary_keys,
            column_names=self.column_names,
            select=self.latest_value_selector,
            mode=mode,
            allow_theta=not self.by_key if self.allow_theta is None else self.allow_theta,
            **{"null_keys": "keep", **self.more},
        )

    def __call__(self, requests: DataFrame, mode: str = PAIRS) -> DataFrame:
        lookup = resolve_lookup(
            requests.sparkSession, self.table_name, max_parallel=self.max_parallel_streams or None, **self.reader
        )
        return build(requests, lookup, self.options(mode))

    def row_key(self, requests: DataFrame) -> Column:
        return row_key(requests, self.fields, self.condition_value_fn)

    def cache_key(self, requests: DataFrame) -> Column:
        return cache_key(requests, self.fields, self.condition_value_fn)
