"""Options of an enrichment, checked when the plan is built."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from lookfuse.constants import RESERVED_PREFIXES

MERGE_NEW = "merge_new"
ADD_NESTED = "add_nested"
OVERWRITE = "overwrite"
PAIRS = "pairs"
MODES = (MERGE_NEW, ADD_NESTED, OVERWRITE, PAIRS)
CONDITION_VALUES = "condition_values"


@dataclass(frozen=True)
class Options:
    """See :func:`lookfuse.enrich` for the meaning of each."""

    join_key: str | None = None
    keys: Sequence[str] | Mapping[str, str] | str | None = None
    restriction: str | Callable[..., Any] | Mapping[Any, str] | None = None
    template_id: str | None = None
    fields: Sequence[str] | None = None
    additional_condition_fields: Sequence[str] | None = None
    condition_value_fn: Callable[..., dict] | None = None
    primary_keys: Sequence[str] | None = None
    column_names: Sequence[str] | None = None
    select: Any = "first"
    mode: str = MERGE_NEW
    nested_key: str | None = None
    null_keys: str = "drop"
    scope: str = "own_request"
    representative: Sequence[str] | None = None
    duplicates: str = "all"
    request_order: Sequence[str] | None = None
    allow_theta: bool = False
    cast_keys: Mapping[str, str] | None = None
    status: bool | None = None
    match_count: bool = False
    semi_reduce: bool | str = "auto"
    pushdown_keys: int = 0
    split: bool | str = "auto"

    def __post_init__(self):
        _one_of("mode", self.mode, MODES)
        _one_of("null_keys", self.null_keys, ("drop", "keep"))
        _one_of("scope", self.scope, ("own_request", "any_request"))
        _one_of("duplicates", self.duplicates, ("all", "first"))
        _one_of("semi_reduce", self.semi_reduce, ("auto", True, False, "bloom"))
        _one_of("split", self.split, ("auto", True, False))
        if self.pushdown_keys < 0:
            raise ValueError("`pushdown_keys` is the largest number of keys sent to the source, or 0")
        if self.mode == ADD_NESTED and not self.nested_key:
            raise ValueError("`nested_key` must be given with mode 'add_nested'")
        if self.join_key is not None and self.keys is not None:
            raise ValueError("Give `join_key` or `keys`, not both")
        if isinstance(self.keys, str) and self.keys != CONDITION_VALUES:
            raise ValueError(f"`keys` is a list, a dict or {CONDITION_VALUES!r}; use `join_key` for one name")
        if self.keys == CONDITION_VALUES and not self.condition_value_fn:
            raise ValueError("Keys from condition values need a `condition_value_fn`")
        if not self.has_keys and self.restriction is None:
            raise ValueError("Give a `join_key`, `keys` or a `restriction`")
        if self.fields and self.condition_value_fn:
            raise ValueError("Give exactly one of `fields` or `condition_value_fn`")
        if self.restriction is not None and not (self.fields or self.condition_value_fn):
            raise ValueError("A `restriction` needs exactly one of `fields` or `condition_value_fn`")
        if self.additional_condition_fields and self.condition_value_fn:
            raise ValueError("A `condition_value_fn` supplies all condition values, so `additional_condition_fields` has no use beside it")
        if isinstance(self.restriction, str) and not self.restriction.strip():
            raise ValueError("The restriction template is empty")
        if isinstance(self.restriction, Mapping):
            if not self.restriction or not self.template_id:
                raise ValueError("A choice of templates needs templates and a `template_id` column")
        elif self.template_id:
            raise ValueError("`template_id` needs a dict of templates as `restriction`")
        if self.scope == "any_request" and not (self.has_keys and self.restriction is not None):
            raise ValueError("scope='any_request' needs keys and a restriction")
        if self.representative is not None and not self.representative:
            raise ValueError("`representative` needs the order that makes a request the first of its key")
        if self.representative and not self.has_keys:
            raise ValueError("`representative` needs keys")
        if self.duplicates == "first" and not (self.request_order and self.has_keys):
            raise ValueError("duplicates='first' needs keys and a `request_order`")

    @property
    def has_keys(self) -> bool:
        return bool(self.join_key or self.keys)

    @property
    def with_status(self) -> bool:
        return self.mode != PAIRS if self.status is None else self.status


def _one_of(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}, not {value!r}")


def check_column_names(requests: DataFrame, lookup: DataFrame) -> None:
    for side, rows in (("Request", requests), ("Lookup", lookup)):
        reserved = [c for c in rows.columns if c.startswith(RESERVED_PREFIXES)]
        if reserved:
            raise ValueError(f"{side} columns {reserved} have names used internally; rename them")
