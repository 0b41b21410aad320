"""The match condition of an enrichment, taken apart into join keys, a bound and the rest."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import FIELD_PREFIX, VALUE_PREFIX
from lookfuse.functions.columns import ColumnList
from lookfuse.functions.names import NameIndex, col
from lookfuse.functions.ordering import OrderTerm
from lookfuse.functions.rows import ColumnRow
from lookfuse.functions.template import disjuncts, read_template
from lookfuse.functions.types import common_type, family, is_numeric
from lookfuse.plans.options import CONDITION_VALUES, Options


@dataclass(frozen=True)
class Equality:
    """Request expression equals lookup expression, both cast to one type."""

    request: Column
    lookup: Column
    declared: bool


@dataclass(frozen=True)
class Bound:
    """``lookup column op request expression``."""

    column: str
    op: str
    request: Column
    dtype: T.DataType

    @property
    def is_upper(self) -> bool:
        return self.op in ("<", "<=")

    def test(self, lookup: Column, request: Column) -> Column:
        return {
            "<": lookup < request,
            "<=": lookup <= request,
            ">": lookup > request,
            ">=": lookup >= request,
        }[self.op]


@dataclass(frozen=True)
class Nearby:
    """A numeric lookup column that has to be at most ``distance`` away from a request value."""

    column: str
    value: Column
    distance: Column
    sure: bool  # whether types subtract as doubles do, or exactly

    def ends(self) -> tuple[Column, Column]:
        """Between what the column lies, as doubles; a little too far, so that rounding leaves nothing out."""
        value, distance = self.value.cast("double"), F.abs(self.distance.cast("double"))
        wide = distance + (F.abs(value) + distance) * 1e-9
        endless = wide == float("inf")
        return F.when(endless, float("-inf")).otherwise(value - wide), F.when(endless, float("inf")).otherwise(value + wide)

    def inner_ends(self) -> tuple[Column, Column]:
        """Between what every value is near enough, where ``sure``."""
        value, distance = self.value.cast("double"), self.distance.cast("double")
        narrow = distance * (1 - 1e-12) - F.abs(value) * 1e-12
        return value - narrow, value + narrow

    def possible(self) -> Column:
        """False for requests that no value is near enough to."""
        value, distance = self.value.cast("double"), self.distance.cast("double")
        return (distance >= 0) & ((F.abs(value) < float("inf")) | (distance >= float("inf")))


@dataclass
class Condition:
    """What has to hold between a request and a lookup row."""

    equalities: list[Equality] = field(default_factory=list)
    bounds: list[Bound] = field(default_factory=list)
    lookup_tests: list[Column] = field(default_factory=list)
    residual: list[Column] = field(default_factory=list)
    residual_columns: set[str] = field(default_factory=set)  # request-side columns the residual reads
    valid: Column | None = None  # over the request side; None when every request is valid
    nearby: list[Nearby] = field(default_factory=list)  # what the residual tests imply
    cases: list[tuple[Column, Bound | None]] = field(default_factory=list)  # the bound that alone decides for lookup rows that pass a test
    arms: list[Condition] = field(default_factory=list)  # the same as a disjunction, each arm with an equality

    @property
    def whole_test(self) -> Column:
        """All that has to hold, as one test of a pair."""
        tests = [e.request == e.lookup for e in self.equalities]
        tests += [b.test(col(b.column).cast(b.dtype), b.request) for b in self.bounds]
        return reduce(lambda a, b: a & b, [*tests, *self.lookup_tests, *self.residual])

    @property
    def residual_test(self) -> Column | None:
        return reduce(lambda a, b: a & b, self.residual) if self.residual else None

    def split_bounds(
        self, terms: Sequence[OrderTerm], order_source: Callable[[str], str]
    ) -> tuple[Bound | None, Bound | None]:
        """The bound to sort by and, for a two-sided range, the one to test on the picked row.

        The second is exact only when the order takes the row nearest to the first; then a picked row beyond
        the second bound means that no row is within both. Other combinations have no such pair.
        """
        if len(self.bounds) == 1:
            return self.bounds[0], None
        if len(self.bounds) == 2 and terms:
            a, b = self.bounds
            if a.column == b.column == order_source(terms[0].column) and a.is_upper != b.is_upper:
                upper, lower = (a, b) if a.is_upper else (b, a)
                return (upper, lower) if terms[0].descending else (lower, upper)
        return None, None


def two_sided(bounds: Sequence[Bound]) -> tuple[Bound, Bound] | None:
    """An upper and a lower bound whose values compare with each other, on one column if there are such."""
    found = [
        (a, b)
        for a in bounds
        for b in bounds
        if a.is_upper and not b.is_upper and all(_has_scale(x.dtype) for x in (a, b))
        if a.dtype == b.dtype or (is_numeric(a.dtype) and is_numeric(b.dtype))
    ]
    return min(found, key=lambda pair: pair[0].column != pair[1].column, default=None)


def _has_scale(dtype: T.DataType) -> bool:
    """Whether values have numbers that grow with them; strings under a collation have not."""
    return family(dtype) in ("integral", "fractional", "date-time") or dtype == T.StringType()


def condition_values(requests: DataFrame, options: Options) -> dict[str, Column]:
    """Condition values by name, over the request columns."""
    if options.condition_value_fn:
        values = options.condition_value_fn(ColumnRow(requests.columns, col))
        if not values:
            raise ValueError("`condition_value_fn` returned no values")
        return {n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()}
    index = NameIndex.of(requests)
    names = dict.fromkeys([*(options.fields or []), *(options.additional_condition_fields or [])])
    tolerant = callable(options.restriction)
    missing = [n for n in names if n not in index]
    if missing and not tolerant and options.restriction is not None:
        raise ValueError(f"Requests have no field(s) {missing}, needed for the restriction")
    return {n: col(index.find(n)) if n in index else F.lit(None).cast("string") for n in names}


def with_condition_columns(
    requests: DataFrame, options: Options, reads_fields: bool = True
) -> tuple[DataFrame, dict[str, T.DataType]]:
    """Requests plus one column for each condition value and, if callbacks read fields, for each field."""
    values = condition_values(requests, options)
    side = requests.select(
        "*",
        *[v.alias(VALUE_PREFIX + n) for n, v in values.items()],
        *[col(c).alias(FIELD_PREFIX + c) for c in (requests.columns if reads_fields else [])],
    )
    return side, {n: side.schema[VALUE_PREFIX + n].dataType for n in values}


def declared_keys(
    requests: DataFrame, lookup: DataFrame, parsed: ColumnList, options: Options
) -> list[tuple[str, Column, Column]]:
    """``(name, request column, lookup column)`` of the keys the caller named."""
    if options.keys == CONDITION_VALUES:
        mine = options.condition_value_fn(ColumnRow(requests.columns, col))
        renamed = {parsed.renames.get(n, n): n for n in lookup.columns}
        try:
            theirs = options.condition_value_fn(ColumnRow(renamed, lambda n: col(renamed[n])))
        except (KeyError, AttributeError) as error:
            raise ValueError(f"`condition_value_fn` cannot read its key from lookup rows: {error}") from None
        return [(n, mine[n], theirs[n]) for n in sorted(mine)]
    if options.join_key:
        pairs = {options.join_key: parsed.original(options.join_key)}
    elif isinstance(options.keys, dict):
        pairs = options.keys
    else:
        pairs = {k: parsed.original(k) for k in options.keys or []}
    request_index, lookup_index = NameIndex.of(requests), NameIndex.of(lookup)
    for mine, theirs in pairs.items():
        if mine not in request_index:
            raise ValueError(f"Requests have no key field {mine!r}")
        if theirs not in lookup_index:
            raise ValueError(f"Lookup has no key column {theirs!r} (for request field {mine!r})")
    return [(m, col(request_index.find(m)), col(lookup_index.find(t))) for m, t in pairs.items()]


def build_condition(
    side: DataFrame,
    lookup: DataFrame,
    keys: list[tuple[str, Column, Column]],
    value_types: dict[str, T.DataType],
    restriction,
    options: Options,
) -> Condition:
    """Keys and restriction together. ``side`` is the result of :func:`with_condition_columns`."""
    condition = Condition()
    for name, mine, theirs in keys:
        condition.equalities.append(_declared_equality(side, lookup, name, mine, theirs, options))
    covered = set()
    if options.fields and options.scope == "own_request":
        covered = {(VALUE_PREFIX + n, _name_of(lookup, theirs)) for n, _, theirs in keys}

    if restriction is not None:
        for item in _conjuncts(side, restriction, value_types, options):
            _add(condition, side, lookup, item, value_types, covered)
    if isinstance(restriction, str) and not condition.equalities:
        condition.arms = _arms(side, lookup, restriction, value_types)

    nulls_pass = callable(restriction) and options.fields
    if value_types and restriction is not None and not nulls_pass:
        condition.valid = reduce(
            lambda a, b: a & b, [col(VALUE_PREFIX + n).isNotNull() for n in value_types]
        )
    return condition


def _arms(side, lookup, restriction: str, value_types) -> list[Condition]:
    """The arms of a disjunction, if each of them has an equality to join by."""
    texts, arms = disjuncts(restriction), []
    for text in texts if len(texts) > 1 else []:
        arm = Condition()
        _add(arm, side, lookup, (text, None), value_types, set())
        if not arm.equalities:
            return []
        arms.append(arm)
    return arms


def _conjuncts(side, restriction, value_types, options) -> list:
    """Restriction items, each with the request columns it reads (None: found out from the text)."""
    if isinstance(restriction, str):
        return [(restriction, None)]
    values = ColumnRow(value_types, lambda n: col(VALUE_PREFIX + n))
    fields = [c[len(FIELD_PREFIX) :] for c in side.columns if c.startswith(FIELD_PREFIX)]
    row = ColumnRow(fields, lambda n: col(FIELD_PREFIX + n))
    count = len(inspect.signature(restriction).parameters)
    result = restriction(values, options.primary_keys, row) if count == 3 else restriction(values, row)
    items = result if isinstance(result, list) else [result]
    if not items or not all(isinstance(i, (str, Column, tuple)) for i in items):
        raise ValueError(
            "A restriction function returns a Column, a template, a (column, operator, value) tuple, or a list of them"
        )
    read = {VALUE_PREFIX + n for n in values.used} | {FIELD_PREFIX + n for n in row.used}
    return [(i, read) for i in items]


def _add(condition: Condition, side, lookup, item, value_types, covered) -> None:
    part, read = item
    if isinstance(part, Column):
        condition.residual.append(part)
        condition.residual_columns |= read
        return
    if isinstance(part, tuple):
        column, op, value = part
        _add_comparison(condition, side, lookup, column, op, value, read, covered)
        return
    parsed = read_template(part, value_types, {n: VALUE_PREFIX + n for n in value_types})
    used = {VALUE_PREFIX + n for n in parsed.fields}
    index = NameIndex.of(lookup)
    for comparison in parsed.comparisons:
        if comparison.op == "=" and (comparison.value_sql.strip("`"), index.find(comparison.column)) in covered:
            continue  # says again what the key says
        _add_comparison(
            condition, side, lookup, comparison.column, comparison.op, F.expr(comparison.value_sql), used, covered
        )
    condition.lookup_tests += [F.expr(sql) for sql in parsed.lookup_sql]
    for near in parsed.distances:
        name = index.find(near.column)
        value, distance = F.expr(near.value_sql), F.expr(near.distance_sql)
        kinds = [f.dataType for f in side.select(value.alias("v"), distance.alias("d")).schema]
        if name is not None and all(is_numeric(kind) for kind in (*kinds, lookup.schema[name].dataType)):
            sure = isinstance(lookup.schema[name].dataType, (T.DoubleType, T.IntegerType, T.ShortType, T.ByteType))
            sure = sure and (family(kinds[0]) == "integral" or isinstance(kinds[0], T.DoubleType)) and not isinstance(kinds[1], T.FloatType)
            condition.nearby.append(Nearby(name, value, distance, sure))
    for sql in parsed.residual_sql:
        condition.residual.append(F.expr(sql))
        condition.residual_columns |= used


def _add_comparison(condition: Condition, side, lookup, column, op, value, read, covered) -> None:
    if op not in ("=", "<", "<=", ">", ">="):
        raise ValueError(f"Operator {op!r} is none of =, <, <=, >, >=")
    name = NameIndex.of(lookup).find(column)
    if name is None:
        raise ValueError(f"Lookup has no column {column!r}; it has {lookup.columns}")
    value = value if isinstance(value, Column) else F.lit(value)
    theirs = lookup.schema[name].dataType
    mine = side.select(value.alias("v")).schema["v"].dataType
    shared = common_type(mine, theirs)
    if shared is None:
        # Types Spark has to reconcile itself, for instance text against a number.
        plain = Bound(name, op, value, theirs)
        condition.residual.append(col(name) == value if op == "=" else plain.test(col(name), value))
        condition.residual_columns |= read
    elif op == "=":
        condition.equalities.append(Equality(value.cast(shared), col(name).cast(shared), False))
    else:
        condition.bounds.append(Bound(name, op, value.cast(shared), shared))


def _declared_equality(side, lookup, name, mine, theirs, options: Options) -> Equality:
    target = (options.cast_keys or {}).get(name)
    if target is not None:
        return Equality(mine.try_cast(target), theirs.try_cast(target), True)
    a = side.select(mine.alias("k")).schema["k"].dataType
    b = lookup.select(theirs.alias("k")).schema["k"].dataType
    shared = common_type(a, b) if family(a) == family(b) else None
    if shared is None:
        raise ValueError(
            f"Key {name!r} is {a.simpleString()} in the requests and {b.simpleString()} in the lookup; "
            "such values are never equal. Say cast_keys={...} to compare them in one type."
        )
    return Equality(mine.cast(shared), theirs.cast(shared), True)


def _name_of(lookup: DataFrame, column: Column) -> str | None:
    names = lookup.select(column).columns
    return NameIndex.of(lookup).find(names[0])
