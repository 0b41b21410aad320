"""The enrichment plan: match, pick one lookup row, attach, merge."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import (
    BOUND,
    CHOSEN,
    COUNT,
    FIELD_PREFIX,
    HIT,
    KEY_PREFIX,
    LIMIT,
    LOOKUP_BOUND,
    LOOKUP_KEY_PREFIX,
    LOOKUP_PREFIX,
    ORDER_PREFIX,
    SALT,
    VALUE_PREFIX,
)
from lookfuse.functions.columns import output_columns, parse_column_names
from lookfuse.functions.names import NameIndex, col
from lookfuse.functions.ordering import OrderTerm, parse_order
from lookfuse.functions.types import has_exact_literals, is_orderable
from lookfuse.operators.attach import attach
from lookfuse.operators.blocks import best_around, best_around_values, best_in_ranges, few_values
from lookfuse.operators.collect import select_from_groups
from lookfuse.operators.keyfilter import filter_by_keys
from lookfuse.operators.lookup import Payload, best_per_key
from lookfuse.operators.merge import merge
from lookfuse.operators.pairs import matching_pairs
from lookfuse.operators.prefix import best_intervals, in_interval, pick_by_bound
from lookfuse.operators.ranges import Range
from lookfuse.operators.reduce import count_per_key, first_per_key
from lookfuse.operators.requests import distinct_probes, mark_first, total_order
from lookfuse.operators.selectors import ColumnSelector, PythonSelector, StreamSelector
from lookfuse.operators.skew import MAX_PARTS, Splitter, find_hot_keys, fits_broadcast, key_hash, too_large_to_broadcast
from lookfuse.operators.streams import select_from_streams
from lookfuse.plans.choice import ROW, combine
from lookfuse.plans.condition import (
    Bound,
    Condition,
    Nearby,
    build_condition,
    declared_keys,
    two_sided,
    with_condition_columns,
)
from lookfuse.plans.options import Options, check_column_names

_LIMIT_FIELD = "__limit"
_MAX_INTERVALS = 1000
_MAX_CELLS = 16  # for a probe, on average, where every value has a cell
_RAW_KEY = "__rqk_raw"
_FIRST = "__rqk_first"


def build(requests: DataFrame, lookup: DataFrame, options: Options) -> DataFrame:
    check_column_names(requests, lookup)
    rows, side, plan = _prepare(requests, lookup, options)
    splitter = Splitter.plan(options.split, requests, lookup, one_group=plan.constant_key)
    if options.duplicates == "first":
        side = _mark_first_of_key(side, plan.condition, rows, options, splitter)
    if options.scope == "any_request":
        joined = _any_request(plan, side, splitter)
    elif options.representative:
        joined = _by_representative(plan, side, rows, splitter)
    else:
        joined = plan.enrich(side, splitter)
    return merge(joined, rows.columns, plan.result_schema, options)


def _prepare(requests: DataFrame, lookup: DataFrame, options: Options) -> tuple[DataFrame, DataFrame, "_Plan"]:
    """Requests that take part, the same with the columns conditions read, and the plan."""
    parsed = parse_column_names(options.column_names)
    keys = declared_keys(requests, lookup, parsed, options)
    selector = _selector(options.select)
    payload, payload_columns, order_source = _payload(lookup, parsed, options, keys, selector)
    if keys and options.null_keys == "drop":
        requests = requests.where(reduce(lambda a, b: a & b, [mine.isNotNull() for _, mine, _ in keys]))
    templates = options.restriction if isinstance(options.restriction, Mapping) else {None: options.restriction}
    reads_fields = any(callable(t) for t in templates.values()) or (selector is not None and selector.with_request)
    side, value_types = with_condition_columns(requests, options, reads_fields)
    conditions = {i: build_condition(side, lookup, keys, value_types, template, options) for i, template in templates.items()}
    if not all(c.equalities or c.arms for c in conditions.values()) and not options.allow_theta:
        raise ValueError(
            "The restriction has no equality with a request value, so every request faces the whole lookup; "
            "add one, or say allow_theta=True"
        )
    condition = conditions[next(iter(conditions))]
    if isinstance(options.restriction, Mapping):
        chosen = col(NameIndex.of(requests).find(options.template_id) or options.template_id)
        condition, lookup = combine(conditions, chosen, side, lookup, options.scope == "any_request")
    plan = _Plan(options, lookup, payload, payload_columns, order_source, condition, selector)
    return requests, side, plan


def needs_micro_batches(requests: DataFrame, lookup: DataFrame, options: Options) -> bool:
    """Whether a stream of requests has to be enriched batch by batch.

    With equal keys alone, or a bound on a small lookup, the lookup is reduced on its own, and a stream-static join
    does; anything that ranks or collects per request cannot run on a stream.
    """
    if options.representative or options.duplicates == "first" or options.scope == "any_request":
        return True
    return not _prepare(requests, lookup, options)[2].can_stream()


class _Plan:
    """Everything that stays the same for one enrichment."""

    def __init__(self, options, lookup, payload, payload_columns, order_source, condition, selector):
        self.options: Options = options
        self.payload: Payload = payload
        self.condition: Condition = condition
        self.selector = selector
        self.order_source = order_source
        self.constant_key = not condition.equalities
        self.lookup_keys = [LOOKUP_KEY_PREFIX + str(i) for i in range(max(1, len(condition.equalities)))]
        self.request_keys = [KEY_PREFIX + str(i) for i in range(len(self.lookup_keys))]
        self._payload_columns = payload_columns
        self._lookup = lookup

    @property
    def by_key_alone(self) -> bool:
        """Whether equal keys are all that matters, so that the lookup can be reduced on its own."""
        test_pairs = self.condition.bounds or self.condition.residual or self.constant_key
        return not test_pairs and not (self.selector is not None and self.selector.with_request)

    @property
    def result_schema(self) -> T.StructType:
        return self.selector.result_type(self.payload.schema) if self.selector else self.payload.schema

    def key_types(self, side: DataFrame) -> tuple[str, ...]:
        return tuple(f.dataType.simpleString() for f in side.select(*self.request_key_values()).schema.fields)

    # The two sides.

    def lookup_side(self, *extra: Column, everything: bool = False) -> DataFrame:
        """Filtered lookup rows with key, payload and order columns; rows with a NULL key match nothing."""
        rows = self._lookup
        for test in self.condition.lookup_tests:
            rows = rows.where(test)
        keys = [e.lookup for e in self.condition.equalities] or [F.lit(1)]
        rows = rows.select(
            *(["*"] if everything else []),
            *[k.alias(n) for k, n in zip(keys, self.lookup_keys)],
            *[c.alias(n) for n, c in self._payload_columns.items()],
            *extra,
        )
        for name in self.lookup_keys:
            rows = rows.where(col(name).isNotNull())
        return rows

    def request_side(self, side: DataFrame, extra_valid: Column | None = None) -> DataFrame:
        """Requests with their key columns."""
        values = self.request_key_values(extra_valid)
        return side.select("*", *[k.alias(n) for k, n in zip(values, self.request_keys)])

    def request_key_values(self, extra_valid: Column | None = None) -> list[Column]:
        """The first one is NULL where no match is possible."""
        keys = [e.request for e in self.condition.equalities] or [F.lit(1)]
        valid = [v for v in (self.condition.valid, extra_valid) if v is not None]
        if valid:
            keys[0] = F.when(reduce(lambda a, b: a & b, valid), keys[0])
        return keys

    # Matching and picking.

    def enrich(self, side: DataFrame, splitter: Splitter) -> DataFrame:
        """All columns of ``side`` plus HIT, COUNT (if asked for) and the payload."""
        first = col(_FIRST) if _FIRST in side.columns else None
        rows = self.request_side(side, first)
        simple = not self.condition.bounds and not self.condition.residual
        if simple and (self.selector is None or not self.selector.with_request):
            return self._by_key(rows, splitter)
        if self.selector is not None:
            return self._by_chosen_pairs(rows, splitter)
        bound, limit = self._usable_bounds()
        if bound is not None:
            return self._by_bound(rows, bound, limit, splitter)
        inside = self._usable_range()
        if inside is not None:
            return self._by_range(rows, *inside, splitter)
        around = self._usable_range_around()
        if around is not None:
            return self._by_range_around(rows, *around, splitter)
        near = self._usable_distance()
        if near is not None:
            return self._by_distance(rows, near, splitter)
        return self._by_pairs(rows, splitter)

    def _usable_range(self) -> tuple[Bound, Bound] | None:
        """The upper and the lower bound of one lookup column, if they alone decide beside the keys."""
        pair = two_sided(self.condition.bounds) if len(self.condition.bounds) == 2 and not self.condition.residual else None
        alike = pair is not None and pair[0].column == pair[1].column and pair[0].dtype == pair[1].dtype
        return pair if alike and self.payload.can_take_minimum() else None

    def _by_range(self, rows: DataFrame, upper: Bound, lower: Bound, splitter: Splitter) -> DataFrame:
        high, low = f"{BOUND}0", f"{BOUND}1"
        rows = _without_condition_columns(rows.withColumns({high: upper.request, low: lower.request}))
        lookup = self._reduced_to(rows, self.lookup_side(col(upper.column).cast(upper.dtype).alias(LOOKUP_BOUND)))
        probe = [*self.request_keys, high, low]
        present = _all_present(rows, probe)
        picked = best_in_ranges(
            distinct_probes(present, probe),
            self.request_keys,
            low,
            high,
            lookup.where(col(LOOKUP_BOUND).isNotNull()),
            self.lookup_keys,
            upper.test(col(LOOKUP_BOUND), col(high)) & lower.test(col(LOOKUP_BOUND), col(low)),
            self.payload,
            splitter,
            present,
        )
        return self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter)

    def _usable_range_around(self) -> tuple[Bound, Bound] | None:
        """The bounds of two lookup columns by one request value, if they alone decide beside the keys."""
        pair = two_sided(self.condition.bounds) if len(self.condition.bounds) == 2 and not self.condition.residual else None
        alike = pair is not None and str(pair[0].request) == str(pair[1].request) and pair[0].dtype == pair[1].dtype
        return pair if alike and self.payload.can_take_minimum() else None

    def _by_range_around(self, rows: DataFrame, upper: Bound, lower: Bound, splitter: Splitter) -> DataFrame:
        rows = _without_condition_columns(rows.withColumn(BOUND, upper.request))
        start, end = f"{LOOKUP_BOUND}_from", f"{LOOKUP_BOUND}_to"
        ends = [col(b.column).cast(b.dtype).alias(n) for b, n in ((upper, start), (lower, end))]
        probe = [*self.request_keys, BOUND]
        present = _all_present(rows, probe)
        hashes = {"keys": key_hash(self.request_keys), "values": key_hash([BOUND]), "probes": key_hash(probe)}
        asked = present.agg(*[F.approx_count_distinct(h).alias(n) for n, h in hashes.items()]).first()
        lookup = self._reduced_to(rows, self.lookup_side(*ends), asked["keys"])
        # Cells of their own are for values that most keys have; counts need every row in parts that do not overlap.
        own_cells = not self.options.match_count and asked["keys"] * asked["values"] <= _MAX_CELLS * asked["probes"]
        values = few_values(present.select(col(BOUND))) if own_cells and asked["values"] <= 2 * MAX_PARTS else None
        if values is not None:
            picked = best_around_values(
                distinct_probes(present, probe),
                self.request_keys,
                BOUND,
                values,
                lookup,
                self.lookup_keys,
                start,
                upper.op,
                end,
                lower.op,
                self.payload,
            )
            return self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter)
        picked = best_around(
            distinct_probes(present, probe),
            self.request_keys,
            BOUND,
            _all_present(lookup, [start, end]),
            self.lookup_keys,
            start,
            end,
            upper.test(col(start), col(BOUND)) & lower.test(col(end), col(BOUND)),
            self.payload,
            splitter,
            present,
        )
        return self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter)

    def _usable_distance(self) -> Nearby | None:
        """The distance that alone decides beside the keys, if all rows well inside it are certain to pass."""
        condition = self.condition
        alone = not condition.bounds and not condition.arms and len(condition.residual) == len(condition.nearby) == 1
        return condition.nearby[0] if alone and condition.nearby[0].sure and self.payload.can_take_minimum() else None

    def _by_distance(self, rows: DataFrame, near: Nearby, splitter: Splitter) -> DataFrame:
        names = [f"{BOUND}{i}" for i in range(4)]
        possible = f"{BOUND}_possible"
        rows = rows.withColumns(dict(zip(names, (*near.ends(), *near.inner_ends()))) | {possible: near.possible()})
        read = [c for c in rows.columns if c in self.condition.residual_columns]
        probe = [*self.request_keys, *names, *read]
        present = _all_present(rows.where(col(possible)), [*self.request_keys, *names])
        rows = _without_condition_columns(rows.drop(possible), keep=read)
        lookup = self._reduced_to(rows, self.lookup_side(col(near.column).cast("double").alias(LOOKUP_BOUND)))
        picked = best_in_ranges(
            distinct_probes(present, probe),
            self.request_keys,
            names[0],
            names[1],
            lookup.where(col(LOOKUP_BOUND).isNotNull()),
            self.lookup_keys,
            self.condition.residual_test,
            self.payload,
            splitter,
            present,
            (names[2], names[3]),
            col(LOOKUP_BOUND).cast(self._lookup.schema[near.column].dataType).alias(near.column),
        )
        return self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter, read)

    def _usable_bounds(self) -> tuple[Bound | None, Bound | None]:
        """The bound that alone decides beside the keys, and the one to test on the picked row."""
        bound, limit = self.condition.split_bounds(self.payload.terms, self.order_source)
        if self.selector is not None or self.condition.residual or not self.payload.can_take_minimum():
            return None, None
        return (None, None) if limit is not None and self.options.match_count else (bound, limit)

    def can_stream(self) -> bool:
        """Whether a stream of requests can join the lookup side as it stands, without micro-batches."""
        bound, limit = self._usable_bounds()
        if self.by_key_alone or bound is None:
            return self.by_key_alone
        return self._small_intervals(*self._bounded(bound, limit)) is not None

    def _by_key(self, rows: DataFrame, splitter: Splitter) -> DataFrame:
        picked = self.picked_by_key(rows, splitter)
        rows = _without_condition_columns(rows)
        return self._attach(rows, self.request_keys, picked, self.lookup_keys, splitter)

    def picked_by_key(self, rows: DataFrame, splitter: Splitter) -> DataFrame:
        """One lookup row for each key. ``rows`` only serve to leave out keys nobody asks for."""
        lookup = self._reduced_to(rows, self.lookup_side())
        if self.selector is not None:
            return self._chosen(lookup, self.lookup_keys, self.lookup_keys, splitter)
        return self._first(lookup, self.lookup_keys)

    def _by_bound(self, rows: DataFrame, bound: Bound, limit: Bound | None, splitter: Splitter) -> DataFrame:
        rows = rows.withColumn(BOUND, bound.request)
        if limit is not None:
            rows = rows.withColumn(LIMIT, limit.request)
        rows = _without_condition_columns(rows)
        lookup, bound, payload = self._bounded(bound, limit)
        lookup = self._reduced_to(rows, lookup)
        wanted = splitter.enabled or rows.isStreaming or too_large_to_broadcast(rows)
        intervals = self._small_intervals(lookup, bound, payload) if wanted else None
        if intervals is not None:
            same = [col(m) == col(t) for m, t in zip(self.request_keys, self.lookup_keys)]
            condition = reduce(lambda a, b: a & b, same) & in_interval(BOUND, bound.op)
            found = rows.join(intervals, condition, "left").drop(*self.lookup_keys)
        elif not splitter.enabled:
            found = pick_by_bound(
                rows, self.request_keys, BOUND, bound.op, lookup, self.lookup_keys, payload, splitter
            )
        else:
            probe = [*self.request_keys, BOUND]
            present = _all_present(rows, probe)
            probes = distinct_probes(present, probe)
            picked = pick_by_bound(
                probes, self.request_keys, BOUND, bound.op, lookup, self.lookup_keys, payload, splitter, present
            )
            found = self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter)
        if limit is not None:
            inside = limit.test(col(LOOKUP_PREFIX + _LIMIT_FIELD), col(LIMIT))
            found = found.withColumn(HIT, F.when(inside, col(HIT)))
        return found

    def _bounded(self, bound: Bound, limit: Bound | None) -> tuple[DataFrame, Bound, Payload]:
        """The lookup side with its bound, and with the second bound's column as part of the payload."""
        payload, extra = self.payload, [col(bound.column).cast(bound.dtype).alias(LOOKUP_BOUND)]
        if limit is not None:
            limit_field = T.StructField(_LIMIT_FIELD, limit.dtype)
            payload = replace(payload, schema=T.StructType([*payload.schema.fields, limit_field]))
            extra.append(col(limit.column).cast(limit.dtype).alias(LOOKUP_PREFIX + _LIMIT_FIELD))
        return self.lookup_side(*extra).where(col(LOOKUP_BOUND).isNotNull()), bound, payload

    def _small_intervals(self, lookup: DataFrame, bound: Bound, payload: Payload) -> DataFrame | None:
        """Ranges to broadcast to large requests, if they are small and no key has many (a request tests them all)."""
        if self.constant_key:
            return None
        intervals = best_intervals(lookup, self.lookup_keys, bound.op, payload)
        if not fits_broadcast(intervals):
            return None
        most = intervals.groupBy(*[col(k) for k in self.lookup_keys]).count().agg(F.max("count")).first()[0]
        return intervals if (most or 0) <= _MAX_INTERVALS else None

    def _by_pairs(self, rows: DataFrame, splitter: Splitter) -> DataFrame:
        pairs, probe, null_safe, rows = self._pairs(rows, splitter, with_request=False)
        if SALT in pairs.columns and not self.options.match_count:
            pairs = first_per_key(pairs, [*probe, SALT], self.payload.sort_order())
        picked = self._first(pairs, probe)
        return self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter, null_safe)

    def _by_chosen_pairs(self, rows: DataFrame, splitter: Splitter) -> DataFrame:
        pairs, probe, null_safe, rows = self._pairs(rows, splitter, self.selector.with_request)
        picked = self._chosen(pairs, probe, self.request_keys, splitter)
        return self._attach(rows, probe, *_as_lookup_keys(picked, probe), splitter, null_safe)

    def _chosen(
        self, matches: DataFrame, keys: list[str], match_keys: list[str], splitter: Splitter
    ) -> DataFrame:
        """The selector's choice for each group; ``match_keys`` are those of ``keys`` that equal lookup keys."""
        selector, hot = self.selector, None
        if isinstance(selector, StreamSelector):
            picked = select_from_streams(matches, keys, self.payload.sort_order(), self.payload.row(), selector, self.payload.schema)
            return self._unpacked(picked, keys)
        if splitter.enabled:
            # Only a key with many lookup rows can have many matches.
            found = find_hot_keys(self.lookup_side().select(key_hash(self.lookup_keys).alias("h")), splitter)
            hot = found.has(match_keys) if found else None
        choose, arguments = selector.bind(self.payload.schema), []
        if selector.with_request:
            fields = [c for c in keys if c.startswith(FIELD_PREFIX)]
            arguments = [F.struct(*[col(c).alias(c[len(FIELD_PREFIX) :]) for c in fields])]
        picked = select_from_groups(
            matches,
            keys,
            self.payload.sort_order(),
            self.payload.row(),
            lambda array: choose(array, *arguments),
            selector.decomposable,
            hot,
            selector.chunk_rows,
            selector.max_group_rows,
        )
        return self._unpacked(picked, keys)

    def _unpacked(self, picked: DataFrame, keys: list[str]) -> DataFrame:
        return picked.select(
            *[col(k) for k in keys],
            HIT,
            COUNT,
            col(CHOSEN).isNotNull().alias(CHOSEN),
            *[col(CHOSEN).getField(n).alias(LOOKUP_PREFIX + n) for n in self.result_schema.names],
        )

    def _pairs(self, rows: DataFrame, splitter: Splitter, with_request: bool):
        """Matching pairs, reduced to probe and lookup columns, with the probe columns and NULL-tolerant ones."""
        condition = self.condition
        test = condition.residual_test
        bounds = []
        for i, bound in enumerate(condition.bounds):
            name = f"{BOUND}{i}"
            rows = rows.withColumn(name, bound.request)
            inside = bound.test(col(bound.column).cast(bound.dtype), col(name))
            test = inside if test is None else test & inside
            bounds.append(name)
        read = {c for c in rows.columns if c in condition.residual_columns}
        if with_request:
            sortable = [f.name for f in rows.schema.fields if is_orderable(f.dataType)]
            read |= {c for c in sortable if c.startswith(FIELD_PREFIX)}
        null_safe = [c for c in rows.columns if c in read]
        probe = [*self.request_keys, *bounds, *null_safe]
        present = _all_present(rows, [*self.request_keys, *bounds])
        if condition.arms:
            probes = distinct_probes(present, probe)
            pairs = [self._arm_pairs(number, probes, probe, splitter) for number in range(len(condition.arms))]
            pairs = reduce(lambda a, b: a.unionByName(b), pairs)
            return pairs, probe, null_safe, _without_condition_columns(rows, keep=probe)
        lookup = self._reduced_to(rows, self.lookup_side(everything=True))
        pairs, salts = matching_pairs(
            distinct_probes(present, probe),
            self.request_keys,
            lookup,
            self.lookup_keys,
            test,
            splitter,
            ranges=_ranges(condition, bounds),
            raw_probes=present,
        )
        pairs = pairs.select(*[col(c) for c in [*probe, *salts, *self._payload_columns]])
        return pairs, probe, null_safe, _without_condition_columns(rows, keep=probe)

    def _arm_pairs(self, number: int, probes: DataFrame, probe: list[str], splitter: Splitter) -> DataFrame:
        """Pairs that one arm of a disjunction finds by its equalities, and none before it."""
        arms = self.condition.arms
        keys = [f"{KEY_PREFIX}arm{i}" for i in range(len(arms[number].equalities))]
        asked = probes.select("*", *[e.request.alias(k) for k, e in zip(keys, arms[number].equalities)])
        asked = _all_present(asked, keys)
        lookup_keys = [f"{LOOKUP_KEY_PREFIX}arm{i}" for i in range(len(keys))]
        lookup = self.lookup_side(everything=True)
        for test in arms[number].lookup_tests:
            lookup = lookup.where(test)
        lookup = _all_present(lookup.select("*", *[e.lookup.alias(k) for k, e in zip(lookup_keys, arms[number].equalities)]), lookup_keys)
        test = reduce(lambda a, b: a & ~F.coalesce(b, F.lit(False)), [a.whole_test for a in arms[:number]], arms[number].whole_test)
        pairs, _ = matching_pairs(asked, keys, lookup, lookup_keys, test, splitter)
        return pairs.select(*[col(c) for c in [*probe, *self._payload_columns]])

    def _first(self, candidates: DataFrame, keys: list[str]) -> DataFrame:
        """One row for each key, with a match count if the caller wants one."""
        if self.options.match_count and self.payload.can_take_minimum():
            return best_per_key(candidates, keys, self.payload).withColumn(HIT, F.lit(True))
        first = first_per_key(candidates, keys, self.payload.sort_order()).select(
            *[col(k) for k in keys], F.lit(True).alias(HIT), *[col(c) for c in self.payload.columns]
        )
        if not self.options.match_count:
            return first
        counts = count_per_key(candidates, keys, COUNT).select(
            *[col(k).alias(f"__c{i}") for i, k in enumerate(keys)], COUNT
        )
        same = reduce(lambda a, b: a & b, [col(k).eqNullSafe(col(f"__c{i}")) for i, k in enumerate(keys)])
        return first.join(counts, same).drop(*[f"__c{i}" for i in range(len(keys))])

    def _attach(self, rows, columns, picked, picked_columns, splitter, null_safe=()) -> DataFrame:
        single = self.constant_key and len(columns) == 1
        joined = attach(rows, columns, picked, picked_columns, splitter, null_safe, single)
        return joined.drop(*picked_columns)

    def _reduced_to(self, rows: DataFrame, lookup: DataFrame, asked_keys: int | None = None) -> DataFrame:
        """Lookup rows with a key some request has, when the requests' keys are few enough to be sent to them.

        Spark reckons keys as if every request had its own; ``asked_keys`` is about how many there are, where that is known.
        """
        wanted, most = self.options.semi_reduce, self.options.pushdown_keys
        if self.constant_key or rows.isStreaming or (wanted is False and not most):
            return lookup
        asked = distinct_probes(_all_present(rows, self.request_keys), self.request_keys)
        if most and all(has_exact_literals(asked.schema[k].dataType) for k in self.request_keys):
            found = asked.limit(most + 1).collect()
            if len(found) <= most:
                # Literal lists reach the source; with several key columns they are a superset the join narrows.
                for i, name in enumerate(self.lookup_keys):
                    lookup = lookup.where(col(name).isin(list({r[i] for r in found})))
                return lookup
        if wanted == "bloom":
            return filter_by_keys(lookup, self.lookup_keys, _all_present(rows, self.request_keys), self.request_keys)
        if wanted is False or wanted == "auto" and fits_broadcast(self._lookup):
            return lookup
        if wanted == "auto" and not fits_broadcast(asked):
            if asked_keys is None or asked_keys > MAX_PARTS:
                return lookup
            asked = F.broadcast(asked)
        same = reduce(
            lambda a, b: a & b, [col(m) == col(t) for m, t in zip(self.request_keys, self.lookup_keys)]
        )
        return lookup.join(asked, same, "left_semi")


def _ranges(condition: Condition, names: list[str]) -> tuple[Range, Range] | None:
    """The ranges of requests (``names`` hold their bounds' values) and of lookup rows that a two-sided condition makes meet."""
    bounds, pair = condition.bounds, two_sided(condition.bounds)
    if pair is None and condition.nearby:
        near = condition.nearby[0]
        there = col(near.column).cast("double")
        return Range(*near.ends(), T.DoubleType()), Range(there, there, T.DoubleType())
    if pair is None:
        return None
    dtype = pair[0].dtype if pair[0].dtype == pair[1].dtype else T.DoubleType()
    asked = [col(names[bounds.index(b)]) for b in pair]
    return Range(*asked, dtype), Range(*[col(b.column).cast(b.dtype) for b in pair], dtype)


def _without_condition_columns(rows: DataFrame, keep=()) -> DataFrame:
    """Drop the copies that only callbacks and templates read, before rows are packed or hashed whole."""
    return rows.drop(*[c for c in rows.columns if c.startswith((VALUE_PREFIX, FIELD_PREFIX)) and c not in keep])


def _all_present(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.where(reduce(lambda a, b: a & b, [col(c).isNotNull() for c in columns]))


def _as_lookup_keys(picked: DataFrame, probe: list[str]) -> tuple[DataFrame, list[str]]:
    names = {c: f"{LOOKUP_KEY_PREFIX}p{i}" for i, c in enumerate(probe)}
    return picked.withColumnsRenamed(names), list(names.values())


def _selector(select):
    if isinstance(select, (ColumnSelector, PythonSelector, StreamSelector)):
        return select
    if callable(select):
        return ColumnSelector(select)
    return None


def _payload(lookup, parsed, options, keys, selector):
    """The selected columns, what they are computed from, and the order, by output or lookup name."""
    index = NameIndex.of(lookup)
    required = [options.join_key] if options.join_key else []
    wanted = [*(options.fields or []), *(options.primary_keys or [])]
    if isinstance(options.keys, Mapping):
        wanted += list(options.keys.values())
    elif isinstance(options.keys, (list, tuple)):
        wanted += list(options.keys)
    selected = output_columns(parsed, index, lookup.columns, required, wanted)
    source_of = {out: source for source, out in selected}
    schema = T.StructType([T.StructField(out, lookup.schema[source].dataType) for source, out in selected])
    if isinstance(selector, StreamSelector):
        terms = tuple(parse_order(selector.order)) if selector.order else ()
    else:
        terms = () if selector is not None or options.select == "first" else tuple(parse_order(options.select))

    def order_source(name: str) -> str:
        source = source_of.get(name) or index.find(name)
        if source is None:
            raise ValueError(f"The order column {name!r} is no lookup column")
        return source

    columns = {LOOKUP_PREFIX + out: col(source) for source, out in selected}
    columns |= {ORDER_PREFIX + t.column: col(order_source(t.column)) for t in terms}
    types = {t.column: lookup.schema[order_source(t.column)].dataType for t in terms}
    return Payload(schema, terms, types), columns, order_source


def _raw_keys(side: DataFrame, condition: Condition) -> tuple[DataFrame, list[str]]:
    declared = [e.request for e in condition.equalities if e.declared]
    names = [f"{_RAW_KEY}{i}" for i in range(len(declared))]
    return side.select("*", *[k.alias(n) for k, n in zip(declared, names)]), names


def _mark_first_of_key(side, condition, requests, options, splitter) -> DataFrame:
    """Only the first valid request of each key asks the lookup; the others stay unmatched."""
    with_keys, names = _raw_keys(side, condition)
    valid = condition.valid if condition.valid is not None else F.lit(True)
    marked = mark_first(
        with_keys.withColumn(f"{_RAW_KEY}_valid", valid),
        [*names, f"{_RAW_KEY}_valid"],
        total_order(requests, options.request_order),
        _FIRST,
        splitter,
    )
    return marked.drop(*names, f"{_RAW_KEY}_valid")


def _by_representative(plan: _Plan, side: DataFrame, requests: DataFrame, splitter: Splitter) -> DataFrame:
    """One request of each key asks; all requests of the key share the answer."""
    rows, names = _raw_keys(side, plan.condition)
    order = total_order(requests, plan.options.representative)
    asking = first_per_key(_all_present(rows, names), names, order)
    answers = plan.enrich(asking, splitter)
    keep = [c for c in answers.columns if c in (HIT, COUNT, CHOSEN) or c.startswith(LOOKUP_PREFIX)]
    answers = answers.where(col(HIT)).select(*[col(c) for c in [*names, *keep]])
    answers, answer_keys = _as_lookup_keys(answers, names)
    rows = _without_condition_columns(rows)
    return attach(rows, names, answers, answer_keys, splitter)


def _any_request(plan: _Plan, side: DataFrame, splitter: Splitter) -> DataFrame:
    """Lookup rows that any request's restriction admits, attached by the declared keys alone."""
    condition, options = plan.condition, plan.options
    rows = side
    if options.representative:
        with_keys, names = _raw_keys(side, condition)
        rows = first_per_key(
            _all_present(with_keys, names), names, total_order(side.select(*_own(side)), options.representative)
        )
    if _FIRST in rows.columns:
        rows = rows.where(col(_FIRST))
    template = replace(condition, equalities=[e for e in condition.equalities if not e.declared])
    admitted = _admitted(plan, template, rows, side, splitter)
    if ROW in admitted.columns:
        # A row that several templates admit is there once.
        admitted = admitted.dropDuplicates([ROW])
    keys_only = replace(
        condition,
        equalities=[e for e in condition.equalities if e.declared],
        bounds=[],
        cases=[],
        lookup_tests=[],
        residual=[],
        # With representatives a key is asked for once, and all its requests share what comes.
        valid=None if options.representative else condition.valid,
    )
    by_key = _Plan(
        options, admitted, plan.payload, plan._payload_columns, plan.order_source, keys_only, plan.selector
    )
    return by_key.enrich(side, splitter)


def _own(side: DataFrame) -> list[Column]:
    return [col(c) for c in side.columns if not c.startswith((VALUE_PREFIX, FIELD_PREFIX))]


def _within_any(asking: _Plan, upper: Bound, lower: Bound, rows: DataFrame, lookup: DataFrame, splitter: Splitter) -> DataFrame:
    """Lookup rows that lie between the two bounds of any request of their key, by one sorted run.

    Of the requests whose lower bound a lookup row reaches, one with the largest upper bound admits it if any does.
    """
    far = "far"
    payload = Payload(T.StructType([T.StructField(far, upper.dtype)]), (OrderTerm(far, descending=True),), {far: upper.dtype})
    keys = asking.request_keys
    asked = rows.select(
        *[col(k) for k in keys],
        lower.request.alias(LOOKUP_BOUND),
        upper.request.alias(LOOKUP_PREFIX + far),
        upper.request.alias(ORDER_PREFIX + far),
    )
    asked = _all_present(asked, [*keys, LOOKUP_BOUND, LOOKUP_PREFIX + far])
    lookup = lookup.withColumns({BOUND: col(lower.column).cast(lower.dtype), LIMIT: col(upper.column).cast(upper.dtype)})
    lookup = _all_present(lookup, [BOUND, LIMIT])
    op = "<=" if "=" in lower.op else "<"
    found = pick_by_bound(lookup, asking.lookup_keys, BOUND, op, asked, keys, payload, splitter)
    return found.where(col(HIT) & upper.test(col(LIMIT), col(LOOKUP_PREFIX + far)))


def _admitted(plan: _Plan, template: Condition, rows: DataFrame, requests: DataFrame, splitter: Splitter) -> DataFrame:
    asking = _Plan(
        plan.options, plan._lookup, plan.payload, plan._payload_columns, plan.order_source, template, None
    )
    rows = asking.request_side(rows)
    lookup = asking.lookup_side(everything=True)
    keys, test = asking.request_keys, template.residual_test
    pair = two_sided(template.bounds) if test is None and len(template.bounds) == 2 else None
    if pair is not None:
        if asking.constant_key:
            splitter = Splitter.plan(plan.options.split, requests, plan._lookup, one_group=True)
        admitted = _within_any(asking, *pair, rows, lookup, splitter)
        return admitted.select(*[col(c) for c in plan._lookup.columns])
    if test is None and len(template.bounds) <= 1:
        # The widest bound of each key admits what any of its requests admits.
        probes, widest = _all_present(rows, keys), []
        for number, (case, bound) in enumerate(template.cases):
            passes = case
            if bound is not None:
                name = f"{BOUND}{number}"
                # A request has the values of all templates, but its key has the tag of its own.
                probes = probes.withColumn(name, bound.request)
                widest.append((F.max if bound.is_upper else F.min)(col(name)).alias(name))
                passes = case & bound.test(col(bound.column).cast(bound.dtype), col(name))
            test = passes if test is None else test | passes
        for bound in template.bounds:
            probes = probes.withColumn(BOUND, bound.request).where(col(BOUND).isNotNull())
            widest = [(F.max if bound.is_upper else F.min)(col(BOUND)).alias(BOUND)]
            test = bound.test(col(bound.column).cast(bound.dtype), col(BOUND))
        grouped = probes.groupBy(*[col(k) for k in keys])
        probes = grouped.agg(*widest) if widest else grouped.agg(F.count("*").alias(COUNT)).drop(COUNT)
        if asking.constant_key or template.cases and len(keys) == 1:
            probes = F.broadcast(probes)  # one row by construction, or one for each template
            splitter = Splitter(False)
    else:
        if asking.constant_key and not plan.options.allow_theta:
            raise ValueError(
                "scope='any_request' tests this restriction on every lookup row with every request, as it has no "
                "equality; give allow_theta=True if that is wanted"
            )
        bounds = []
        for i, bound in enumerate(template.bounds):
            rows = rows.withColumn(f"{BOUND}{i}", bound.request)
            inside = bound.test(col(bound.column).cast(bound.dtype), col(f"{BOUND}{i}"))
            test = inside if test is None else test & inside
            bounds.append(f"{BOUND}{i}")
        read = [c for c in rows.columns if c in template.residual_columns]
        probes = distinct_probes(_all_present(rows, [*keys, *bounds]), [*keys, *bounds, *read])
    admitted, _ = matching_pairs(probes, keys, lookup, asking.lookup_keys, test, splitter, "left_semi")
    return admitted.select(*[col(c) for c in plan._lookup.columns])
