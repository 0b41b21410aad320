"""Several templates in one condition: each request has one of them, and one pass over both sides serves all.

Lookup rows are tagged with the numbers of the templates whose tests of the lookup alone they pass, and the tag is a further
key. Equalities and bounds that the templates have alike become one each, their values chosen by template; what has no
counterpart in the others is tested pair by pair. The lookup is read once, however many templates there are.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.constants import LOOKUP_BOUND, LOOKUP_KEY_PREFIX, VALUE_PREFIX
from lookfuse.functions.names import col
from lookfuse.functions.types import family
from lookfuse.plans.condition import Bound, Condition, Equality

TAG = LOOKUP_KEY_PREFIX + "template"
ROW = LOOKUP_KEY_PREFIX + "row"
_CASE = LOOKUP_BOUND + "_case"
# A pair of values of each family, the first below the second, for templates without a bound that others have.
_APART = {"integral": ("0", "1"), "fractional": ("0", "1"), "date-time": ("1970-01-01", "1970-01-02"), "string": ("", "1")}


def combine(
    conditions: Mapping[Any, Condition], chosen: Column, side: DataFrame, lookup: DataFrame, with_row: bool
) -> tuple[Condition, DataFrame]:
    """One condition for requests whose column ``chosen`` names their template, and the lookup it is over.

    ``side`` are requests with the columns conditions read. ``with_row`` adds the number of the row a tagged row comes from.
    """
    numbers = {identity: i for i, identity in enumerate(conditions)}
    parts = list(conditions.values())
    tag = _by(chosen, numbers)
    # A request without a known template asks for nothing.
    valid = tag.isNotNull() if parts[0].valid is None else tag.isNotNull() & parts[0].valid
    combined = Condition(equalities=[e for e in parts[0].equalities if e.declared], valid=valid)
    combined.equalities.append(Equality(tag, col(TAG), False))
    combined.residual_columns = {c for c in side.columns if c.startswith(VALUE_PREFIX)} | set().union(*(p.residual_columns for p in parts))

    tests: list[list[Column]] = [list(p.residual) for p in parts]
    own = [[e for e in p.equalities if not e.declared] for p in parts]
    if len({_key_types(side, found) for found in own}) == 1:
        for alike in zip(*own):
            mine = _by(chosen, dict(zip(numbers, (e.request for e in alike))))
            theirs = _by(col(TAG), dict(enumerate(e.lookup for e in alike)))
            combined.equalities.append(Equality(mine, theirs, False))
    else:
        for number, found in enumerate(own):
            tests[number] += [e.request == e.lookup for e in found]

    tagged = _tagged(lookup, [p.lookup_tests for p in parts], with_row)
    kinds = {(b.op, b.dtype.simpleString()) for p in parts for b in p.bounds}
    if all(len(p.bounds) <= 1 for p in parts) and len(kinds) == 1 and all(family(b.dtype) in _APART for p in parts for b in p.bounds):
        bound, tagged = _one_bound(parts, numbers, chosen, tagged)
        combined.bounds.append(bound)
    elif with_row and kinds and not any(tests) and all(len(p.bounds) <= 1 for p in parts):
        # Of any number of requests only the widest bound of each template matters.
        combined.cases = [(col(TAG) == number, p.bounds[0] if p.bounds else None) for number, p in enumerate(parts)]
    else:
        for number, part in enumerate(parts):
            tests[number] += [b.test(col(b.column).cast(b.dtype), b.request) for b in part.bounds]

    if any(tests):
        passes = [(col(TAG) == number) & reduce(lambda a, b: a & b, found, F.lit(True)) for number, found in enumerate(tests)]
        combined.residual.append(reduce(lambda a, b: a | b, passes))
    else:
        combined.residual_columns = set()
    return combined, tagged


def _by(chosen: Column, values: Mapping[Any, Any]) -> Column:
    """The value for the template that ``chosen`` names; NULL for none of them."""
    chain = None
    for identity, value in values.items():
        test = chosen == F.lit(identity)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain


def _key_types(side: DataFrame, equalities: list[Equality]) -> tuple[str, ...]:
    return tuple(f.dataType.simpleString() for f in side.select(*[e.request.alias(f"k{i}") for i, e in enumerate(equalities)]).schema)


def _tagged(lookup: DataFrame, tests: list[list[Column]], with_row: bool) -> DataFrame:
    """Each lookup row once for every template it passes the own tests of."""
    passes = [reduce(lambda a, b: a & b, found) if found else None for found in tests]
    if all(p is not None for p in passes):
        lookup = lookup.where(reduce(lambda a, b: a | b, passes))
    if with_row:
        lookup = lookup.withColumn(ROW, F.monotonically_increasing_id())
    tags = [F.lit(i) if p is None else F.when(p, F.lit(i)) for i, p in enumerate(passes)]
    return lookup.withColumn(TAG, F.explode(F.array_compact(F.array(*tags))))


def _one_bound(parts: list[Condition], numbers: Mapping[Any, int], chosen: Column, lookup: DataFrame) -> tuple[Bound, DataFrame]:
    """The templates' bound as one; a template without gets values that pass."""
    some = next(b for p in parts for b in p.bounds)
    columns = {b.column for p in parts for b in p.bounds}
    below, above = (F.lit(v).cast(some.dtype) for v in _APART[family(some.dtype)])
    free_lookup, free_request = (below, above) if some.is_upper else (above, below)
    mine = _by(chosen, {i: p.bounds[0].request if p.bounds else free_request for i, p in zip(numbers, parts)})
    if len(columns) == 1 and all(p.bounds for p in parts):
        return Bound(some.column, some.op, mine, some.dtype), lookup
    theirs = {number: col(p.bounds[0].column).cast(some.dtype) if p.bounds else free_lookup for number, p in enumerate(parts)}
    return Bound(_CASE, some.op, mine, some.dtype), lookup.withColumn(_CASE, _by(col(TAG), theirs))

