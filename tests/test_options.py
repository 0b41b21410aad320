"""What is refused, and that it is refused when the plan is built."""

import pytest
from pyspark.sql import functions as F

from lookfuse import KeyedEnrichment, LookupHandler, PythonSelector, enrich, resolve_lookup, restrict_to_requests
from lookfuse.functions.columns import parse_column_names
from lookfuse.plans.options import Options

VALUES = lambda row: {"k": row.k}


@pytest.mark.parametrize(
    "options",
    [
        dict(),
        dict(join_key="k", mode="replace"),
        dict(join_key="k", mode="add_nested"),
        dict(join_key="k", null_keys="maybe"),
        dict(join_key="k", keys=["k"]),
        dict(keys="k"),
        dict(keys="condition_values"),
        dict(join_key="k", restriction="a = {k}"),
        dict(join_key="k", restriction="a = {k}", fields=["k"], condition_value_fn=VALUES),
        dict(join_key="k", restriction="  ", fields=["k"]),
        dict(join_key="k", restriction="a = {k}", condition_value_fn=VALUES, additional_condition_fields=["a"]),
        dict(join_key="k", restriction={"a": "a = {k}"}, fields=["k"]),
        dict(join_key="k", restriction={}, fields=["k"], template_id="t"),
        dict(join_key="k", restriction="a = {k}", fields=["k"], template_id="t"),
        dict(restriction="a = {k}", fields=["k"], scope="any_request"),
        dict(join_key="k", scope="any_request"),
        dict(join_key="k", representative=[]),
        dict(join_key="k", duplicates="first"),
        dict(join_key="k", duplicates="some"),
        dict(join_key="k", split="never"),
        dict(join_key="k", pushdown_keys=-1),
    ],
)
def test_contract(options):
    with pytest.raises(ValueError):
        Options(**options)


@pytest.mark.parametrize(
    "options",
    [
        dict(),
        dict(row_restriction_template="a = {k}", row_restriction_template_fn=VALUES, fields=["k"]),
        dict(row_restriction_template="a = {k}"),
        dict(row_restriction_template="a = {k}", fields=["k"], condition_value_fn=VALUES),
        dict(row_restriction_template="a = {k}", condition_value_fn=VALUES, additional_condition_fields=["k"]),
    ],
)
def test_presets(options):
    with pytest.raises(ValueError):
        KeyedEnrichment("c.d.t", "k", **options)
    with pytest.raises(ValueError):
        LookupHandler("c.d.t", **options)


def test_preset_names_are_required():
    good = dict(row_restriction_template="a = {k}", fields=["k"])
    for wrong in (lambda: KeyedEnrichment("", "k", **good), lambda: KeyedEnrichment("c.d.t", "", **good), lambda: LookupHandler("", **good)):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(ValueError):
        KeyedEnrichment("c.d.t", "k", enrichment_mode="overwrite", **good)
    with pytest.raises(ValueError):
        KeyedEnrichment("c.d.t", "k", enrichment_mode="add_nested", **good)


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame([(1, "a", 5)], "k bigint, name string, m int"),
        spark.createDataFrame([(1, "a", 5)], "k bigint, name string, x int"),
    )


@pytest.mark.parametrize(
    "options,message",
    [
        (dict(join_key="none"), "no key field"),
        (dict(join_key="m"), "no key column"),
        (dict(keys={"k": "name"}), "never equal"),
        (dict(join_key="k", column_names=["y"]), "no column"),
        (dict(join_key="k", column_names=["k as x", "x"]), "Several"),
        (dict(join_key="k", select=["y desc"]), "order column"),
        (dict(join_key="k", restriction="x > {m}", fields=["k"]), "Placeholder"),
        (dict(join_key="k", restriction="x > {}", fields=["k"]), "Placeholder"),
        (dict(join_key="k", restriction="x > {z}", fields=["z"]), "no field"),
        (dict(join_key="k", restriction="x > 1", condition_value_fn=lambda r: {}), "no values"),
        (dict(join_key="k", restriction="x > 1", condition_value_fn=lambda r: None), "no values"),
        (dict(join_key="k", restriction=lambda v, r: 5, fields=["k"]), "returns a Column"),
        (dict(join_key="k", restriction=lambda v, r: ("x", "~", v["k"]), fields=["k"]), "Operator"),
        (dict(join_key="k", restriction=lambda v, r: ("y", "=", v["k"]), fields=["k"]), "no column"),
        (dict(restriction="x > {m}", fields=["m"]), "allow_theta"),
        (dict(keys="condition_values", condition_value_fn=lambda r: {"m": r.m}), "cannot read"),
    ],
)
def test_plan_time_errors(tables, options, message):
    with pytest.raises(ValueError, match=message):
        enrich(*tables, **options)


def test_unknown_lookup_name_in_a_test_fails_when_planned(tables):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        enrich(*tables, join_key="k", restriction="no_such > 1 AND k = {k}", fields=["k"])


def test_reserved_request_columns(tables):
    requests, lookup = tables
    with pytest.raises(ValueError, match="internally"):
        enrich(requests.withColumn("__hit", F.lit(1)), lookup, join_key="k")


@pytest.mark.parametrize("name", ["__lk_k", "__hit"])
def test_reserved_lookup_columns(spark, name):
    requests, lookup = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 2)], f"k int, {name} int")
    with pytest.raises(ValueError, match="Lookup columns .* internally"):
        enrich(requests, lookup, join_key="k")


@pytest.mark.parametrize("names", [[""], ["  "], [" as b"], ["a as "], ["*", ""][1:]])
def test_empty_names(names):
    with pytest.raises(ValueError):
        parse_column_names(names)


def test_column_lists():
    assert parse_column_names(None).everything and parse_column_names([]).everything
    parsed = parse_column_names(["a as b", " c  AS  d as e ", "f"])
    assert parsed.names == ("a", "c", "f") and parsed.renames == {"a": "b", "c": "d as e"}
    stopped = parse_column_names(["a as b", "*", ""])
    assert stopped.everything and stopped.renames == {"a": "b"}


def test_lookup_names(spark, tables):
    assert resolve_lookup(spark, tables[1]) is tables[1]
    for wrong in ("", "table", "db.table", "a.b.c.d", "a..c", None):
        with pytest.raises(ValueError):
            resolve_lookup(spark, wrong)
    with pytest.raises(ValueError):
        resolve_lookup(spark, tables[1], max_parallel=0)
    with pytest.raises(ValueError):
        restrict_to_requests(tables[1], tables[0], {"m": "none"})
    with pytest.raises(ValueError):
        restrict_to_requests(tables[1], tables[0], {"k": "name"})


def test_selector_options():
    for wrong in (dict(rows_as="tuple"), dict(none_means="fail")):
        with pytest.raises(ValueError):
            PythonSelector(max, **wrong)
