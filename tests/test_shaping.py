"""Golden rows: projections, merge modes, statuses, NULLs, and the documented examples."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lookfuse import (
    ColumnSelector,
    KeyedEnrichment,
    LookupHandler,
    PythonSelector,
    cache_key,
    enrich,
    requests_from_rows,
    resolve_lookup,
    row_key,
)

STATUS = "__enrichment_status"


def rows(df, *by):
    return [tuple(r) for r in (df.orderBy(*by) if by else df).collect()]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(
        [("Mary", 5, "CA"), ("Mary", 3, "NY"), ("John", 4, "TX"), ("O'Brien", 1, "WA"), (None, 9, "ZZ"), ("Unasked", 7, "AL")],
        "name string, number bigint, state string",
    )


def test_names_example(spark, names):
    people = ["James", "Mary", "John", "O'Brien", "Susan"]
    requests = requests_from_rows(
        spark,
        [{"id": i, "name": n, "extra_info": f"note-{i}"} for i, n in enumerate(people)],
        "id bigint, name string, extra_info string",
    )
    enrichment = KeyedEnrichment(
        table_name=names,
        join_key_field="name",
        fields=["name"],
        row_restriction_template="name = '{name}'",
        column_names=["name", "number", "state"],
    )
    enriched = requests.transform(enrichment)
    assert enriched.columns == ["id", "name", "extra_info", "number", "state", STATUS]
    assert rows(enriched, "id") == [
        (0, "James", "note-0", None, None, "NO_BQ_DATA"),
        (1, "Mary", "note-1", 3, "NY", "SUCCESS"),
        (2, "John", "note-2", 4, "TX", "SUCCESS"),
        (3, "O'Brien", "note-3", 1, "WA", "SUCCESS"),
        (4, "Susan", "note-4", None, None, "NO_BQ_DATA"),
    ]


def test_handler_example(spark, names):
    requests = spark.createDataFrame(
        [("Mary", 1980), ("John", 1990), ("Nobody", 2020), (None, 2000)], "name string, source_year bigint"
    )
    handler = LookupHandler(
        table_name=names,
        fields=["name"],
        row_restriction_template="name = '{name}'",
        column_names=["name as found_name", "number", "state"],
    )
    pairs = handler(requests).orderBy("request.source_year").collect()
    assert [p.request.name for p in pairs] == ["Mary", "John", None, "Nobody"]
    assert pairs[0].response == Row(found_name="Mary", number=3, state="NY")
    assert [p.response is None for p in pairs] == [False, False, True, True]
    merged = handler(requests, mode="overwrite").orderBy("source_year")
    assert rows(merged.select("name", "found_name", "number"))[0] == ("Mary", "Mary", 3)


def test_profiles_example(spark):
    requests = spark.createDataFrame(
        [("u-17", "US", "early"), ("u-18", "EU", "middle"), ("u-17", "US", "later"), ("u-19", "US", "none")],
        "user_id string, region string, other_data string",
    )
    profiles = spark.createDataFrame(
        [
            ("u-17", "US", "old@x", "active", None),
            ("u-17", "US", "new@x", "active", "2023-01-02"),
            ("u-17", "EU", "eu@x", "active", "2024-01-02"),
            ("u-18", "EU", "b@x", "idle", "2022-05-05"),
            ("u-18", "US", "wrong@x", "idle", "2025-05-05"),
        ],
        "profile_id string, user_region string, email string, status string, last_login string",
    )
    common = dict(
        table_name=profiles,
        join_key_field="user_id",
        fields=["user_id", "region"],
        row_restriction_template="profile_id = '{user_id}' AND user_region = '{region}'",
        column_names=["profile_id as user_id", "email", "status", "last_login"],
    )
    want = [("early", "new@x"), ("later", "new@x"), ("middle", "b@x"), ("none", None)]

    def latest(matches):
        return max(matches, key=lambda r: r["last_login"] or "")

    for select in (["last_login desc nulls last"], PythonSelector(latest), PythonSelector(latest, decomposable=True)):
        enriched = requests.transform(KeyedEnrichment(select=select, **common))
        assert rows(enriched.select("other_data", "email"), "other_data") == want


def test_nested_example(spark):
    requests = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    lookup = spark.createDataFrame(
        [(1, "a@x", "on", dt.datetime(2024, 1, 1)), (1, "b@x", "off", dt.datetime(2024, 2, 1))],
        "id bigint, email string, status string, timestamp_field timestamp",
    )
    enriched = enrich(
        requests, lookup, join_key="user_id", fields=["user_id"], restriction="id = {user_id}",
        column_names=["id as user_id", "email", "status", "timestamp_field"],
        select=["timestamp_field desc"], mode="add_nested", nested_key="found",
    )
    first, second = enriched.orderBy("user_id").collect()
    assert first.found == Row(user_id=1, email="b@x", status="off", timestamp_field=dt.datetime(2024, 2, 1))
    assert second.found is None and second[STATUS] == "NO_BQ_DATA"


def test_signup_example(spark):
    requests = spark.createDataFrame([("u", dt.date(2024, 3, 1)), ("v", dt.date(2024, 3, 1))], "user_id string, signup_date date")
    lookup = spark.createDataFrame([("u", dt.date(2024, 2, 10)), ("v", dt.date(2024, 1, 1))], "id string, signup_date date")

    def condition(values, row):
        return [("id", "=", values["user_id"]), ("signup_date", ">", row.signup_date - F.expr("interval 30 days"))]

    enriched = enrich(
        requests, lookup, join_key="user_id", fields=["user_id"], restriction=condition,
        column_names=["id as user_id", "signup_date as found"],
    )
    assert rows(enriched.select("user_id", "found"), "user_id") == [("u", dt.date(2024, 2, 10)), ("v", None)]


@pytest.fixture(scope="module")
def clash(spark):
    requests = spark.createDataFrame(
        [(1, "mine", "old", "keep"), (2, "mine", "old", "keep"), (None, "mine", "old", "keep")],
        f"k bigint, v string, `{STATUS}` string, info string",
    )
    lookup = spark.createDataFrame([(1, None, 7), (None, "x", 8)], "k bigint, v string, w int")
    return requests, lookup


def test_merge_new_keeps_the_request(clash):
    enriched = enrich(*clash, join_key="k")
    assert enriched.columns == ["k", "v", "info", "w", STATUS]
    assert rows(enriched, "k") == [(1, "mine", "keep", 7, "SUCCESS"), (2, "mine", "keep", None, "NO_BQ_DATA")]


def test_overwrite_takes_even_a_null(clash):
    enriched = enrich(*clash, join_key="k", mode="overwrite", null_keys="keep", status=False)
    assert rows(enriched.select("k", "v", "w"), "k") == [(None, "mine", None), (1, None, 7), (2, "mine", None)]


def test_nested_replaces_a_request_column(clash):
    enriched = enrich(*clash, join_key="k", mode="add_nested", nested_key="info")
    assert rows(enriched.select("k", "info"), "k") == [(1, Row(k=1, v=None, w=7)), (2, None)]


def test_pairs(clash):
    pairs = enrich(*clash, keys=["k"], mode="pairs", null_keys="keep", match_count=True)
    assert pairs.columns == ["request", "response", "__match_count"]
    found = {p.request.k: (p.response, p["__match_count"]) for p in pairs.collect()}
    assert found == {1: (Row(k=1, v=None, w=7), 1), 2: (None, 0), None: (None, 0)}


def test_odd_column_names(spark):
    requests = spark.createDataFrame([(1, "x")], "`my key` bigint, `a.b` string")
    lookup = spark.createDataFrame([(1, 2, 3)], "`my key` bigint, `c.d` int, `e` int")
    enriched = enrich(
        requests, lookup, join_key="my key", restriction="e > {n}", condition_value_fn=lambda r: {"n": F.lit(1)},
        column_names=["c.d as f.g", "my key"], select=["c.d desc"],
    )
    assert enriched.columns == ["my key", "a.b", "f.g", STATUS] and rows(enriched) == [(1, "x", 2, "SUCCESS")]


def test_letter_case_follows_the_session(spark):
    requests = spark.createDataFrame([(1, "r")], "Key bigint, Name string")
    lookup = spark.createDataFrame([(1, "l")], "KEY bigint, NAME string")
    assert rows(enrich(requests, lookup, join_key="key", status=False)) == [(1, "r")]
    assert rows(enrich(requests, lookup, join_key="key", status=False, mode="overwrite")) == [(1, "l")]


def test_types_pass_through(spark):
    lookup = spark.sql(
        "select 1 k, cast(1.5 as decimal(38,9)) d, X'00ff' b, date'2024-01-01' dd, timestamp'2024-01-01 01:02:03' t,"
        " timestamp_ntz'2024-01-01 01:02:03' n, array(1, null) a, struct(1 x, 'y' y) s, map('a', 1) m, true f,"
        " cast('nan' as double) nan"
    )
    enriched = enrich(spark.range(1, 3).withColumnRenamed("id", "k"), lookup, join_key="k", select=["t desc"])
    assert [f.dataType for f in enriched.schema.fields[1:-1]] == [f.dataType for f in lookup.schema.fields[1:]]
    bound = enrich(
        spark.range(1, 3).withColumnRenamed("id", "k"), lookup, join_key="k", condition_value_fn=lambda r: {"k": r.k},
        restriction="dd < '2025-01-01' AND k <= {k}", select=["b"], match_count=True,
    )
    assert bound.where("k = 1").select("m", "d").collect()[0].m == {"a": 1}


def test_key_types(spark):
    ints = spark.createDataFrame([(1,), (2,)], "k int")
    longs = spark.createDataFrame([(1, "x")], "k bigint, v string")
    texts = spark.createDataFrame([("1", "t"), ("oops", "u")], "k string, v string")
    assert rows(enrich(ints, longs, join_key="k").select("k", "v"), "k") == [(1, "x"), (2, None)]
    assert rows(enrich(ints, texts, join_key="k", cast_keys={"k": "bigint"}).select("k", "v"), "k") == [(1, "t"), (2, None)]


@pytest.mark.parametrize("split", [False, True])
def test_statuses_of_a_declining_selector(spark, split):
    requests = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    lookup = spark.createDataFrame([(1, 5), (1, 6), (2, 1)], "k bigint, v int")
    big = lambda found: F.get(F.filter(found, lambda r: r["v"] > 3), 0)
    for selector in (
        big,
        ColumnSelector(big, decomposable=True),
        PythonSelector(lambda found: next((r for r in found if r["v"] > 3), {})),
        PythonSelector(lambda found: next((r for r in found if r["v"] > 3), None), decomposable=True),
        PythonSelector(lambda found: next((r for r in found if r.v > 3), None), rows_as="row"),
    ):
        enriched = enrich(requests, lookup, join_key="k", select=selector, split=split, match_count=True)
        assert rows(enriched, "k") == [
            (1, 5, "SUCCESS", 2), (2, None, "BQ_SELECTION_FAILED", 1), (3, None, "NO_BQ_DATA", 0)
        ]


def test_selector_fallbacks(spark):
    requests = spark.createDataFrame([(1,)], "k bigint")
    lookup = spark.createDataFrame([(1, 5), (1, 3)], "k bigint, v int")

    def fails(found):
        raise RuntimeError("no")

    cases = {
        3: [fails, lambda found: "text", lambda found: 5],
        9: [lambda found: {"k": 1, "v": 9}],
    }
    for value, functions in cases.items():
        for fn in functions:
            assert enrich(requests, lookup, join_key="k", select=PythonSelector(fn)).first().v == value
    none = PythonSelector(lambda found: None, none_means="first")
    assert enrich(requests, lookup, join_key="k", select=none).first().v == 3


def test_selector_with_its_own_schema(spark):
    from pyspark.sql import types as T

    requests = spark.createDataFrame([(1,)], "k bigint")
    lookup = spark.createDataFrame([(1, 5), (1, 3)], "k bigint, v int")
    schema = T.StructType([T.StructField("total", T.LongType())])
    selector = PythonSelector(lambda found: {"total": sum(r["v"] for r in found)}, schema=schema)
    assert enrich(requests, lookup, join_key="k", select=selector).first().total == 8


def test_selector_sees_the_request(spark):
    requests = spark.createDataFrame([(1, 10), (1, 4), (1, None)], "k bigint, near int")
    lookup = spark.createDataFrame([(1, 5), (1, 11)], "k bigint, v int")
    near = lambda found, request: min(found, key=lambda r: abs(r.v - request.near))
    enriched = enrich(requests, lookup, join_key="k", select=PythonSelector(near, rows_as="row"))
    assert rows(enriched.select("near", "v"), "near") == [(None, 5), (4, 5), (10, 11)]


@pytest.mark.parametrize("split", [False, True])
def test_a_group_too_large_for_a_selector_fails(spark, split):
    requests = spark.createDataFrame([(1,)], "k bigint")
    lookup = spark.range(50).select(F.lit(1).cast("bigint").alias("k"), "id").repartition(3)
    last = lambda found: F.get(found, F.size(found) - 1)
    assert enrich(requests, lookup, join_key="k", select=ColumnSelector(last, max_group_rows=50), split=split).first().id == 49
    with pytest.raises(Exception, match="more than 49 matching rows"):
        enrich(requests, lookup, join_key="k", select=ColumnSelector(last, max_group_rows=49), split=split).collect()


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, n string")
    got = df.select(row_key(df, ["n", "k"]).alias("r"), cache_key(df, ["n", "k"]).alias("c")).collect()
    assert got[0].r == Row(k=1, n="a") and got[0].c == '{"k":1,"n":"a"}'
    assert got[1].r is None and got[1].c == "__invalid_key__"
    assert df.select(cache_key(df, ["n", "none"]).alias("c")).first().c == "__invalid_key__"
    by_fn = dict(condition_value_fn=lambda r: {"k2": r.k * 2})
    assert df.select(cache_key(df, **by_fn).alias("c")).first().c == '{"k2":2}'
    assert df.select(cache_key(df, condition_value_fn=lambda r: None).alias("c")).first().c == "__invalid_key__"
    with pytest.raises(ValueError):
        row_key(df)


def test_condition_values_as_key(spark):
    requests = spark.createDataFrame([(1, "A"), (2, "b")], "k bigint, n string")
    lookup = spark.createDataFrame([(1, "a", 5), (2, "a", 6)], "k bigint, name string, v int")
    handler = LookupHandler(
        lookup, row_restriction_template="v > 1", condition_value_fn=lambda r: {"k": r.k, "n": F.lower(r.n)},
        column_names=["k", "name as n", "v"],
    )
    assert rows(handler(requests, "merge_new").select("k", "v"), "k") == [(1, 5), (2, None)]
    single = LookupHandler(
        lookup, row_restriction_template="name = '{n}' AND v > {k}", condition_value_fn=lambda r: {"k": r.k, "n": F.lower(r.n)},
        by_key=False, column_names=["v"], latest_value_selector=["v desc"],
    )
    assert rows(single(requests, "merge_new").select("k", "v"), "k") == [(1, 6), (2, None)]


def test_primary_keys_reach_the_function_and_the_output(spark):
    requests = spark.createDataFrame([(1, 2)], "k bigint, p int")
    lookup = spark.createDataFrame([(1, 2, 5), (1, 3, 4)], "k bigint, p int, v int")

    def condition(values, primary_keys, row):
        return F.col(primary_keys[0]) == row[primary_keys[0]]

    handler = LookupHandler(
        lookup, row_restriction_template_fn=condition, fields=["k"], primary_keys=["p"], column_names=["v"]
    )
    assert handler(requests).first().response == Row(v=5, k=1, p=2)


def test_whole_condition_on_the_lookup(spark):
    requests = spark.createDataFrame([(1,), (2,)], "k bigint")
    lookup = spark.createDataFrame([("a", 5), ("b", 6)], "n string, v int")
    enriched = enrich(requests, lookup, restriction="n = 'b'", fields=["k"], allow_theta=True)
    assert rows(enriched.select("k", "v"), "k") == [(1, 6), (2, 6)]


def test_lookup_from_catalog_and_path(spark, names, tmp_path):
    path = str(tmp_path / "names")
    names.write.parquet(path)
    assert resolve_lookup(spark, path, max_parallel=1).rdd.getNumPartitions() == 1
    assert resolve_lookup(spark, path, format="parquet", mergeSchema="false").count() == names.count()
    names.createOrReplaceTempView("ignored")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        resolve_lookup(spark, "spark_catalog.default.no_such_table").collect()


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("templates", ["keys", "bounds"])
def test_choice_of_templates(spark, no_broadcast, split, templates):
    requests = spark.createDataFrame(
        [(i, i % 4, "abcd"[i % 4] if i % 5 else None, i % 3) for i in range(40)], "id int, k bigint, t string, m int"
    )
    lookup = spark.createDataFrame([(i % 4, i % 3, i) for i in range(24)], "k bigint, m int, v int")
    choices = {
        "keys": {"a": "m = {m}", "b": "m = {m} AND v > 12", "c": "m = {m} AND v < 3"},
        "bounds": {"a": "m = {m}", "b": "v > 12", "c": "v < {m}"},
    }[templates]
    enriched = enrich(
        requests, lookup, join_key="k", restriction=choices, template_id="t", fields=["m"], select=["v desc"],
        column_names=["k", "v"], split=split, match_count=True,
    )
    tests = {
        "keys": {"a": lambda q, r: r[1] == q[3], "b": lambda q, r: r[1] == q[3] and r[2] > 12, "c": lambda q, r: r[1] == q[3] and r[2] < 3},
        "bounds": {"a": lambda q, r: r[1] == q[3], "b": lambda q, r: r[2] > 12, "c": lambda q, r: r[2] < q[3]},
    }[templates]
    entries, want = [tuple(r) for r in lookup.collect()], []
    for q in sorted(tuple(r) for r in requests.fillna({"t": "-"}).collect()):
        found = [r[2] for r in entries if r[0] == q[1] and q[2] in tests and tests[q[2]](q, r)]
        want.append((q[0], max(found) if found else None, len(found)))
    assert rows(enriched.select("id", "v", "__match_count"), "id") == want


def test_failed_casts_leave_a_request_unmatched(spark):
    requests = spark.createDataFrame([("1",), ("oops",)], "k string")
    lookup = spark.createDataFrame([(1, "x")], "id bigint, v string")
    enriched = enrich(
        requests, lookup, condition_value_fn=lambda r: {"n": r.k.try_cast("bigint")}, restriction="id = {n}",
        column_names=["v"],
    )
    assert rows(enriched.select("k", "v"), "k") == [("1", "x"), ("oops", None)]


def test_python_selectors_pass_all_types(spark):
    lookup = spark.sql(
        "select 1 k, cast(1.5 as decimal(38,9)) d, X'00ff' b, date'2024-01-01' dd, timestamp'2024-01-01 01:02:03' t,"
        " timestamp_ntz'2024-01-01 01:02:03' n, array(1, null) a, struct(1 x, 'y' y) s, true f, cast(null as string) z"
    )
    earlier = lookup.withColumn("t", F.expr("t - interval 1 day"))
    requests = spark.range(1, 3).withColumnRenamed("id", "k")
    latest = PythonSelector(lambda found: max(found, key=lambda r: r["t"]), decomposable=True, chunk_rows=1)
    got = enrich(requests, lookup.union(earlier), join_key="k", select=latest).where("k = 1").drop("__enrichment_status")
    assert got.collect() == lookup.withColumn("k", F.lit(1).cast("bigint")).collect()


def test_results_can_be_enriched_again(spark):
    requests = spark.createDataFrame([(1, 1), (2, 9)], "k bigint, j bigint")
    lookup = spark.createDataFrame([(1, "x")], "k bigint, v string")
    once = enrich(requests, lookup, join_key="k", match_count=True)
    twice = enrich(once, lookup, keys={"j": "k"}, column_names=["v as w"], select=["v"])
    assert rows(twice.select("k", "v", "w", STATUS), "k") == [(1, "x", "x", "SUCCESS"), (2, None, None, "NO_BQ_DATA")]
    back = enrich(lookup, twice, join_key="k", column_names=["w", "j"])
    assert rows(back.select("k", "w")) == [(1, "x")]
