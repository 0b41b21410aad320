"""What the physical plans look like."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lookfuse import enrich, group_rows, restrict_to_requests
from lookfuse.operators import keyfilter
from lookfuse.operators.keyfilter import filter_by_keys

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def scans(text, column):
    return [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if column in s]


def test_equality_reads_the_lookup_once_and_narrowly(t, no_broadcast):
    text = plan(
        enrich(
            t("lineitem").select("l_orderkey", "l_partkey"), t("part").where("p_size > 5"), join_key="l_partkey",
            column_names=["p_partkey as l_partkey", "p_name"],
        )
    )
    assert scans(text, "p_partkey") == ["p_partkey:bigint,p_name:string,p_size:int"]
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,5), IsNotNull(p_partkey)]" in text
    assert scans(text, "l_partkey") == ["l_orderkey:bigint,l_partkey:bigint"]
    # The reduced lookup is already partitioned by the key: one exchange for each side and none between.
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert "WindowGroupLimit" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_small_picked_side_is_broadcast(t):
    text = tree(enrich(t("lineitem"), t("part"), join_key="l_partkey", column_names=["p_partkey as l_partkey", "p_name"]))
    assert "BroadcastHashJoin" in text


def asof(t, **options):
    requests = t("events").select("event_id", "user_id", F.expr("cast('2000-01-01' as timestamp_ntz)").alias("cutoff"))
    return enrich(
        requests, t("orders"), join_key="user_id", restriction="o_custkey = {user_id} AND o_orderdate <= '{cutoff}'",
        fields=["user_id", "cutoff"], column_names=["o_custkey as user_id", "o_orderkey", "o_orderdate"],
        select=["o_orderdate desc"], **options,
    )


def test_a_bound_needs_no_join(t, no_broadcast):
    text = tree(asof(t))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    assert len(scans(plan(asof(t)), "o_orderkey")) == 1


def test_a_bound_never_joins_requests_with_all_rows_of_their_key(t, no_broadcast):
    text = tree(asof(t, split=True))
    joins = [line for line in text.splitlines() if "Join " in line]
    assert len(joins) == 1 and "LeftOuter" in joins[0]  # only requests with their own answers


def test_tests_of_the_lookup_reach_the_scan(t):
    text = plan(
        enrich(
            t("orders").select("o_orderkey", "o_custkey"), t("customer"), join_key="o_custkey", fields=["o_custkey"],
            restriction="c_custkey = {o_custkey} AND c_mktsegment = 'BUILDING'", column_names=["c_custkey as o_custkey"],
        )
    )
    assert "EqualTo(c_mktsegment,BUILDING)" in text


def test_few_keys_reach_the_scan(t):
    few = t("nation").where("n_regionkey = 2")
    text = plan(restrict_to_requests(t("customer"), few, {"n_nationkey": "c_nationkey"}))
    assert re.search(r"PushedFilters: \[.*In\(c_nationkey, \[", text)
    pushed = enrich(
        few.select("n_nationkey"), t("customer"), join_key="n_nationkey", keys=None, pushdown_keys=100,
        column_names=["c_nationkey as n_nationkey", "c_name"],
    )
    assert re.search(r"PushedFilters: \[.*In\(c_nationkey, \[", plan(pushed))
    assert "LeftSemi" in tree(restrict_to_requests(t("customer"), few, {"n_nationkey": "c_nationkey"}, max_keys=2))


def test_nothing_but_a_stated_theta_lookup_joins_without_keys(t, no_broadcast):
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for restriction in ("c_acctbal > {o_totalprice}", "c_acctbal > {o_totalprice} OR c_name = 'x'"):
        text = tree(
            enrich(orders, t("customer"), join_key="o_custkey", column_names=["c_custkey as o_custkey", "c_name"],
                   restriction=restriction, fields=["o_totalprice"])
        )
        assert "NestedLoop" not in text and "Cartesian" not in text
    opaque = enrich(
        orders, t("customer"), restriction="c_acctbal % 7 = {o_totalprice} % 7", fields=["o_totalprice"],
        allow_theta=True, column_names=["c_name"],
    )
    assert "Cartesian" not in tree(opaque)


def test_group_rows_keeps_chunks_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id").repartition(4)
    groups = group_rows(df, ["k"], ["id"], chunk_rows=50)
    facts = groups.select("k", F.size("rows").alias("n"), "rows.id").collect()
    assert max(f.n for f in facts) <= 50
    assert sorted(i for f in facts for i in f.id) == list(range(1000))
    assert all(list(f.id) == sorted(f.id) for f in facts)


def test_repartitioning_changes_nothing(t):
    orders, customer = t("orders"), t("customer").select("c_custkey")
    pick = lambda lookup: enrich(
        customer, lookup, join_key="c_custkey", column_names=["o_custkey as c_custkey", "o_orderstatus", "o_orderpriority"]
    )
    a, b = pick(orders), pick(orders.repartition(7, "o_totalprice"))
    assert a.exceptAll(b).isEmpty() and a.count() == customer.count()


def test_a_key_filter_drops_lookup_rows_before_they_are_shuffled(spark, no_broadcast):
    """Keys of several columns, of types no literal list takes; every asked key stays."""
    key = [(F.col("id") % 997).cast("double").alias("a"), F.timestamp_micros("id").alias("b")]
    lookup = spark.range(50_000).select(*key, "id")
    asked = spark.range(0, 50_000, 100).select(*key, F.col("id").alias("n"))
    filtered = filter_by_keys(lookup, ["a", "b"], asked, ["a", "b"])
    assert "Exchange" not in tree(filtered).split("Subquery")[0]
    kept = {r.id for r in filtered.collect()}
    assert kept >= set(range(0, 50_000, 100)) and len(kept) < 500 + 2_000
    none = filter_by_keys(lookup, ["a", "b"], asked.where("false"), ["a", "b"])
    assert none.count() == 0
    got = enrich(asked, lookup, keys=["a", "b"], column_names=["a", "b", "id"], semi_reduce="bloom")
    assert {r.n: r.id for r in got.collect()} == {n: n for n in range(0, 50_000, 100)}


def test_a_lookup_in_buckets_is_not_shuffled(spark, no_broadcast, tmp_path):
    from lookfuse import enrich_stream, open_lookup, requests_from_files, store_lookup

    lookup = spark.range(5_000).select((F.col("id") % 700).alias("k 1"), (F.col("id") % 3).alias("j"), "id")
    path = str(tmp_path / "lookup")
    stored = store_lookup(lookup, "by_key", ["k 1", "j"], 8, path=path)
    options = dict(keys={"a": "k 1", "b": "j"}, column_names=["id"], select=["id desc"], pushdown_keys=0)
    requests = spark.range(900).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("n"))
    want = {r.n: r.id for r in enrich(requests, lookup, **options).collect()}
    plans = []
    for table in (stored, open_lookup(spark, "by_key_again", path, ["k 1", "j"], 8)):
        df = enrich(requests, table, **options)
        plans.append(tree(df))
        assert {r.n: r.id for r in df.collect()} == want
    # The same in a micro-batch.
    requests.write.parquet(str(tmp_path / "requests"))
    stream = requests_from_files(spark, str(tmp_path / "requests"), requests.schema)
    enrich_stream(stream, stored, sink=lambda df, i: plans.append(tree(df)), trigger={"availableNow": True}, **options).awaitTermination()
    assert len(plans) >= 3
    for text in plans:
        exchanges = [i for i, line in enumerate(text.splitlines()) if "Exchange" in line]
        assert len(exchanges) == 1 and "Bucketed: true" in text
    spark.sql("DROP TABLE by_key")
    spark.sql("DROP TABLE by_key_again")


def test_a_full_key_filter_lets_rows_through(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "MAX_BITS", 1 << 12)
    lookup, asked = spark.range(20_000).withColumnRenamed("id", "k"), spark.range(0, 20_000, 2).withColumnRenamed("id", "k")
    kept = {r.k for r in filter_by_keys(lookup, ["k"], asked, ["k"]).collect()}
    assert kept >= set(range(0, 20_000, 2))
