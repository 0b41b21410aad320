"""Two-sided ranges against a row-by-row model, and what their plans look like."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from lookfuse import enrich
from lookfuse.operators import blocks
from lookfuse.operators.ranges import Range, enter_ranges
from lookfuse.plans import enrich as planned
from reference_model import pick
from test_split import COMMON, KINDS, hash_seed, rows, tables


def tree(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def expected(requests, lookup, test, order):
    found = pick(requests, lookup, test, order, ["x", "v", "p"])
    return {q["id"]: (m and m["x"], m and m["v"], m and m["p"], "SUCCESS" if m else "NO_BQ_DATA", n) for q, m, n in found}


def two_values(spark, kind, seed):
    """Requests with two values, in no order, and a lookup with two range columns."""
    requests, lookup, _, _ = tables(spark, kind, seed)
    pick_one = random.Random(seed)
    make = KINDS[kind]
    requests = [dict(q, c=None if pick_one.random() < 0.1 else make(pick_one)) for q in requests]
    lookup = [dict(r, y=None if pick_one.random() < 0.1 else make(pick_one)) for r in lookup]

    def frame(found, ddl):
        names = [c.split()[0] for c in ddl.split(", ")]
        return spark.createDataFrame([tuple(x[n] for n in names) for x in found], ddl).repartition(5)

    rq = frame(requests, f"id bigint, k bigint, b {kind}, c {kind}, m int")
    lk = frame(lookup, f"k bigint, x {kind}, y {kind}, v int, p string")
    return requests, lookup, rq, lk


def between(q, r, high="x", low="x"):
    if None in (r[high], r[low], q["b"], q["c"]):
        return False
    return r[high] <= q["b"] and r[low] > q["c"]


@pytest.mark.parametrize("kind,split", [
    ("bigint", True), ("double", False), ("string", False), ("timestamp_ntz", True), ("decimal(10,2)", False),
])
def test_keyed_and_keyless(spark, no_broadcast, split, kind):
    requests, lookup, rq, lk = two_values(spark, kind, hash_seed(kind, "two"))
    options = dict(condition_value_fn=lambda r: {"b": r.b, "c": r.c}, select=["o_v desc"], split=split, match_count=True)
    names = dict(column_names=COMMON["column_names"])
    keyed = [q for q in requests if q["k"] is not None]
    # A range around lookup points, and lookup ranges around request points or ranges.
    for high in ("x", "y"):
        restriction = lambda v, row: [(high, "<=", v["b"]), ("x", ">", v["c"])]  # noqa: B023, E731
        df = enrich(rq, lk, join_key="k", restriction=restriction, **names, **options)
        test = lambda q, r: r["k"] == q["k"] and between(q, r, high)  # noqa: B023, E731
        assert rows(df) == expected(keyed, lookup, test, [("v", True)])
        df = enrich(rq, lk, restriction=restriction, allow_theta=True, **names, **options)
        assert "Cartesian" not in tree(df) and "NestedLoop" not in tree(df)
        assert rows(df) == expected(requests, lookup, lambda q, r: between(q, r, high), [("v", True)])  # noqa: B023


@pytest.mark.parametrize("split", [False, True])
def test_any_request(spark, no_broadcast, split):
    requests, lookup, rq, lk = two_values(spark, "bigint", 11)
    for high in ("x", "y"):
        for declared, restriction in ((["k"], [(high, "<=", "b"), ("x", ">", "c")]), (["k"], [(high, "<=", "b"), ("x", ">", "c"), ("v", "=", "m")])):
            df = enrich(
                rq, lk, keys=declared, restriction=lambda v, row: [(c, op, v[n]) for c, op, n in restriction],  # noqa: B023
                condition_value_fn=lambda r: {"b": r.b, "c": r.c, "m": r.m}, scope="any_request", allow_theta=True,
                column_names=COMMON["column_names"], select=["o_v desc"], split=split, match_count=True,
            )
            asking = [q for q in requests if None not in (q["k"], q["b"], q["c"])]
            with_m = len(restriction) == 3
            admitted = [r for r in lookup if any(between(q, r, high) and (not with_m or q["m"] == r["v"]) for q in asking)]
            want = expected([q for q in requests if q["k"] is not None], admitted, lambda q, r: r["k"] == q["k"] and None not in (q["b"], q["c"]), [("v", True)])
            assert rows(df) == want
            assert "Cartesian" not in tree(df) and "NestedLoop" not in tree(df)


def test_with_other_tests_and_selectors(spark, no_broadcast):
    requests, lookup, rq, lk = two_values(spark, "bigint", 5)
    keyed = [q for q in requests if q["k"] is not None and q["b"] is not None]
    for split in (False, True):
        df = enrich(
            rq, lk, join_key="k", fields=["b", "m"], restriction="x <= {b} AND x >= {b} - 9 AND v % 4 <> {m}",
            column_names=COMMON["column_names"], select=["o_v", "o_x"], match_count=True, split=split, null_keys="drop",
        ).where("b is not null and k is not null")

        def test(q, r):
            return r["k"] == q["k"] and None not in (r["x"], r["v"]) and q["b"] - 9 <= r["x"] <= q["b"] and r["v"] % 4 != q["m"]

        assert rows(df) == expected(keyed, lookup, test, [("v", False), ("x", False)])
        best = enrich(
            rq, lk, join_key="k", fields=["b"], restriction="x <= {b} AND x >= {b} - 9", split=split,
            column_names=COMMON["column_names"], select=lambda found: F.element_at(F.array_sort(found), -1),
        ).where("b is not null and k is not null")
        got = {r.id: (r.o_x, r.o_v, r.o_p) for r in best.collect()}
        for q in keyed:
            found = [(r["x"], r["v"], r["p"]) for r in lookup if r["k"] == q["k"] and r["x"] is not None and q["b"] - 9 <= r["x"] <= q["b"]]
            want = max(found, key=lambda t: (t[0], t[1] is not None, t[1] or 0, t[2]), default=(None, None, None))
            assert got[q["id"]] == want


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("text,kind", [
    ("abs(x - {b}) < 3", "bigint"), ("ABS( {b} - x ) <= {m}", "double"), ("abs(x - {b}) <= 0.25", "decimal(10,2)"),
    ("abs(x - {b}) < 0", "bigint"), ("k = {k} AND abs(x - {b}) <= {m} AND v > 1", "double"),
])
def test_distances(spark, no_broadcast, split, text, kind):
    requests, lookup, rq, lk = two_values(spark, kind, hash_seed(kind, text))
    df = enrich(
        rq, lk, restriction=text, fields=["b", "m"] + ["k"] * ("{k}" in text), allow_theta=True, select=["o_v desc"], split=split,
        match_count=True, column_names=["x as o_x", "v as o_v", "p as o_p"],
    )
    shown = tree(df)
    assert "Cartesian" not in shown and "NestedLoop" not in shown
    far = {"abs(x - {b}) < 3": lambda d, q: d < 3, "abs(x - {b}) <= 0.25": lambda d, q: d * 4 <= 1, "abs(x - {b}) < 0": lambda d, q: False}.get(text, lambda d, q: d <= q["m"])

    def test(q, r):
        if None in (q["b"], r["x"]) or ("{k}" in text and (q["k"] is None or q["k"] != r["k"] or r["v"] is None or r["v"] <= 1)):
            return False
        return far(abs(r["x"] - q["b"]), q)

    assert rows(df) == expected(requests, lookup, test, [("v", True)])


def test_wide_ranges_make_few_pairs(spark):
    """Every request matches a third of the lookup; what it takes grows with the logarithm of that."""
    n = 20_000
    lookup = spark.range(n).select((F.col("id") * 7919 % n).alias("x"), F.col("id").alias("v"))
    requests = spark.range(500).select("id", (F.col("id") * 13).alias("a"), (F.col("id") * 13 + n // 3).alias("b"))
    seen = []
    pairs, blocks_attach = blocks.matching_pairs, blocks.attach

    def counted(*args, **more):
        found = pairs(*args, **more)
        seen.append(found[0].count())
        return found

    def attached(asked, *args, **more):
        seen.append(asked.count())
        return blocks_attach(asked, *args, **more)

    blocks.matching_pairs, blocks.attach = counted, attached
    try:
        df = enrich(
            requests, lookup, restriction="x >= {a} AND x < {b}", fields=["a", "b"], allow_theta=True, select=["v desc"],
            column_names=["v"], match_count=True, split=False,
        )
    finally:
        blocks.matching_pairs, blocks.attach = pairs, blocks_attach
    got = {r.id: (r.v, r["__match_count"]) for r in df.collect()}
    of = {i * 7919 % n: i for i in range(n)}
    assert got == {i: (max(of[x] for x in range(i * 13, min(i * 13 + n // 3, n))), min(n // 3, n - i * 13)) for i in range(500)}
    # 3.3 million pairs match; tested or looked up are some dozens a request.
    assert len(seen) == 2 and sum(seen) < 500 * 60


def test_odd_numbers(spark, no_broadcast):
    """Infinities, NaN and values beyond the precision of doubles."""
    odd = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 1e308, 5e-324, 1.5]
    for kind, values in (("double", odd), ("bigint", [2**62 + i for i in range(8)] + [-(2**63), 2**63 - 1])):
        rq = spark.createDataFrame([(i * 100 + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)], f"id long, b {kind}, c {kind}")
        lk = spark.createDataFrame([(v, i) for i, v in enumerate(values * 5)], f"x {kind}, v long")
        df = enrich(
            rq, lk, restriction="x >= {b} AND x <= {c}", fields=["b", "c"], allow_theta=True, select=["v desc"],
            column_names=["x", "v"], match_count=True,
        )
        pairs = rq.join(lk, (F.col("x") >= F.col("b")) & (F.col("x") <= F.col("c"))).groupBy("id").agg(F.count("*").alias("n"), F.max("v").alias("v"))
        want = {r.id: (r.n, r.v) for r in pairs.collect()}
        assert {r.id: (r["__match_count"], r.v) for r in df.collect()} == {r.id: want.get(r.id, (0, None)) for r in rq.select("id").collect()}


def test_pairs_tested_follow_the_matches(spark):
    """Ten times the rows, ten times the pairs that are tested, not a hundred times; wide ranges are not cut small."""

    def tested(n):
        points = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"), F.col("id").alias("v"))
        asked = spark.range(n).select((F.col("id") * 104729 % n).cast("double").alias("a")).withColumn("b", F.col("a") + 3)
        ranges = Range(F.col("b"), F.col("a"), asked.schema["a"].dataType), Range(F.col("x"), F.col("x"), points.schema["x"].dataType)
        probes, mine, lookup, theirs, meet = enter_ranges(asked, ranges[0], points, ranges[1])
        same = [probes[m] == lookup[t] for m, t in zip(mine, theirs)]
        met = probes.join(lookup, same).where(meet)
        return met.count(), met.where("x between a and b").count(), lookup.count(), probes.count()

    small, large = tested(3_000), tested(30_000)
    for n, (met, matches, entries, homes) in ((3_000, small), (30_000, large)):
        assert matches >= 4 * n - 10 and entries <= 8 * n and homes <= 4 * n
    assert large[0] <= 12 * small[0]
    wide = spark.range(200).select((F.col("id") * 1.0).alias("a"), (F.col("id") * 1.0 + 29_000).alias("b"))
    points = spark.range(30_000).select((F.col("id") * 1.0).alias("x"))
    kind = wide.schema["a"].dataType
    probes, *_ = enter_ranges(wide, Range(F.col("a"), F.col("b"), kind), points, Range(F.col("x"), F.col("x"), kind))
    assert probes.count() <= 400


@pytest.fixture
def made(monkeypatch):
    """Pairs and blocks that are joined while plans are built."""
    seen = []

    def watch(module, name):
        real = getattr(module, name)

        def watched(*args, **more):
            found = real(*args, **more)
            seen.append(found[0] if isinstance(found, tuple) else found)
            return found

        monkeypatch.setattr(module, name, watched)

    watch(blocks, "matching_pairs")
    watch(blocks, "attach")
    watch(planned, "matching_pairs")
    return seen


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("options", [
    dict(restriction="x >= {a} AND x < {c}", select=["v desc"]),
    dict(restriction="abs(x - {a}) < 3", select=["v desc"]),
    dict(restriction="abs(x - {a}) < 3", select=lambda found: F.get(found, 0)),
    dict(restriction="x <= {a} AND y > {a}", select=["v desc"]),
])
def test_sides_with_several_entries_are_not_broadcast(spark, options, split, made):
    """Spark reckons an exploded side as if every row had one entry."""
    lookup = spark.range(300).select(F.col("id").cast("double").alias("x"), (F.col("id") + 5.0).alias("y"), F.col("id").alias("v"))
    requests = spark.range(100).select("id", (F.col("id") * 2.0).alias("a"), (F.col("id") * 2.0 + 9).alias("c"))
    df = enrich(requests, lookup, fields=["a", "c"], allow_theta=True, column_names=["v"], split=split, **options)
    assert df.count() == 100 and made
    for joined in made:
        assert "SortMergeJoin" in tree(joined) and "BroadcastHashJoin" not in tree(joined)


@pytest.mark.parametrize("kind,split", [("bigint", True), ("double", False), ("timestamp_ntz", False)])
def test_ranges_around_a_value(spark, no_broadcast, split, kind):
    requests, lookup, rq, lk = two_values(spark, kind, hash_seed(kind, "around"))
    for keyed, text, test in (
        (True, "x <= {b} AND y > {b}", lambda q, r: r["x"] <= q["b"] < r["y"]),
        (False, "x < {b} AND y >= {b}", lambda q, r: r["x"] < q["b"] <= r["y"]),
    ):
        more = dict(join_key="k") if keyed else dict(allow_theta=True)
        text = text.replace("{b}", "'{b}'") if kind == "timestamp_ntz" else text
        df = enrich(rq, lk, restriction=text, fields=["b"], select=["o_v desc"], split=split, match_count=True, column_names=COMMON["column_names"], **more)

        def whole(q, r):
            return None not in (q["b"], r["x"], r["y"]) and (not keyed or q["k"] == r["k"]) and test(q, r)  # noqa: B023

        assert rows(df) == expected([q for q in requests if not keyed or q["k"] is not None], lookup, whole, [("v", True)])


def test_wide_ranges_around_values_make_few_pairs(spark, made):
    """Every lookup row holds a third of the values."""
    n = 3_000
    lookup = spark.range(n).select(F.col("id").alias("x"), (F.col("id") + n // 3).alias("y"), (F.col("id") * 7919 % n).alias("v"))
    requests = spark.range(n).select("id", F.col("id").alias("a"))
    df = enrich(
        requests, lookup, restriction="x <= {a} AND y > {a}", fields=["a"], allow_theta=True, select=["v desc"], column_names=["v"],
        match_count=True, split=False,
    )
    assert len(made) == 2 and sum(m.count() for m in made) < n * 40
    got = {r.id: (r.v, r["__match_count"]) for r in df.collect()}
    assert got == {a: (max(x * 7919 % n for x in range(max(a - n // 3 + 1, 0), a + 1)), min(a + 1, n // 3)) for a in range(n)}


def test_wide_distances_make_few_pairs(spark, made):
    n = 3_000
    lookup = spark.range(n * 4).select((F.col("id") % n).cast("double").alias("x"), F.col("id").alias("v"))
    requests = spark.range(500).select("id", (F.col("id") * 5.0).alias("a"))
    df = enrich(
        requests, lookup, restriction="abs(x - {a}) <= 700", fields=["a"], allow_theta=True, select=["v"], column_names=["v"],
        match_count=True, split=False,
    )
    assert len(made) == 2 and sum(m.count() for m in made) < 500 * 60
    got = {r.id: (r.v, r["__match_count"]) for r in df.collect()}
    assert got == {i: (max(i * 5 - 700, 0), 4 * (min(i * 5 + 700, n - 1) - max(i * 5 - 700, 0) + 1)) for i in range(500)}


def test_odd_distances(spark, no_broadcast):
    odd = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 1e308, 5e-324, 1.5, -3.0]
    rq = spark.createDataFrame([(i * 100 + j, a, b) for i, a in enumerate(odd) for j, b in enumerate(odd) if b == b], "id long, b double, d double")
    lk = spark.createDataFrame([(v, i) for i, v in enumerate([v for v in odd * 3 if v == v] + [float(x) for x in range(40)])], "x double, v long")
    for op in ("<", "<="):
        df = enrich(rq, lk, restriction=f"abs(x - {{b}}) {op} {{d}}", fields=["b", "d"], allow_theta=True, select=["v desc"], column_names=["v"], match_count=True)
        pairs = rq.join(lk, F.expr(f"abs(x - b) {op} d")).groupBy("id").agg(F.count("*").alias("n"), F.max("v").alias("v"))
        want = {r.id: (r.n, r.v) for r in pairs.collect()}
        assert {r.id: (r["__match_count"], r.v) for r in df.collect()} == {r.id: want.get(r.id, (0, None)) for r in rq.select("id").collect()}


@pytest.mark.parametrize("kind,split", [("bigint", True), ("double", False), ("timestamp", False), ("timestamp_ntz", True), ("string", False)])
def test_ranges_around_few_values(spark, no_broadcast, split, kind, made):
    """Without a count, each of few values has a cell, so that no row is tested; types without exact numbers go the other way."""
    requests, lookup, rq, lk = two_values(spark, kind, hash_seed(kind, "few"))
    for keyed, first, last, test in (
        (True, "<=", ">", lambda q, r: r["x"] <= q["b"] < r["y"]),
        (False, "<", ">=", lambda q, r: r["x"] < q["b"] <= r["y"]),
    ):
        made.clear()
        df = enrich(
            rq, lk, restriction=lambda v, row: [("x", first, v["b"]), ("y", last, v["b"])], fields=["b"], select=["o_v desc"],  # noqa: B023
            split=split, column_names=COMMON["column_names"], **(dict(join_key="k") if keyed else dict(allow_theta=True)),
        )
        assert len(made) == (2 if kind == "string" else 1)

        def whole(q, r):
            return None not in (q["b"], r["x"], r["y"]) and (not keyed or q["k"] == r["k"]) and test(q, r)  # noqa: B023

        want = expected([q for q in requests if not keyed or q["k"] is not None], lookup, whole, [("v", True)])
        assert {r["id"]: (r["o_x"], r["o_v"], r["o_p"], r["__enrichment_status"]) for r in df.collect()} == {i: w[:4] for i, w in want.items()}


def test_few_values_that_doubles_tell_apart(spark, monkeypatch):
    def found(values, kind):
        return blocks.few_values(spark.createDataFrame([(v,) for v in values], f"b {kind}"))

    assert found([3, None, -1, 3, 0], "bigint") == [-1, 0, 3]
    assert found([2**53 - 1, 5], "bigint") == [5, 2**53 - 1]
    for values, kind in (([2**53], "bigint"), ([float("nan"), 1.0], "double"), ([float("inf"), 1.0], "double"), ([None], "bigint"), (["a"], "string")):
        assert found(values, kind) is None
    monkeypatch.setattr(blocks, "MAX_PARTS", 3)
    assert found([4, 4, 5, 6], "int") == [4, 5, 6] and found([4, 5, 6, 7], "int") is None


def test_odd_ends_around_few_values(spark, no_broadcast):
    """Infinities, NaN and numbers that share a double, around zeroes and numbers near the limit."""
    odd = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 1e308, 5e-324, 1.5]
    big = [2**53 - 2, 2**53 - 1, 2**53, 2**53 + 1, 2**62, 2**62 + 1, -(2**63), 2**63 - 1, 0]
    for kind, asked, ends in (("double", [0.0, -0.0, 5e-324, 1.5, None], odd), ("bigint", [2**53 - 2, 2**53 - 1, 0, None], big)):
        rq = spark.createDataFrame([(i, b) for i, b in enumerate(asked * 2)], f"id long, b {kind}")
        lk = spark.createDataFrame([(x, y, i * 20 + j) for i, x in enumerate([*ends, None]) for j, y in enumerate([*ends, None])], f"x {kind}, y {kind}, v long")
        for first, last in (("<=", ">"), ("<", ">=")):
            df = enrich(rq, lk, restriction=f"x {first} {{b}} AND y {last} {{b}}", fields=["b"], allow_theta=True, select=["v desc"], column_names=["v"])
            want = rq.join(lk, F.expr(f"x {first} b and y {last} b"), "left").groupBy("id").agg(F.max("v").alias("v"))
            assert sorted((r.id, r.v) for r in df.collect()) == sorted((r.id, r.v) for r in want.collect())


def test_lookup_around_values_is_cut_to_few_keys(spark, no_broadcast):
    """However many requests there are, their keys may be few; Spark reckons one for each."""
    requests = spark.range(4_000).select("id", (F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("a"))
    lookup = spark.range(900).select((F.col("id") % 9).alias("k"), (F.col("id") % 40).alias("x"), (F.col("id") % 40 + 10).alias("y"), F.col("id").alias("v"))
    df = enrich(requests, lookup, join_key="k", restriction="x <= {a} AND y > {a}", fields=["a"], select=["v desc"], column_names=["k", "v"])
    assert "LeftSemi" in tree(df)
    best = {(v % 9, a): v for v in range(900) for a in range(v % 40, v % 40 + 10)}
    assert {r.id: r.v for r in df.collect()} == {i: best.get((i % 3, i % 50)) for i in range(4_000)}


def test_values_that_few_keys_have_get_no_cell_each(spark, no_broadcast, monkeypatch):
    """A cell for each of 2,000 values would be too fine for keys with two requests each."""
    monkeypatch.setattr(planned, "best_around_values", None)
    requests = spark.range(2_000).select("id", (F.col("id") % 1_000).alias("k"), (F.col("id") * 7).alias("a"))
    lookup = spark.range(1_000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("x"), (F.col("id") * 7 + 5).alias("y"), F.col("id").alias("v"))
    df = enrich(requests, lookup, join_key="k", restriction="x <= {a} AND y > {a}", fields=["a"], select=["v desc"], column_names=["k", "v"], split=False)
    assert {r.id: r.v for r in df.collect()} == {i: i if i < 1_000 else None for i in range(2_000)}
