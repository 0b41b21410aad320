"""Every way to split hot keys gives what the plain plan gives, and what a row-by-row model gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lookfuse import PythonSelector, enrich
from lookfuse.operators.skew import MAX_COPIES, Splitter, find_hot_grid
from reference_model import pick

REQUEST = "id bigint, k bigint, b {t}, m int"
LOOKUP = "k bigint, x {t}, v int, p string"
KINDS = {
    "bigint": lambda r: r.randint(0, 40),
    "double": lambda r: round(r.uniform(-5, 5), 1),
    "string": lambda r: "pre-" + "".join(r.choice("abc") for _ in range(r.randint(0, 4))),
    "date": lambda r: dt.date(2024, 1, 1) + dt.timedelta(days=r.randint(0, 40)),
    "timestamp": lambda r: dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randint(0, 40)),
    "timestamp_ntz": lambda r: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=r.randint(0, 40)),
    "decimal(10,2)": lambda r: __import__("decimal").Decimal(r.randint(-100, 100)) / 4,
}


def tables(spark, kind, seed):
    r = random.Random(seed)
    value = KINDS[kind]

    def key():
        return 7 if r.random() < 0.4 else None if r.random() < 0.1 else r.randint(0, 12)

    def maybe(x):
        return None if r.random() < 0.1 else x

    requests = [dict(id=i, k=key(), b=maybe(value(r)), m=r.randint(0, 3)) for i in range(120)]
    lookup = [dict(k=key(), x=maybe(value(r)), v=maybe(r.randint(0, 5)), p=r.choice("stu")) for _ in range(150)]
    requests += [dict(q, id=1000 + i) for i, q in enumerate(requests[:30] * 2)]
    lookup += lookup[:40] * 2

    def frame(rows, ddl):
        names = [c.split()[0] for c in ddl.split(", ")]
        return spark.createDataFrame([tuple(x[n] for n in names) for x in rows], ddl).repartition(5)

    return requests, lookup, frame(requests, REQUEST.format(t=kind)), frame(lookup, LOOKUP.format(t=kind))


def rows(df):
    found = [
        (r["id"], (r["o_x"], r["o_v"], r["o_p"], r["__enrichment_status"], r["__match_count"])) for r in df.collect()
    ]
    assert len(found) == len(dict(found))
    return dict(found)


def expected(requests, lookup, test, order):
    found = pick([q for q in requests if q["k"] is not None], lookup, test, order, ["x", "v", "p"])
    return {
        q["id"]: (m and m["x"], m and m["v"], m and m["p"], "SUCCESS" if m else "NO_BQ_DATA", n) for q, m, n in found
    }


COMMON = dict(
    join_key="k", column_names=["x as o_x", "v as o_v", "p as o_p"], match_count=True
)
OPS = {
    "<": lambda x, b: x < b,
    "<=": lambda x, b: x <= b,
    ">": lambda x, b: x > b,
    ">=": lambda x, b: x >= b,
}


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("kind,op,order", [
    ("bigint", "<=", "o_x desc"), ("bigint", ">", "o_v"), ("double", ">=", "o_x"), ("double", "<", "o_v desc"),
    ("string", "<=", "o_x desc"), ("string", ">", "o_p desc"), ("date", "<", "o_x desc"),
    ("timestamp", "<=", "o_x desc"), ("timestamp_ntz", ">=", "o_x desc"), ("decimal(10,2)", "<", "o_x desc"),
])
def test_bound(spark, no_broadcast, split, kind, op, order):
    requests, lookup, rq, lk = tables(spark, kind, hash_seed(kind, op))
    got = enrich(
        rq, lk, restriction=lambda v, row: ("x", op, v["b"]), condition_value_fn=lambda r: {"b": r.b},
        select=[order], split=split, **COMMON
    )
    name, _, direction = order.partition(" ")
    want = expected(
        requests, lookup,
        lambda q, r: r["k"] == q["k"] and None not in (r["x"], q["b"]) and OPS[op](r["x"], q["b"]),
        [(name[2:], direction == "desc")],
    )
    assert rows(got) == want


def hash_seed(*parts):
    return sum(map(ord, "".join(parts)))


@pytest.mark.parametrize("split", [False, True])
def test_equality(spark, no_broadcast, split):
    requests, lookup, rq, lk = tables(spark, "bigint", 1)
    got = enrich(rq, lk, select=["o_v desc"], split=split, **COMMON)
    assert rows(got) == expected(requests, lookup, lambda q, r: r["k"] == q["k"], [("v", True)])


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("count", [False, True])
def test_residual(spark, no_broadcast, split, count):
    requests, lookup, rq, lk = tables(spark, "bigint", 2)
    options = dict(COMMON, match_count=count)
    got = enrich(
        rq, lk, restriction="k = {k} AND (x > {b} OR v = {m})", fields=["k"],
        additional_condition_fields=["b", "m"], select=["o_v"], split=split, **options,
    )
    want = expected(
        requests, lookup,
        lambda q, r: q["b"] is not None and r["k"] == q["k"]
        and ((r["x"] is not None and r["x"] > q["b"]) or r["v"] == q["m"]),
        [("v", False)],
    )
    if not count:
        got = got.withColumn("__match_count", F.lit(0))
        want = {i: (*w[:-1], 0) for i, w in want.items()}
    assert rows(got) == want


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("order,lower,upper", [("o_x desc", ">=", "<"), ("o_x", ">", "<="), ("o_v", ">", "<=")])
def test_two_sided(spark, no_broadcast, split, order, lower, upper):
    requests, lookup, rq, lk = tables(spark, "bigint", 3)
    got = enrich(
        rq, lk, condition_value_fn=lambda r: {"lo": r.b - 6, "hi": r.b},
        restriction=f"x {lower} {{lo}} AND x {upper} {{hi}}", select=[order], split=split,
        **dict(COMMON, match_count=False),
    ).withColumn("__match_count", F.lit(0))
    name, _, direction = order.partition(" ")
    want = expected(
        requests, lookup,
        lambda q, r: r["k"] == q["k"] and None not in (r["x"], q["b"])
        and OPS[lower](r["x"], q["b"] - 6) and OPS[upper](r["x"], q["b"]),
        [(name[2:], direction == "desc")],
    )
    assert rows(got) == {i: (*w[:-1], 0) for i, w in want.items()}


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("kind", ["range", "opaque"])
def test_keyless(spark, no_broadcast, split, kind):
    requests, lookup, rq, lk = tables(spark, "bigint", 4)
    template = "x < {b}" if kind == "range" else "x % 5 = {b} % 5"
    options = dict(COMMON, allow_theta=True)
    del options["join_key"]
    got = enrich(rq, lk, restriction=template, fields=["b"], select=["o_v desc"], split=split, **options)
    test = (lambda x, b: x < b) if kind == "range" else (lambda x, b: x % 5 == b % 5)
    found = pick(
        requests, lookup, lambda q, r: None not in (r["x"], q["b"]) and test(r["x"], q["b"]),
        [("v", True)], ["x", "v", "p"],
    )
    assert rows(got) == {
        q["id"]: (m and m["x"], m and m["v"], m and m["p"], "SUCCESS" if m else "NO_BQ_DATA", n) for q, m, n in found
    }


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("template", ["x < {b}", "k = {k} AND x < {b}", "p != 's' AND v = {m}", "v = {m} AND x <= {b} + 1"])
def test_any_request(spark, no_broadcast, split, template):
    requests, lookup, rq, lk = tables(spark, "bigint", 5)
    got = enrich(
        rq, lk, restriction=template, fields=["k"], additional_condition_fields=["b", "m"],
        scope="any_request", select=["o_v desc"], split=split, **COMMON,
    )
    tests = {
        "x < {b}": lambda q, r: r["x"] is not None and r["x"] < q["b"],
        "k = {k} AND x < {b}": lambda q, r: r["k"] == q["k"] and r["x"] is not None and r["x"] < q["b"],
        "p != 's' AND v = {m}": lambda q, r: r["p"] != "s" and r["v"] == q["m"],
        "v = {m} AND x <= {b} + 1": lambda q, r: r["v"] == q["m"] and r["x"] is not None and r["x"] <= q["b"] + 1,
    }
    valid = [q for q in requests if q["k"] is not None and q["b"] is not None]
    admitted = [r for r in lookup if any(tests[template](q, r) for q in valid)]
    want = expected(
        requests, admitted, lambda q, r: q["b"] is not None and r["k"] == q["k"], [("v", True)]
    )
    assert rows(got) == want


@pytest.mark.parametrize("split", [False, True])
def test_representative(spark, no_broadcast, split):
    requests, lookup, rq, lk = tables(spark, "bigint", 6)
    got = enrich(
        rq, lk, restriction="x < {b}", fields=["b"], representative=["m desc", "id"], select=["o_x desc"],
        split=split, **COMMON,
    )
    reps = {}
    for q in sorted((q for q in requests if q["k"] is not None), key=lambda q: (-q["m"], q["id"])):
        reps.setdefault(q["k"], q)
    want = expected(
        requests, lookup,
        lambda q, r: r["k"] == q["k"] and None not in (r["x"], reps[q["k"]]["b"]) and r["x"] < reps[q["k"]]["b"],
        [("x", True)],
    )
    assert rows(got) == want


@pytest.mark.parametrize("split", [False, True])
def test_duplicates_first(spark, no_broadcast, split):
    requests, lookup, rq, lk = tables(spark, "bigint", 7)
    got = enrich(
        rq, lk, restriction="x < {b}", fields=["b"], duplicates="first", request_order=["m desc", "id"],
        select=["o_x desc"], split=split, **COMMON,
    )
    first = {}
    for q in sorted((q for q in requests if None not in (q["k"], q["b"])), key=lambda q: (-q["m"], q["id"])):
        first.setdefault(q["k"], q["id"])
    want = expected(
        requests, lookup,
        lambda q, r: first.get(q["k"]) == q["id"] and r["k"] == q["k"] and r["x"] is not None and r["x"] < q["b"],
        [("x", True)],
    )
    assert rows(got) == want


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("python", [False, True])
@pytest.mark.parametrize("restricted", [False, True])
def test_decomposable_selectors_in_small_chunks(spark, no_broadcast, split, python, restricted):
    from lookfuse import ColumnSelector

    requests, lookup, rq, lk = tables(spark, "bigint", 8)

    def best(matches):
        return max(matches, key=lambda r: (r["o_v"] if r["o_v"] is not None else -1, r["o_x"] or 0, r["o_p"]))

    def best_column(array):
        rank = lambda r: F.struct(
            F.coalesce(r["o_v"], F.lit(-1)), F.coalesce(r["o_x"], F.lit(0)), r["o_p"]
        )
        return F.reduce(array, F.get(array, 0), lambda a, r: F.when(rank(r) > rank(a), r).otherwise(a))

    selector = (
        PythonSelector(best, decomposable=True, chunk_rows=3)
        if python
        else ColumnSelector(best_column, decomposable=True, chunk_rows=3)
    )
    extra = dict(restriction="k = {k} AND x < {b}", fields=["k", "b"]) if restricted else {}
    options = dict(COMMON, column_names=["x as o_x", "v as o_v", "p as o_p"])
    got = enrich(rq, lk, select=selector, split=split, **options, **extra)
    want = {}
    for q in requests:
        if q["k"] is None:
            continue
        m = [
            dict(o_x=r["x"], o_v=r["v"], o_p=r["p"]) for r in lookup
            if r["k"] == q["k"]
            and (not restricted or (None not in (r["x"], q["b"]) and r["x"] < q["b"]))
        ]
        b = best(m) if m else dict(o_x=None, o_v=None, o_p=None)
        want[q["id"]] = (b["o_v"], b["o_p"], "SUCCESS" if m else "NO_BQ_DATA", len(m))
    assert {i: (w[1], w[2], w[3], w[4]) for i, w in rows(got).items()} == want


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("template", ["x < {b}", "v = {m} AND x < {b}"])
def test_any_request_with_representatives(spark, no_broadcast, split, template):
    """One request of each key states the restriction; every row any of them admits goes to its key."""
    requests, lookup, rq, lk = tables(spark, "bigint", 9)
    got = enrich(
        rq, lk, restriction=template, fields=["b"], additional_condition_fields=["m"], scope="any_request",
        representative=["id desc"], select=["o_v desc"], split=split, **COMMON,
    )
    reps = {}
    for q in sorted((q for q in requests if q["k"] is not None), key=lambda q: -q["id"]):
        reps.setdefault(q["k"], q)
    valid = [q for q in reps.values() if q["b"] is not None]
    below = lambda q, r: r["x"] is not None and r["x"] < q["b"]
    test = below if template == "x < {b}" else lambda q, r: r["v"] == q["m"] and below(q, r)
    admitted = [r for r in lookup if any(test(q, r) for q in valid)]
    assert rows(got) == expected(requests, admitted, lambda q, r: r["k"] == q["k"], [("v", True)])


@pytest.mark.parametrize("split", [False, True])
def test_any_request_with_first_duplicates(spark, no_broadcast, split):
    requests, lookup, rq, lk = tables(spark, "bigint", 10)
    got = enrich(
        rq, lk, restriction="x < {b}", fields=["b"], scope="any_request", duplicates="first", request_order=["id"],
        select=["o_v desc"], split=split, **COMMON,
    )
    first = {}
    for q in sorted((q for q in requests if None not in (q["k"], q["b"])), key=lambda q: q["id"]):
        first.setdefault(q["k"], q)
    admitted = [r for r in lookup if any(r["x"] is not None and r["x"] < q["b"] for q in first.values())]
    want = expected(
        requests, admitted, lambda q, r: r["k"] == q["k"] and first.get(q["k"], {}).get("id") == q["id"], [("v", True)]
    )
    assert rows(got) == want


@pytest.mark.parametrize("seed", range(20, 24))
def test_nothing_hot(spark, no_broadcast, seed):
    """Splitting is on, but no key calls for it; also many requests without a key."""
    requests, lookup, rq, lk = tables(spark, "bigint", seed)
    if seed % 2:
        keyed = rq.withColumn("k", F.col("id") % 50)
        requests = [dict(q, k=q["id"] % 50) for q in requests]
    else:
        keyed = rq.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("id") % 50))
        requests = [dict(q, k=q["id"] % 50 if q["id"] % 2 == 0 else None) for q in requests]
    for restriction, test in (
        (None, lambda q, r: True),
        ("x < {b}", lambda q, r: None not in (r["x"], q["b"]) and r["x"] < q["b"]),
    ):
        fields = dict(restriction=restriction, fields=["b"]) if restriction else {}
        got = enrich(keyed, lk, select=["o_v desc"], split=True, null_keys="keep", **fields, **COMMON)
        found = pick(
            requests, lookup, lambda q, r: q["k"] is not None and r["k"] == q["k"] and test(q, r),
            [("v", True)], ["x", "v", "p"],
        )
        assert rows(got) == {
            q["id"]: (m and m["x"], m and m["v"], m and m["p"], "SUCCESS" if m else "NO_BQ_DATA", n)
            for q, m, n in found
        }


@pytest.mark.parametrize("kind,op,order", [
    ("bigint", "<=", "o_x desc"), ("bigint", ">", "o_v"), ("double", ">=", "o_x"), ("string", "<", "o_v desc"),
    ("timestamp_ntz", "<", "o_x desc"), ("date", ">=", "o_p desc"),
])
def test_bound_with_a_lookup_small_enough_to_broadcast(spark, tmp_path, kind, op, order):
    requests, lookup, rq, lk = tables(spark, kind, hash_seed(op, kind))
    lk.write.parquet(str(tmp_path / "lookup"))
    rq.write.parquet(str(tmp_path / "requests"))
    got = enrich(
        spark.read.parquet(str(tmp_path / "requests")), spark.read.parquet(str(tmp_path / "lookup")),
        restriction=lambda v, row: ("x", op, v["b"]), condition_value_fn=lambda r: {"b": r.b}, select=[order],
        split=True, **COMMON,
    )
    text = got._jdf.queryExecution().toString()
    assert "__from" in text and "BroadcastHashJoin" in text
    name, _, direction = order.partition(" ")
    want = expected(
        requests, lookup,
        lambda q, r: r["k"] == q["k"] and None not in (r["x"], q["b"]) and OPS[op](r["x"], q["b"]),
        [(name[2:], direction == "desc")],
    )
    assert rows(got) == want


def test_grids_follow_the_pairs(spark):
    """As many rows, but other pairs: one key with 10^5 on both sides, one with 10^5 on one."""

    def grid(a, b, split_left=True):
        left, right = (spark.range(n).select(F.lit(7).cast("bigint").alias("h")) for n in (a, b))
        others = spark.range(1000, 400_000).select(F.col("id").alias("h"))
        found = find_hot_grid(left.union(others), right.union(others), Splitter(True, 8), split_left)
        return [max((parts for parts, hashes in side.classes if 7 in hashes), default=1) for side in found]

    assert grid(100_000, 1) == [1, 1]
    rows, columns = grid(100_000, 100_000)
    assert rows * columns >= 1000 and rows == columns
    # Rows are repeated for the other side's parts: no more than MAX_COPIES times on average.
    for a, b in ((100_000, 100_000), (400_000, 2_000), (2_000, 400_000)):
        rows, columns = grid(a, b)
        assert a * columns + b * rows <= 2 * MAX_COPIES * (a + b)
    assert grid(100_000, 100_000, split_left=False)[0] == 1
