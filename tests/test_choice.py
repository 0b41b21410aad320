"""Choices of templates and disjunctions: against a row-by-row model, with every scope, and their plans."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lookfuse import enrich
from lookfuse.functions.template import MAX_ARMS, disjuncts
from lookfuse.plans import enrich as planned

SF = "/root/testdata/sf0.01"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def sides(spark):
    requests = [(i, i % 5 if i % 11 else None, i % 3 if i % 7 else None, (i * 5) % 13, ["a", "b", "c", "d", "zz", None][i % 6]) for i in range(90)]
    lookup = [(i % 5, i % 3, (i * 7) % 13 if i % 9 else None, "pq"[i % 2], i % 40) for i in range(120)]
    rq = spark.createDataFrame(requests, "id int, k bigint, m int, b int, t string").repartition(4)
    lk = spark.createDataFrame(lookup, "k bigint, m int, x int, s string, v int").repartition(4)
    return [dict(zip(rq.columns, r)) for r in requests], [dict(zip(lk.columns, r)) for r in lookup], rq, lk


TEMPLATES = {
    "bounds": {"a": ("x <= {b}", lambda q, r: r["x"] is not None and r["x"] <= q["b"]), "b": ("v <= {m}", lambda q, r: r["v"] <= q["m"]), "c": ("s = 'p'", lambda q, r: r["s"] == "p")},
    "mixed": {"a": ("m = {m} AND x > {b}", lambda q, r: r["m"] == q["m"] and r["x"] is not None and r["x"] > q["b"]), "b": ("v % 3 = {m}", lambda q, r: r["v"] % 3 == q["m"]), "c": ("x < {b} AND s = 'q'", lambda q, r: r["x"] is not None and r["x"] < q["b"] and r["s"] == "q"), "d": ("x >= {m} AND x <= {b}", lambda q, r: r["x"] is not None and q["m"] <= r["x"] <= q["b"])},
    "keys": {"a": ("m = {m}", lambda q, r: r["m"] == q["m"]), "d": ("m = {b} AND s = 'q'", lambda q, r: r["m"] == q["b"] and r["s"] == "q")},
}


def best(found):
    return max(found, key=lambda r: (r["v"], [-ord(c) for c in r["s"]], -(r["x"] if r["x"] is not None else -1)), default=None)


def outcome(found):
    row = best(found)
    return (row and row["v"], len(found))


def got(df):
    return {r.id: (r.o_v, r["__match_count"]) for r in df.collect()}


OPTIONS = dict(join_key="k", template_id="t", fields=["m", "b"], column_names=["k", "v as o_v"], select=["o_v desc"], match_count=True)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("kind", sorted(TEMPLATES))
def test_every_scope(spark, no_broadcast, sides, kind, split):
    requests, lookup, rq, lk = sides
    tests = {t: test for t, (_, test) in TEMPLATES[kind].items()}
    options = OPTIONS | {"restriction": {t: text for t, (text, _) in TEMPLATES[kind].items()}, "split": split}

    def valid(q):
        return None not in (q["k"], q["m"], q["b"]) and q["t"] in tests

    def matches(q):
        return [r for r in lookup if valid(q) and r["k"] == q["k"] and tests[q["t"]](q, r)]

    asked = [q for q in requests if q["k"] is not None]
    assert got(enrich(rq, lk, **options)) == {q["id"]: outcome(matches(q)) for q in asked}

    leader = {}
    for q in asked:
        leader.setdefault(q["k"], q)
    shared = enrich(rq, lk, representative=["id"], **options)
    assert got(shared) == {q["id"]: outcome(matches(leader[q["k"]])) for q in asked}

    first = {}
    for q in asked:
        if valid(q):
            first.setdefault(q["k"], q["id"])
    only = enrich(rq, lk, duplicates="first", request_order=["id"], **options)
    assert got(only) == {q["id"]: outcome(matches(q) if first.get(q["k"]) == q["id"] else []) for q in asked}

    admitted = [r for r in lookup if any(valid(q) and tests[q["t"]](q, r) for q in asked)]
    anyone = enrich(rq, lk, scope="any_request", allow_theta=True, **options)
    assert got(anyone) == {q["id"]: outcome([r for r in admitted if valid(q) and r["k"] == q["k"]]) for q in asked}


@pytest.mark.parametrize("how", ["own", "representative", "any", "selector"])
def test_one_scan_for_any_number_of_templates(spark, no_broadcast, how):
    orders, customer = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("orders", "customer"))
    more = {"own": {}, "representative": {"representative": ["o_orderkey"]}, "any": {"scope": "any_request"}, "selector": {"select": lambda found: F.get(found, 0)}}[how]

    def scans(n):
        templates = {str(i): f"c_custkey = {{o_custkey}} AND c_acctbal > {{o_totalprice}} + {i} AND c_nationkey <> {i}" for i in range(n)}
        df = enrich(
            orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), customer, join_key="o_custkey", restriction=templates,
            template_id="o_orderstatus", fields=["o_custkey", "o_totalprice"], column_names=["c_custkey as o_custkey", "c_name"], split=False, **more,
        )
        return len([s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)) if "c_acctbal" in s])

    assert scans(2) == scans(10) == 1


@pytest.mark.parametrize("split", [False, True])
def test_disjunctions_join_by_their_arms(spark, no_broadcast, sides, split):
    requests, lookup, rq, lk = sides
    cases = {
        "k = {k} OR m = {m}": lambda q, r: r["k"] == q["k"] or r["m"] == q["m"],
        "k = {k} AND x <= {b} OR m = {m} AND s = 'p' OR x = {b}": lambda q, r: (
            (r["k"] == q["k"] and r["x"] is not None and r["x"] <= q["b"]) or (r["m"] == q["m"] and r["s"] == "p") or r["x"] == q["b"]
        ),
        "(k = {k} OR m = {m}) AND (x = {b} OR v = {b})": lambda q, r: (r["k"] == q["k"] or r["m"] == q["m"]) and (r["x"] == q["b"] or r["v"] == q["b"]),
        "k = {k} AND v BETWEEN {m} AND {b} OR x = {b}": lambda q, r: (r["k"] == q["k"] and q["m"] <= r["v"] <= q["b"]) or r["x"] == q["b"],
    }
    for text, test in cases.items():
        options = dict(restriction=text, fields=["k", "m", "b"], column_names=["v as o_v", "x as o_x", "s"], split=split)
        df = enrich(rq, lk, select=["o_v desc"], match_count=True, **options)
        want = {q["id"]: [r for r in lookup if None not in (q["k"], q["m"], q["b"]) and test(q, r)] for q in requests}
        assert got(df) == {i: (max((r["v"] for r in found), default=None), len(found)) for i, found in want.items()}
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text
        # A selector sees a lookup row once, however many arms it meets.
        counted = enrich(rq, lk, select=lambda found: F.get(found, 0).withField("o_v", F.size(found).cast("int")), **options)
        assert {r.id: r.o_v or 0 for r in counted.collect()} == {i: len(found) for i, found in want.items()}


def test_an_arm_without_an_equality_needs_consent(sides):
    _, _, rq, lk = sides
    with pytest.raises(ValueError, match="allow_theta"):
        enrich(rq, lk, restriction="k = {k} OR x < {b}", fields=["k", "b"])


def test_disjuncts():
    assert disjuncts("a = {x}") == ["a = {x}"]
    assert disjuncts("a = {x} OR b = {y} AND c > 1") == ["a = {x}", "b = {y} AND c > 1"]
    assert disjuncts("(a = {x} OR b = {y}) AND c > 1") == ["a = {x} AND c > 1", "b = {y} AND c > 1"]
    assert disjuncts("((a = 1 OR (b = 2 OR c = 3)))") == ["a = 1", "b = 2", "c = 3"]
    assert disjuncts("f(a OR b) = 1 AND NOT (a OR b)") == ["f(a OR b) = 1 AND NOT (a OR b)"]
    assert disjuncts("(a OR b) = {x} OR c BETWEEN 1 AND 2") == ["(a OR b) = {x}", "c BETWEEN 1 AND 2"]
    assert disjuncts("CASE WHEN a OR b THEN 1 END = {x} OR s = ' OR '") == ["CASE WHEN a OR b THEN 1 END = {x}", "s = ' OR '"]
    many = " AND ".join(f"(a{i} = 1 OR b{i} = 1)" for i in range(10))
    assert disjuncts(many) == [many] and 2**10 > MAX_ARMS


@pytest.mark.parametrize("split", [False, True])
def test_any_request_asks_by_the_widest_bound_of_each_template(spark, no_broadcast, split, monkeypatch):
    """Bounds of two kinds and a template without one: a probe for each template, however many requests."""
    requests = [(i, i % 50, ["a", "b", "c", None][i % 4] if i < 300 else "zz", i * 7 % 40 + 30, i % 9 - 4.5 if i % 13 else None) for i in range(400)]
    lookup = [(i % 50, i * 3 % 60 if i % 8 else None, i % 17 / 2.0 if i % 5 else None, "pq"[i % 2], i) for i in range(500)]
    rq = spark.createDataFrame(requests, "id int, k int, t string, b int, f double").repartition(4)
    lk = spark.createDataFrame(lookup, "k int, x int, y double, s string, v int").repartition(4)
    seen, pairs = [], planned.matching_pairs

    def counted(probes, *args, **more):
        seen.append(probes.count())
        return pairs(probes, *args, **more)

    monkeypatch.setattr(planned, "matching_pairs", counted)
    df = enrich(
        rq, lk, keys=["k"], template_id="t", fields=["b", "f"], restriction={"a": "x >= {b} AND s = 'p'", "b": "y < {f}", "c": "v = 77"},
        scope="any_request", column_names=["k", "v as o_v"], select=["o_v desc"], match_count=True, allow_theta=True, split=split,
    )
    asking = [r for r in requests if r[4] is not None and r[2] in ("a", "b", "c")]
    found = {}
    for k, x, y, s, v in lookup:
        if any(
            x is not None and x >= b and s == "p" if t == "a" else y is not None and y < f if t == "b" else v == 77
            for _, _, t, b, f in asking
        ):
            found.setdefault(k, []).append(v)
    valid = {r[0] for r in asking}
    want = {r[0]: (max(found[r[1]]), len(found[r[1]])) if r[0] in valid and r[1] in found else (None, 0) for r in requests}
    assert got(df) == want and len({n for _, n in want.values()}) > 2
    assert seen == [3]
