"""Nulls, empty and long texts, ties, repeats, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lookfuse.llm import decontamination, html_text, language, line_dedup, lm, mixture, ngram_join, quality, token_counts, warc

LONG = "word" + " word" * 50_000
PROSE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, PROSE, "en", "a", 1, 7, "x"),
    (1, PROSE, "en", "a", 1, 7, "x"),
    (2, None, None, None, None, None, None),
    (3, "", "de", "b", 0, 1, "y"),
    (None, PROSE, "en", "a", 1, 2, "z"),
    (None, None, None, None, None, None, None),
    (4, LONG, "de", "b", 1, 3, "x"),
    (5, " \t\n\n ", "de", None, 1, 3, "x"),
    (6, PROSE + " end", "fr", "c", 1, 3, "x"),
    (1, "another text of the same id " + PROSE[::-1], "fr", "c", 1, 3, "x"),
    (7, "x" * 200_000, "en", "a", 1, 3, "x"),
    (8, "日本語 🎉 \u0000 nul", "ja", "c", 1, 3, "x"),
]
# Names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, node string"
CLASH = ["key", "target", "position", "n_tokens", "item_id", "line", "score", "kept", "n_words", "row", "rank", "sig", "word"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASH}).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PROSE, 1), (2, None, 2), (None, "a b c d e f", 3), (3, "", 4), (4, PROSE, 5), (5, "one two", 6)]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long")


def test_token_counts(docs, none):
    path = __import__("public_tokenizers").path("byte_bpe_50k.json")
    got = token_counts.count_tokens(docs, path)
    rows = [(r.doc_id, r.n_bytes, r.over_limit) for r in got.collect()]
    assert len(rows) == len(ROWS) and rows.count((2, 0, False)) == 1 and (4, len(LONG), True) in rows
    assert token_counts.count_tokens(none, path).collect() == []


def test_quality(docs, none):
    rows = quality.judge(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    assert {r.kept for r in rows if r.doc_id == 4} == {False}
    assert quality.judge(none).count() == quality.keep_good(none).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_decontamination(docs, none, benchmark):
    got = sorted((r.doc_id or 0, r.item_id, r.item_shingles, r.shared) for r in decontamination.find_contained(docs, benchmark).collect())
    assert got == sorted([(d, i, 56, 56) for d in (1, 1, 0, 6) for i in (1, 4)])
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 4
    assert decontamination.find_contained(none, benchmark).count() == 0
    assert decontamination.find_contained(docs, benchmark.where("false")).count() == 0
    assert decontamination.drop_contaminated(docs, benchmark.where("false")).count() == len(ROWS)


def test_line_dedup(docs, none):
    rows = line_dedup.drop_boilerplate(docs, min_sites=2)
    assert rows.count() == len(ROWS)
    by = {(r.doc_id, r.text is None): r for r in rows.collect()}
    assert by[2, True].n_lines == 0 and by[3, False].text == "" and by[3, False].n_lines == 1
    assert line_dedup.drop_boilerplate(none).collect() == []


def test_mixture(docs, none):
    rows = mixture.plan_mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    order = mixture.mixed_order(docs)
    assert order.count() == sum(len([p for p in r.passes if p]) for r in rows)
    assert set(docs.columns) - {"position"} <= set(order.columns)
    assert mixture.plan_mix(none).collect() == [] and mixture.mixed_order(none).collect() == []
    assert mixture.plan_mix(docs.where("doc_id = 3")).first().taken == 0


def test_language(docs, none):
    profiles = language.train(docs)
    rows = language.identify(docs, profiles).collect()
    assert len(rows) == len(ROWS)
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (2, 3, 5)} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.train(none) == {}
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.identify(none, profiles).collect() == []


def test_lm(docs, none):
    rows = lm.score(docs, docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r.score < 0 and r.base_score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 5)} == {1}
    assert len({(r.n_tokens, r.n_known, r.base_score, r.score) for r in rows if r.doc_id in (2, 3, 5)}) == 1
    assert lm.score(none, docs).collect() == []
    unknown = lm.score(docs, none).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in unknown} == {(0, 0, 0.0)}


def test_ngram_join(docs, none):
    rows = ngram_join.link_components(docs).collect()
    got = sorted({(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id})
    assert len(rows) == len(ROWS)
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    assert [x for x in got if x[0] in (2, 3, 5, 6)] == [(2, 0, 2), (3, 0, 3), (5, 0, 5), (6, 58, 1)]
    assert {x[2] for x in got if x[0] == 1} == {1}
    assert ngram_join.link_components(none).collect() == [] and ngram_join.keep_first(none).collect() == []
    kept = ngram_join.keep_first(docs)
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert kept.columns == docs.columns
    assert ids == [0, 0, 1, 1, 2, 3, 4, 5, 7, 8]  # id 1 with either of its texts


def test_html(spark):
    rows = [(1, "u", None, 3), (None, None, "", 3), (2, "u", "<p", 3), (3, "u", "<!-- x", 3), (4, "u", "<script>" * 50, 3), (5, "u", "<div>" * 3000 + "deep", 3), (6, "u", "&amp;&nbsp;<<>\u0000", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(pages).collect()}
    assert len(got) == len(rows) and got[1] == got[None] == ("", 0)
    assert all(len(t) == n for t, n in got.values())
    assert html_text.extract(pages.where("false")).collect() == []


def test_warc(spark):
    same, small = "<p>" + "é" * 100, "tiny"
    rows = [(3, "u", same), (2, "u", same), (2, "u", same), (None, "u", same), (5, None, None), (6, "v", None), (7, "v", small), (8, "a\r\nb", small), (9, "u", "x" * 300_000), (-4, "u", "\u0000\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    for gzip in (True, False):
        got = warc.archived(pages, gzip=gzip).collect()
        assert not [r for r in got if r.gap]
        found = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in got)
        assert found == sorted(
            [(0, "revisit", 2, 203), (3, "revisit", 2, 203), (2, "response", None, 203), (2, "response", None, 203), (5, "response", None, 0), (6, "response", None, 0)]
            + [(7, "response", None, 4), (8, "response", None, 4), (9, "response", None, 300_000), (-4, "response", None, 15)]
        )
    assert warc.archived(pages.where("false")).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for df in (docs, none):
        out = stage(spark, df, "/root/testdata/sf0.001")
        out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == df.columns
