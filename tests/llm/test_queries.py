"""Registered queries against their SQL, or what else is known of their results."""

import glob
import os
import re
from html import unescape

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lookfuse.llm import line_dedup, ngram_join, quality
from lookfuse.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    want = sorted((tuple(r[columns.index(c)] for c in names) for r in answer.fetchall()), key=repr)
    assert sorted(columns) == names
    assert got == want and got


def _documents(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_token_counts(spark, duck):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = _documents(duck)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op10_token_counts"](spark, FOLDER).collect()}
    counts = {k: len(e.ids) for k, e in zip(texts, tokenizer.encode_batch([t or "" for t in texts.values()], add_special_tokens=False), strict=True)}
    assert got == {k: (len((t or "").encode()), counts[k], counts[k] > 1024) for k, t in texts.items()}


def test_quality(spark, duck):
    def base(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = {}
        for i in range(len(found) - 7):
            windows.setdefault(tuple(found[i : i + 8]), []).append(i)
        repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)

    rows = QUERIES["op9_quality"](spark, FOLDER).collect()
    texts = _documents(duck)
    assert {r.doc_id: tuple(r[c] for c in quality.MEASURES) for r in rows} == {k: base(t) for k, t in texts.items()}
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(bool(q) == k for q, k in judged) >= 0.97 * len(judged)


def test_language_held_out(spark, duck):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents WHERE len(text) > 50").fetchall())
    rows = [r for r in QUERIES["op6_language"](spark, FOLDER).collect() if r.held_out and r.doc_id in langs]
    assert len(rows) > 30
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_lm_base_and_gain(spark, duck):
    import math
    import zlib
    from collections import Counter

    texts = {k: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for k, t in _documents(duck).items()}
    training = [w for k, w in texts.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(x for w in training for x in w)
    n, v = sum(counts.values()) + len(training), len(counts) + 1
    rows = QUERIES["op7_lm_score"](spark, FOLDER).collect()
    for r in rows:
        found = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(found) + 1, sum(counts[w] > 0 for w in found) + 1, n)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found) + math.log10((len(training) + 1) / (n + v + 1))
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_html(spark, duck):
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    got = {r.page_id: r.text for r in QUERIES["op3_html_text"](spark, FOLDER).collect()}
    right = 0
    for page_id, html in pages.items():
        inside = re.search(r"<article>(.*)</article>", html, re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inside))
        right += got[page_id] == "\n\n".join(b for b in blocks if b)
    assert got.keys() == pages.keys() and right >= 0.97 * len(pages)


def test_pipeline(spark, duck):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    kept = {r.doc_id for r in rows}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # Step by step, each stage judged on what the one before it kept.
    first = {r.doc_id for r in quality.judge(documents).where("kept").collect()}
    cleaned = line_dedup.drop_boilerplate(documents.where(F.col("doc_id").isin(list(first)))).drop("n_lines", "n_removed")
    cleaned = {r.doc_id: r.text for r in cleaned.collect()}
    sets = {k: ngram_join.shingle_set(t.encode(), 5) for k, t in sorted(cleaned.items())}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if ngram_join.linked(sets[a], sets[b], 80) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    third = [k for k in ids if find(k) == k or not sets[k]]
    items = [ngram_join.shingle_set(t.encode(), 5) for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    fourth = {k for k in third if not any(len(i & sets[k]) >= 0.8 * len(i) - 1e-9 for i in items)}
    assert kept <= fourth
    sizes = {k: len(re.findall(r"[^\x20\x09-\x0D]+", cleaned[k])) for k in fourth}
    taken = {}
    for r in rows:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.words
        assert r.text == cleaned[r.doc_id]
    assert all(taken[k] <= 3 * sizes[k] for k in taken)
    assert abs(sum(taken.values()) - sum(sizes.values())) <= 20
    assert [r.position for r in rows] == sorted(r.position for r in rows)
