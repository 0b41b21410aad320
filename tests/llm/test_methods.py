"""Each method against brute force, a round trip or its own laws."""

import collections
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lookfuse.llm import boosting, decontamination, dom, language, line_dedup, lm, mixture, ngram_join, token_counts, warc
from lookfuse.llm.components import components


@pytest.fixture(scope="module")
def merger():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return token_counts.PairMerger.load(f.read()), Tokenizer.from_file(path)


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  aeInt'sl<|>\n")), max_size=80))
def test_token_counts(merger, text):
    ours, theirs = merger
    for t in (text, f"<|endoftext|>{text}<|endoftext|> <|endo"):
        assert ours.count(t) == len(theirs.encode(t, add_special_tokens=False).ids)


def test_long_piece(merger):
    ours, theirs = merger
    text = "".join(random.Random(1).choices("abcdefgh", k=30_000))
    assert ours.count(text) == len(theirs.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("percent", [60, 80, 85, 95, 100])
def test_signatures_miss_no_pair(percent):
    rng, bands, linked = np.random.default_rng(percent), ngram_join.Bands(percent), 0
    for t in range(1500):
        n = int(rng.integers(1, 50 if t % 4 else 600))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        less, more = (int(x) for x in rng.integers(0, bands.apart(n, n) // 2 + 2, 2))
        b = np.unique(np.concatenate([a[less:], rng.integers(0, 2**63, more).astype(np.uint64)]))
        if len(b) and 100 * (common := len(np.intersect1d(a, b))) >= percent * (len(a) + len(b) - common):
            linked += 1
            assert len(np.intersect1d(ngram_join.signatures(a, bands), ngram_join.signatures(b, bands)))
    assert linked > 300


def _near_copies(seed: int, groups: int = 12):
    rnd, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rnd.randrange(400)}" for _ in range(rnd.choice([3, 6, 12, 40, 150]))]
        for _ in range(rnd.choice([1, 2, 5, 30])):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                text[rnd.randrange(len(text))] = f"edit{rnd.randrange(1000)}"
            rows.append(" ".join(text).upper() if rnd.random() < 0.1 else "  ".join(text))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_components(spark, seed):
    rows = _near_copies(seed)
    sets = {k: ngram_join.shingle_set(t.encode(), 4) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and ngram_join.linked(sets[a], sets[b], 85) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    got = ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {k: (len(s), find(k)) for k, s in sets.items()}


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000 + rnd.randrange(80), 1000 + rnd.randrange(80)) for _ in range(60)] + [(5000, 5000 + i) for i in range(1, 50)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links + [(7, None), (9, 9)], "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_targets_are_the_fixed_point(spark):
    rnd = random.Random(5)
    for sizes in ([5, 1000, 20, 0, 300], [1] * 7, [rnd.randrange(1, 10**6) for _ in range(40)], [1, 10**9]):
        names = [f"s{i:03}" for i in range(len(sizes) - 1)] + [None]
        got = {r.source: r.target for r in mixture.source_targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")).collect()}
        weights, targets, total = [i % 3 + 1 for i in range(len(sizes))], [0.0] * len(sizes), sum(sizes)
        free, left = set(range(len(sizes))), float(total)
        while free:
            shares = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
            over = {i for i in free if shares[i] > 3 * sizes[i]}
            for i in over or free:
                targets[i] = 3.0 * sizes[i] if over else shares[i]
            if not over:
                break
            left, free = left - sum(3 * sizes[i] for i in over), free - over
        assert [got[n] for n in names] == pytest.approx(targets)


def test_due_inverts_the_schedule(spark):
    for number, densities in enumerate(mixture.SCHEDULES):
        df = spark.range(0, 101).select((F.col("id") / 100).alias("y")).withColumn("t", mixture.due(F.col("y"), F.lit(number)))
        grid = np.linspace(0, 1, 20_001)
        density = np.interp(grid, np.linspace(0, 1, len(densities)), densities)
        whole = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
        for r in df.collect():
            assert np.interp(r.t, grid, whole / whole[-1]) == pytest.approx(r.y, abs=1e-4)


def test_contained_items(spark):
    rnd = random.Random(9)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(rnd.choice([3, 5, 8, 15, 40, 100])))) for i in range(30)]
    docs = []
    for d in range(120):
        text = [f"d{rnd.randrange(50)}" for _ in range(rnd.choice([0, 20, 400]))]
        if rnd.random() < 0.8:
            own = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                own[rnd.randrange(len(own))] = "changed"
            at = rnd.randrange(len(text) + 1)
            text[at:at] = own
        docs.append((d, " ".join(text)))
    got = decontamination.find_contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_chars=300)
    want = set()
    for d, text in docs:
        mine = decontamination.shingles(text.split(), 5)
        for i, item in items:
            own = decontamination.shingles(item.split(), 5)
            if mine and len(own & mine) >= 0.8 * len(own) - 1e-9:
                want.add((d, i, len(own & mine)))
    assert {(r.doc_id, r.item_id, r.shared) for r in got.collect()} == want and len(want) > 20


def test_boilerplate_near_and_far_from_the_threshold(spark):
    rows = [(line, site, doc) for line, sites in enumerate([1, 9, 10, 11, 12, 40, 3000]) for doc, site in enumerate([*range(sites), 0, 0])]
    got = line_dedup.boilerplate(spark.createDataFrame(rows, "line long, site long, doc long"), 10)
    assert {(r.line, r.first_doc) for r in got.collect()} == {(2, 0), (3, 0), (4, 0), (5, 0), (6, 0)}


def test_archives_salvage():
    rnd = random.Random(4)
    payloads = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(2000))) for _ in range(40)]
    import hashlib

    records = [warc.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), len(p), None, False) for i, p in enumerate(payloads)]
    for packed in (True, False):
        parts = [warc.member(r) if packed else r for r in records]
        whole = b"".join(parts)
        read = [x for x in warc.salvage(whole) if isinstance(x[2], dict)]
        assert [r[2]["payload"] for r in read] == payloads
        ends = np.cumsum([len(p) for p in parts])
        for _ in range(30):
            victim = rnd.randrange(40)
            start = int(ends[victim]) - len(parts[victim])
            broken = bytearray(whole)
            kind = rnd.choice(["flip", "cut", "insert"])
            at = start + rnd.randrange(len(parts[victim]))
            if kind == "flip":
                broken[at] ^= 0xFF
            elif kind == "cut":
                del broken[at : int(ends[victim])]
            else:
                broken[at:at] = b"garbage \x1f\x8b\x08 WARC/1.1\r\n"
            found = list(warc.salvage(bytes(broken)))
            ids = [r["page_id"] for _, _, r in found if isinstance(r, dict)]
            assert set(ids) >= set(range(40)) - {victim}
            # Every byte is in a record or in a logged gap.
            spans = sorted({(o, n) for o, n, _ in found})
            assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))  # noqa: B905
            assert sum(spans[-1]) == len(broken)


def test_archive_files_are_members(spark, tmp_path):
    import gzip

    rows = [(i, "u", "x" * i) for i in range(50)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/a", records_per_file=20)
    files = sorted(tmp_path.glob("a/part-*"))
    assert len(files) == 3
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC-Type: response") for f in files) == 50


def test_profiles_by_hand():
    counter = language.GramCounter()
    grams, counts = counter.count("Ab, ab")
    text = {tuple(chr(x >> s & 0x1FFFFF) for s in (42, 21, 0) if x >> s & 0x1FFFFF): c for x, c in zip(grams.tolist(), counts.tolist(), strict=True)}
    assert text == {("a",): 2, ("b",): 2, (" ", "a"): 2, ("a", "b"): 2, ("b", " "): 2, (" ", "a", "b"): 2, ("a", "b", " "): 2}
    ranked = [counter.ranked(x, 50).tolist() for x in ("the cat and the hat", "der hund und der herr")]
    model = language.Profiles({"en": ranked[0], "de": ranked[1]}, 50)
    assert model.predict("the cat and the hat") == ("en", 1.0)
    own = counter.ranked("the herr", 50).tolist()
    away = {k: sum(abs(i - r.index(g)) if g in r else 50 for i, g in enumerate(own)) for k, r in zip(("en", "de"), ranked, strict=True)}
    best = min(away, key=away.get)
    assert model.predict("the herr") == (best, pytest.approx(1 - away[best] / (50 * len(own))))


def test_lm_normalises_and_learns():
    rng = np.random.default_rng(0)
    shares = rng.random(lm.SYMBOLS) + 0.1
    shares /= shares.sum()
    model = lm.Model.start(shares).normalise()
    for near, far in ((lm.BEGIN, lm.BEGIN), (3, 7), (lm.END - 1, 0)):
        scores = (model.e[near] * model.c[0] + model.e[far] * model.c[1]) @ model.r.T + model.b - model.norms[far, near]
        assert np.exp(scores.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    texts = [np.append(np.tile([5, 9, 11], 40), lm.END) for _ in range(200)]
    flat = lm.Model.start(shares).normalise().log_probabilities(texts[0]).sum()
    trainer = lm.Trainer(lm.Model.start(shares), shares, 1)
    for _ in range(4):
        trainer.run(texts)
    assert trainer.m.normalise().log_probabilities(texts[0]).sum() > 0.5 * flat
    again = lm.Model.unflat(trainer.m.flat())
    assert all(np.array_equal(getattr(again, k), getattr(trainer.m, k)) for k in "ercb")


def test_trees_fit():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = boosting.fit(x[:1500], y[:1500], trees=30, depth=3)
    assert ((model.log_odds(x[1500:]) > 0) == y[1500:]).mean() > 0.97


def test_decoding_is_consistent_and_best():
    rng = np.random.default_rng(6)
    page = dom.Page("<div><p>a<p>b<div><p>c</div></div><section><p>d<div>e<p>f</div></section>")
    parents = [page.numbers[id(n.parent)] if n.parent else 0 for n in page.nodes]
    blocks = collections.Counter()
    for at, _ in page.blocks:
        while True:
            blocks[at] += 1
            if at == 0:
                break
            at = parents[at]
    n = len(page.nodes)
    for _ in range(50):
        odds = rng.normal(0, 2, n)
        got = dom.decode(page, odds)
        assert all(got[parents[i]] for i in range(1, n) if got[i])
        best = max(
            sum(odds[i] * blocks[i] for i in range(1, n) if bits >> i & 1)
            for bits in range(1, 1 << n, 2)
            if all(bits >> parents[i] & 1 for i in range(1, n) if bits >> i & 1)
        )
        assert sum(odds[i] * blocks[i] for i in range(1, n) if got[i]) == pytest.approx(best)
