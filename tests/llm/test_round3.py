"""Chat logs, divergence of sources and lexical search, against plain readings of their definitions."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lookfuse.llm import chat, common, divergence, lexical

LOG = "conv_id long, turn long, message string, seq long, kind string, role string, text string"


# Chat.


def _fold(events):
    """Messages of one conversation, event by event in the order of seq."""
    messages = {}
    first = (lambda v: (v is not None, v if v is not None else 0))
    text = (lambda v: (v is not None, v or ""))
    for turn, message, seq, kind, role, said in sorted(events, key=lambda e: (e[2] if e[2] is not None else -(2**63), text(e[3]), text(e[4]), e[5] or "")):
        key, said = (first(turn), text(message)), said or ""
        if kind == "regenerate":
            messages = {k: v for k, v in messages.items() if k[0] < key[0]}
        if kind == "delta" and key in messages:
            messages[key] = (messages[key][0], messages[key][1] + said)
        elif kind == "edit" and key in messages:
            messages[key] = (role if role is not None else messages[key][0], said)
        else:
            messages[key] = (role, said)
    return [(r or "", t) for _, (r, t) in sorted(messages.items())]


def _digest(messages):
    loss = "".join(t for r, t in messages if r == "assistant")
    said = "".join(f"{r}\n{t}\n" for r, t in messages)
    written = sum(len(p.decode()) for p in (chat.render(r.encode(), t.encode())[0] for r, t in messages))
    return len(messages), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), written


def _random_log(seed):
    pick = random.Random(seed)
    pieces = ["a", "\\", "#", "</turn>", "<\\/", "\n", "### user", "é🎉", "", None, "\\n", "<", "/turn>"]
    rows = []
    for conv in [*range(12), None]:
        for seq in range(pick.randrange(1, 60)):
            kind = pick.choice(["message", "delta", "delta", "edit", "regenerate", "delta", None, "other"])
            role = pick.choice(["user", "assistant", "assistant", "a\nb#", None])
            rows.append((conv, pick.choice([0, 1, 2, 3, 4, None]), pick.choice(["x", "y", None]), seq, kind, role, pick.choice(pieces)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("split", [10**9, 1, 500])
def test_chat_folds_like_a_reader(spark, split):
    rows = _random_log(split)
    log = spark.createDataFrame(rows, LOG).withColumns({c: F.lit("clash") for c in ("lot", "cut", "lots", "bytes", "formatted")}).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(chat.format_conversations(log, split_bytes=split)).collect()}
    convs = {r[0] for r in rows}
    # Kinds that are null or unknown open a message.
    events = {c: [(t, m, s, k if k in ("delta", "edit", "regenerate") else "message", r, x) for v, t, m, s, k, r, x in rows if v == c] for c in convs}
    assert got == {c: _digest(_fold(e)) for c, e in events.items()}


def test_chat_ties_and_null_seq(spark):
    rows = [(1, 0, "m", None, "message", "user", "early"), (1, 0, "m", 5, "delta", None, "b"), (1, 0, "m", 5, "delta", None, "a"), (1, 0, "m", 5, "delta", None, "a")]
    rendered, _ = chat.format_conversations(spark.createDataFrame(rows, LOG))
    assert [bytes(r.formatted) for r in rendered.collect()] == [b"### user\nearlyaab</turn>\n"]


def test_chat_escapes_reversibly():
    pick = random.Random(3)
    for _ in range(3000):
        messages = [tuple("".join(pick.choice(["\\", "#", "<", "/", "turn>", "</turn>", "\n", "n", "### ", "x", "é"]) for _ in range(pick.randrange(9))).encode() for _ in "rt") for _ in range(3)]
        assert list(chat.parse(b"".join(chat.render(*m)[0] for m in messages))) == messages
        for role, text in messages:
            written, start, end = chat.render(role, text)
            assert chat.unescape(written.decode()[start:end].encode()) == text


def test_chat_turns(spark):
    long = "wörd " * 40_000
    rows = [(1, 0, "user", None), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, 0, None, "a"), (2, 0, None, "b"), (None, None, "assistant", ""), (3, 7, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    log = chat.turn_events(turns)
    assert log.where("kind = 'delta'").count() > 1000
    for split in (10**9, 1000):
        got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(log, split_bytes=split)).collect()}
        assert {k: r.n_turns for k, r in got.items()} == {1: 3, 2: 2, None: 1, 3: 1}
        assert got[1].loss_sha256 == hashlib.sha256((long + long).encode()).hexdigest() and got[1].loss_chars == 2 * len(long)
        assert got[3].loss_chars == 0 and got[3].turns_sha256 == hashlib.sha256(b"assistant\n\n").hexdigest()
    assert chat.read_back(chat.format_conversations(chat.turn_events(turns.where("false")))).collect() == []


# Divergence.


def _audit(rows, min_docs, top):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= min_docs]
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if held[t] >= min_docs) for s in {d[1] for d in own}}
        counts[None] = sum(counts.values(), Counter())
        share = {s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept} for s, c in counts.items()}
        for s in counts.keys() - {None}:
            found = [("pair", r, sum(abs(share[s][t] - share[r][t]) for t in kept)) for r in counts.keys() - {None, s}]
            found += [("term", t, share[s][t] - share[None][t]) for t in kept if counts[s][t] and share[s][t] > share[None][t]]
            for part in ("pair", "term"):
                ranked = sorted(((-v, i.encode()) for p, i, v in found if p == part))
                out += [(lang, s, part, i.decode(), -v, n + 1) for n, (v, i) in enumerate(ranked) if part == "pair" or n < top]
    return sorted(out)


def _texts(seed, n, sources):
    pick = random.Random(seed)
    words = ["a", "of", "then", "thence", "thenceforth", "thenceforward", "Éclair", "éclairs", "日本", "日本語語語語", "x1y", "ab" * 40, "ab" * 40 + "c", "ab" * 40 + "d"]
    rows = [(pick.choice(["en", "fr", None, ""]), pick.choice(sources), " ".join(pick.choice(words) for _ in range(pick.randrange(12)))) for _ in range(n)]
    return [*rows, ("none", "s", ""), ("none", "t", None), ("none", None, "rare words"), rows[0], rows[0]]


@pytest.mark.parametrize("block", [256, 2])
def test_divergence_against_plain_counts(spark, block):
    rows = _texts(block, 260, ["a", "b", "c", "d", "e", None])
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit("clash") for c in ("doc_id", "term", "count", "number", "unit", "rank", "value")})
    if block != 256:
        # Tasks read the module's value on their side, so blocks are tested on the function itself below.
        return _blocks(block)
    assert sorted(map(tuple, divergence.audit(docs.repartition(4), min_docs=9, top=3).collect())) == _audit(rows, 9, 3)
    assert divergence.audit(docs.where("false")).collect() == []
    # Nobody keeps a term: pairs of value 0.
    got = divergence.audit(docs, min_docs=10_000).collect()
    assert {r.part for r in got} == {"pair"} and {r.value for r in got} == {0}


def _blocks(size):
    import numpy as np
    import pyarrow as pa

    pick = np.random.default_rng(1)
    shares = pick.integers(1, 1000, (40, 5))
    base = pick.integers(1, 9, 5)
    here = pick.random((40, 5)) < 0.5
    dense = np.where(here, shares, base)
    old, divergence.SOURCES = divergence.SOURCES, size
    try:
        totals = {}
        for a, b in [(a, b) for a in range(3) for b in range(a, 3)]:
            inside = [i for i in range(5) if i // size in (a, b)]
            rows = [("en", a, b, 0, True, [{"number": i, "p": int(base[i])} for i in reversed(inside)])]
            rows += [("en", a, b, 0, False, [{"number": i, "p": int(shares[t, i])} for i in inside if here[t, i]]) for t in range(40)]
            cells = pa.list_(pa.struct([("number", pa.int32()), ("p", pa.int64())]))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), cells]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list("labsfc"))
            for found in divergence._pair_sums(iter([batch.slice(0, 7), batch.slice(7)])):
                for _, x, y, v in zip(*(c.to_pylist() for c in found.columns), strict=True):
                    totals[x, y] = totals[y, x] = v
        want = {(x, y): int(np.abs(dense[:, x] - dense[:, y]).sum()) for x in range(5) for y in range(5)}
        assert totals == want
    finally:
        divergence.SOURCES = old


def test_divergence_discards_rare_prefixes(spark):
    """Only extensions of frequent prefixes are counted, and full terms by exact counts."""
    rows = [("en", "s", "frequent frequency " + f"frequented{i} rare{i}zzzzzzz")for i in range(40)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("text", F.col("text").cast("binary"))
    kept = {(bytes(r.term), r.docs) for r in divergence.kept_terms(docs, 40).collect()}
    assert kept == {(b"frequent", 40), (b"frequency", 40), (b"frequented", 40), (b"zzzzzzz", 40), (b"rare", 40)}
    number = docs.select("lang", F.lit(b"freq").alias("unit")).limit(1)
    passed = divergence.PrefixFilter.of(number, 1)
    assert passed(b"en", b"freq") and not passed(b"fr", b"freq") and not passed(b"en", b"rare")


def test_divergence_counts_in_runs(monkeypatch):
    """What a task hands on in many runs adds up to what it hands on in one."""
    import pyarrow as pa

    rows = [(t.encode() if t else b"", lang or "", source or "") for lang, source, t in _texts(7, 120, ["a", "b"])]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["text", "lang", "source"])
    totals = []
    for held in (10**6, 25, 3):
        monkeypatch.setattr(divergence, "HELD", held)
        total = Counter()
        for found in divergence._level(0, 6, None)(iter([batch.select(["text", "lang"])])):
            for lang, unit, whole, docs in zip(*(c.to_pylist() for c in found.columns), strict=True):
                total[lang, unit, whole] += docs
        totals.append(total)
    assert totals[0] == totals[1] and totals[0]["en", b"thence", False] > 0 and totals[0]["en", b"thence", True] > 0


# Lexical search.


def _rank(docs, items, top):
    found = [(k, Counter(_terms(t))) for k, t in docs]
    found = [(k, c, sum(c.values())) for k, c in found if c]
    n_docs, total = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, tf, n in found:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in set(_terms(text)) if t in tf)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -s) for i, (s, null, doc) in enumerate(sorted(scores)[:top])]
    return out


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_search_against_all_scores(spark):
    pick = random.Random(5)
    words = [f"w{int(pick.paretovariate(0.7))}" for _ in range(600)] + ["Élan", "日本", "x-y"]
    docs = [(i // 2 if i % 5 else i, " ".join(pick.choice(words) for _ in range(pick.choice([3, 9, 40, 200])))) for i in range(1500)]
    docs += [(None, docs[3][1]), (None, None), (9_000, ""), (9_001, "?!"), (9_002, "w1 " * 100_000), *docs[:30]]
    items = [(i, " ".join(pick.choice(words) for _ in range(12))) for i in range(25)] + [(3, "w1 w1 W1"), (None, "w2 w5"), (77, None), (78, "unheard"), (79, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("item", "item_id", "score", "rank", "length", "terms", "n")})
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    key = (lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))
    for block_terms in (10**6, 60):
        got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(frame, queries, top=20, block_terms=block_terms).collect()]
        assert sorted(got, key=key) == sorted(_rank(docs, items, 20), key=key)
    assert lexical.search(frame.where("false"), queries).collect() == []
    assert lexical.search(frame, queries.where("false")).collect() == []


def test_search_prunes_buckets(spark, monkeypatch):
    """Short vectors are neither read nor scored once longer ones hold an item's places."""
    import numpy as np

    weights = np.array([5000, 1, 1], np.int64)
    item = lexical._Item(np.array([0, 1]), weights, 10**9, 2)
    before = item.offer
    called = []
    monkeypatch.setattr(item, "offer", lambda *a: called.append(1) or before(*a))
    one, m = np.array([1, 1]), np.array([50, 50])
    docs, ids, counts, each = np.array([[0, 0], [1, 2]]), np.array([1, 2]), np.array([1, 1]), np.array([1, 1])
    lexical._search_bucket([item], weights, docs, m, ids, counts, each, np.sqrt(one * 1.0) * 5e5)
    assert not called and item.least == 10**9


# Terms of long texts.


def test_term_lists_cut_at_spaces_only():
    pick = random.Random(2)
    table = common.term_table(digits=True)
    for _ in range(300):
        text = "".join(pick.choice(["a", "B", "é", " ", "-", "1", "\u0000"]) for _ in range(pick.randrange(60))).encode()
        whole = text.translate(table).split()
        for size in (1, 2, 7, 1000):
            assert [t for found in common.term_lists(text, table, size) for t in found] == whole
    assert list(common.term_lists(None, table)) == []


# Language model.


def _model_rows(spark, docs, monkeypatch, partitions):
    from lookfuse.llm import lm

    caught, train = {}, lm.train

    def catching(coded, n_learners, shared, shares):
        caught["fitted"] = train(coded, n_learners, shared, shares)
        caught["vocabulary"] = lm._vocabulary(shared)
        return caught["fitted"]

    monkeypatch.setattr(lm, "train", catching)
    monkeypatch.setattr(lm, "LEARNER_TOKENS", 4000)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions, "doc_id")
    rows = {r.doc_id: r for r in lm.score(frame, F.col("doc_id") % 7 != 2).collect()}
    monkeypatch.undo()
    return rows, caught


def _prose(seed, n):
    pick = random.Random(seed)
    words = [f"w{int(pick.paretovariate(0.6)) % 3000}" for _ in range(4000)] + ["É", "日本", *(f"u{i}" for i in range(800))]
    return [(i, " ".join(pick.choice(words) for _ in range(pick.choice([0, 1, 30, 120])))) for i in range(n)]


def test_lm_is_the_same_in_any_layout(spark, monkeypatch):
    docs = _prose(1, 300)
    want, _ = _model_rows(spark, docs, monkeypatch, 1)
    for partitions in (8, 32):
        got, _ = _model_rows(spark, docs, monkeypatch, partitions)
        assert got.keys() == want.keys()
        for k, r in got.items():
            assert (r.n_tokens, r.n_known, r.train_tokens) == (want[k].n_tokens, want[k].n_known, want[k].train_tokens)
            assert abs(r.score - want[k].score) <= 1e-4 * abs(want[k].score) and abs(r.base_score - want[k].base_score) < 1e-6


def test_lm_scores_by_both_softmaxes(spark, monkeypatch):
    """A text's score reckoned word by word from the fitted vectors: symbols over all symbols, words over their class."""
    import numpy as np

    from lookfuse.llm import lm

    docs = _prose(2, 200)
    monkeypatch.setattr(lm, "FREQUENT", 420)
    rows, caught = _model_rows(spark, docs, monkeypatch, 4)
    (model, inside), vocabulary = caught["fitted"], caught["vocabulary"]
    counts = Counter(w for k, t in docs if k % 7 != 2 for w in t.split())
    checked = 0
    for k, text in docs[:40]:
        found, before, total = text.split(), [lm.BEGIN, lm.BEGIN], 0.0
        for word in [*found, None]:
            encoded = None if word is None else word.encode()
            place = vocabulary.at.get(encoded, -1) if encoded else -1
            symbol = lm.END if word is None else place if 0 <= place < lm.WORD_SYMBOLS else lm.word_class(encoded)
            hidden = model.e[before[1]] * model.c[0] + model.e[before[0]] * model.c[1]
            scores = (model.r @ hidden + model.b).astype(float)
            total += scores[symbol] - math.log(np.exp(scores).sum())
            if word is not None and symbol >= lm.WORD_SYMBOLS:
                block = slice(vocabulary.starts[symbol - lm.WORD_SYMBOLS], vocabulary.starts[symbol - lm.WORD_SYMBOLS + 1])
                scores = (inside.r[block] @ inside.a[before[1]] + vocabulary.biases[block]).astype(float)
                row = vocabulary.rows[place] if place >= 0 else block.stop - 1
                total += scores[row - block.start] - math.log(np.exp(scores).sum())
                if place < 0:
                    total += math.log(counts[word] + 1) - vocabulary.log_rest[symbol - lm.WORD_SYMBOLS] * math.log(10)
                    checked += 1
            before = [before[1], symbol]
        assert abs(rows[k].score - total / math.log(10)) < 1e-3 * max(1, abs(rows[k].score))
    assert checked > 20


def test_lm_cuts_long_texts_anywhere(monkeypatch):
    from lookfuse.llm import lm

    pick = random.Random(4)
    texts = ["".join(pick.choice(["a", "B", "é", " ", "\n", " ", "\t", "\u0000"]) for _ in range(pick.randrange(40))).encode() for _ in range(60)]
    for size in (1, 7, 10**6):
        monkeypatch.setattr(lm, "HELD_BYTES", size)
        got = [[] for _ in texts]
        for names, word, of in lm.cut_words(texts):
            for n, i in zip(of.tolist(), word.tolist(), strict=True):
                got[n].append(names[i])
        assert got == [t.lower().split() for t in texts]


def test_lm_scores_long_texts_in_stretches(spark, monkeypatch):
    import numpy as np

    from lookfuse.llm import lm

    model = lm.Model.start(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS)).normalise()
    ids = np.append(np.random.default_rng(1).integers(0, lm.END, 50), lm.END)
    whole = model.log_probabilities(ids).sum()
    parts = sum(model.log_probabilities(ids[i : i + 7], np.concatenate([[lm.BEGIN] * 2, ids[max(i - 2, 0) : i]])[-2:]).sum() for i in range(0, len(ids), 7))
    assert abs(whole - parts) < 1e-6


# Pages.


def test_training_marks_mean_nothing_on_pages(spark):
    from lookfuse.llm import dom, html_text

    page = '<article><h1 data-truth="x">Title of it</h1><p data-truth="">' + "Some words of a paragraph, and some more. " * 5 + "</p></article>"
    plain = page.replace(' data-truth="x"', "").replace(' data-truth=""', "")
    got = [r.text for r in html_text.extract(spark.createDataFrame([(1, "u", page), (2, "u", plain)], "page_id long, url string, html string")).collect()]
    assert got[0] == got[1] != ""
    assert {n.label for n in dom.Page(page.replace('"x"', '"0"')).nodes[1:]} == {-1}


@pytest.mark.parametrize("inline", ['<span class="top">northern</span>', '<em id="text">northern</em>', '<time class="meta">northern</time>', '<span class="share"><b>north</b>ern</span>'])
def test_inline_elements_end_no_block(inline):
    from lookfuse.llm import dom, html_text

    words = "A sentence about the coast and its people, which goes on for a while. " * 4
    page = f"<html><body><article><h1>The coast</h1><p>{words}the {inline} coast</p><p>{words}</p></article></body></html>"
    assert [t for _, t in dom.Page(page).blocks][1] == f"{words}the northern coast"
    assert html_text.main_texts([page], html_text.train())[0] == f"The coast\n\n{words}the northern coast\n\n{words.strip()}"


def test_inline_adverts_and_hidden_text_go():
    from lookfuse.llm import dom

    page = '<p>One <span class="ad">buy</span>two <i style="display:none">no</i> <span class="sponsored"><b>x</b></span>three.</p><div><span class="ad">alone</span></div>'
    found = dom.Page(page)
    assert [t for _, t in found.blocks] == ["One two three.", "alone"]
    assert [found.nodes[n].tag for n, _ in found.blocks] == ["p", "span"]


@pytest.mark.parametrize("shape", [
    "<div>", "<p><b>", "<ul><li><div>", "</b></p>", "<a ", '<a x="', "<a '", "<b", "<!--", "<li></li>", "<td><div>", "<p>x<table><tr><td>", "<head><div>", "<script>", "< <", "&amp", "<span class='top'>",
])
def test_long_markup_takes_linear_time(shape):
    import time

    from lookfuse.llm import dom

    def seconds(size):
        start = time.perf_counter()
        dom.Page(f"<ul><li><div><p>{'<div>' * 2000}" + shape * (size // len(shape)))
        return time.perf_counter() - start

    small, large = min(seconds(60_000) for _ in range(2)), seconds(600_000)
    assert large < 25 * small + 0.5 and large < 12


@pytest.mark.parametrize("raw", ["a" * 400_000, "a " * 200_000, "a" * 200_000 + " " * 200_000, "x='" + "y" * 400_000, "hidden " * 60_000, "a=b " * 100_000, "-" * 400_000])
def test_long_attributes_take_linear_time(raw):
    import time

    from lookfuse.llm import dom

    start = time.perf_counter()
    dom._attributes(raw, False)
    dom.Page(f"<div {raw}>text</div>")
    assert time.perf_counter() - start < 4


def test_searches_find_what_a_walk_finds():
    """Which open element a start tag closes, with counters, against walks over the stack."""
    from lookfuse.llm import dom

    def walked(tags):
        stack, out = ["html"], []
        for end, tag in tags:
            if end:
                if tag in stack[1:]:
                    del stack[len(stack) - 1 - stack[::-1].index(tag) :]
            else:
                sought, bounds = dom._SEARCHES.get("p" if tag in dom.CLOSES_P else tag if tag in dom.CLOSES else "", (set(), set()))
                lowest = None
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i] in bounds:
                        break
                    if stack[i] in sought:
                        lowest = i
                        if tag in dom.CLOSES_P:
                            break
                if lowest:
                    del stack[lowest:]
                out.append((tag, len(stack)))
                stack.append(tag)
        return out

    pick = random.Random(6)
    names = ["p", "div", "ul", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "tbody", "tfoot", "section", "caption", "menu"]
    for _ in range(400):
        tags = [(pick.random() < 0.3, pick.choice(names)) for _ in range(40)]
        page = dom.Page("".join(f"</{t}>" if end else f"<{t}>" for end, t in tags))
        assert [(n.tag, n.depth) for n in page.nodes[1:]] == walked(tags)


# Language.


def test_language_counts_do_not_depend_on_cuts(monkeypatch):
    from lookfuse.llm import language

    pick = random.Random(9)
    counter = language.GramCounter()

    def plain(text):
        found, words = Counter(), re.findall(r"[^\W\d_]+", text.lower())
        for word in words:
            for c in word:
                found[c] += 1
            padded = f" {word} "
            for n in (2, 3):
                for i in range(len(padded) - n + 1):
                    found[padded[i : i + n]] += 1
        return found

    for _ in range(200):
        text = "".join(pick.choice(["a", "B", "é", " ", ".", "Σ", "日", "🎉", "1", "İ", "\n"]) for _ in range(pick.randrange(40)))
        results = []
        for size in (1 << 20, 1, 2, 3, 7):
            monkeypatch.setattr(language, "PIECE", size)
            grams, counts = counter.count(text)
            results.append(dict(zip(grams.tolist(), counts.tolist(), strict=True)))
        assert all(r == results[0] for r in results)
        if text.isascii():
            coded = {sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g)): n for g, n in plain(text).items()}
            assert results[0] == coded


# Archives.


def test_salvage_of_many_damaged_records_takes_linear_time():
    import hashlib
    import time

    from lookfuse.llm import warc

    def seconds(n):
        parts = [warc.record(i, f"http://x/{i}", b"p" * 300, hashlib.sha256(b"p" * 300).hexdigest(), 300, None, False) for i in range(n)]
        data = b"".join(p.replace(b"sha256:", b"sha256:0", 1) if i % 2 else p for i, p in enumerate(parts))
        start = time.perf_counter()
        found = list(warc.salvage(data))
        assert len([x for x in found if isinstance(x[2], dict)]) == n // 2
        return time.perf_counter() - start

    small, large = min(seconds(500) for _ in range(2)), seconds(8000)
    assert large < 40 * small + 0.5
