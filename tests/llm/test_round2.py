"""Cases of the second round's review."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from lookfuse.llm import dom, lm, warc


def _documents(spark, rows):
    return spark.createDataFrame([(i, f"site{s}", t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")


def test_long_passage_on_few_sites(spark):
    def passage(n):
        return " ".join(f"word{n}x{i}" for i in range(55))

    # Passage n stands on n sites, with a short line of its own.
    rows = [(k % n, f"{passage(n)}\nshort line {n}\nonly here {n} {k}") for n in range(2, 10) for k in range(30)]
    texts = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.line_deduplication(spark, _documents(spark, rows), "").collect()}
    for i in range(len(rows)):
        n, k = 2 + i // 30, i % 30
        assert texts[i] == ([passage(n)] if n < 3 or k == 0 else []) + [f"short line {n}", f"only here {n} {k}"]


def test_lines_without_spaces(spark):
    line, passage = "本站所有内容版权归原作者所有转载请注明出处", "长" * 130
    rows = [(k, f"{line}\n首页\n正文{k}") for k in range(12)] + [(k % 4, f"{passage}\n别的{k}") for k in range(8)]
    texts = {r.doc_id: r.text for r in corpus_pipeline.line_deduplication(spark, _documents(spark, rows), "").collect()}
    assert [texts[k] for k in range(12)] == [f"{line}\n首页\n正文0"] + [f"首页\n正文{k}" for k in range(1, 12)]
    assert [texts[12 + k] for k in range(8)] == [f"{passage}\n别的0"] + [f"别的{k}" for k in range(1, 8)]


def _inside():
    rng = np.random.default_rng(5)
    found = [f"w{i}".encode() for i in range(3000)]
    counts = np.sort(rng.integers(2, 500, 3000))[::-1].astype(float)
    units = np.bincount([lm.word_class(w) - lm.WORD_SYMBOLS for w in found[lm.WORD_SYMBOLS :]], counts[lm.WORD_SYMBOLS :] + 1, lm.CLASSES) + 7.0
    return found, lm.Vocabulary(found, counts, units)


def test_words_inside_classes_normalise_and_learn():
    found, vocabulary = _inside()
    pair = found[2000:2002]
    places, symbols = vocabulary.encode((pair + found[:1] + [b"unseen"]) * 300)
    rows = vocabulary.inside(places, symbols)
    assert (rows[:4] >= 0).tolist() == [True, True, False, True]
    ids = [np.append(symbols, lm.END)]
    trainer = lm.InsideTrainer(lm.Inside.start(vocabulary.starts, vocabulary.biases), 1)
    own, k = rows[1], symbols[1] - lm.WORD_SYMBOLS

    def score():
        m = trainer.m.normalise()
        return m.log_probabilities(symbols[:1], np.array([own]), np.array([k]))[0]

    before = score()
    assert abs(before - vocabulary.biases[own]) < 1e-5
    for _ in range(20):
        trainer.run(ids, [np.append(rows, -1)])
    # A word beyond the 383 is scored by what stands before it, which its count alone could not tell.
    assert score() > before + 0.5
    m, block = trainer.m, np.arange(vocabulary.starts[k], vocabulary.starts[k + 1])
    for near in (lm.BEGIN, int(symbols[0]), 3):
        assert abs(np.exp(m.log_probabilities(np.full(len(block), near), block, np.full(len(block), k))).sum() - 1) < 1e-4


def _records(payloads):
    return [warc.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), len(p), None, False) for i, p in enumerate(payloads)]


def _packed(data, level=6):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _ids(data):
    found = list(warc.salvage(data))
    spans = sorted({(o, n) for o, n, _ in found})
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))  # noqa: B905
    assert sum(spans[-1]) == len(data)
    return [r["page_id"] for _, _, r in found if isinstance(r, dict)], [r for _, _, r in found if isinstance(r, str)]


@pytest.mark.parametrize("level", [0, 6])
def test_members_of_many_records(level):
    rnd = random.Random(9)
    records = _records([bytes(rnd.randrange(97, 123) for _ in range(3000)) for _ in range(30)])
    bad = bytearray(records[11])
    bad[-100] ^= 1
    after = warc.member(_records([b"x"] * 41)[40])
    broken = _packed(b"".join(records[:11]) + bytes(bad) + b"".join(records[12:]), level)
    ids, gaps = _ids(broken + after)
    assert ids == [*range(11), *range(12, 30), 40]
    start = sum(map(len, records[:11]))
    assert gaps == [f"bytes {start} to {start + len(bad)} of the unpacked member: payload digest differs"]
    whole = _packed(b"".join(records), level)
    for tail in (b"", after):
        ids, gaps = _ids(whole[: len(whole) // 2] + tail)
        assert ids[:14] == list(range(14)) and (not tail or ids[-1] == 40) and gaps
        assert len(set(ids)) == len(ids)
    checksum = bytearray(whole)
    checksum[-6] ^= 1
    ids, gaps = _ids(bytes(checksum) + after)
    assert ids == [*range(30), 40] and gaps


def test_damaged_headers_are_not_believed():
    whole = bytearray(_packed(b"".join(_records([b"a" * 200, b"b" * 200])), 0))
    at = whole.index(b"http://x/1")
    whole[at + 7] ^= 1
    assert _ids(bytes(whole))[0] == [0]


@pytest.mark.parametrize("start", ["<html><head><title>t</title><body>", "<head><title>t</title>", "<title>t</title>", "<html><head><meta charset=utf-8>"])
def test_left_out_head_and_body_tags(start):
    assert [t for _, t in dom.Page(f"{start}<p>One two.<p>Three").blocks] == ["One two.", "Three"]
    assert [t for _, t in dom.Page(f"{start}\nFour <b>five</b>").blocks] == ["Four five"]


def test_lm_reads_every_text_once(spark, monkeypatch):
    read = []
    monkeypatch.setattr(lm.Trainer, "run", lambda self, texts: read.append(sum(map(len, texts))))
    monkeypatch.setattr(lm.InsideTrainer, "run", lambda self, texts, rows: None)
    caught = []

    class Frame:
        """Dealt and sorted as Spark would: two learners' texts, one after the other."""

        def select(self, *_):
            return self

        repartition = sortWithinPartitions = select

        def mapInArrow(self, run, schema):
            import pyarrow as pa

            codes = pa.array([[0, 1, -3]] * 10, pa.list_(pa.int32()))
            batch = pa.RecordBatch.from_arrays([pa.array([0] * 4 + [1] * 6, pa.int64()), pa.array(range(10)), codes], names=["learner", "order", "__codes"])
            assert len(list(run(iter([batch.slice(0, 3), batch.slice(3)])))) == 2
            caught.append(True)
            raise StopIteration

    _, vocabulary = _inside()
    monkeypatch.setattr(lm, "_vocabulary", lambda shared: vocabulary)
    with pytest.raises(StopIteration):
        lm.train(Frame(), 2, None, np.full(lm.SYMBOLS, 1 / lm.SYMBOLS))
    assert caught and sum(read) == 40
