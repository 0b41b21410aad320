"""Log-bilinear language model, trained with noise-contrastive estimation, scoring whole texts.

Words are counted over all training texts. The model predicts symbols: each of the most frequent words, the end of a
text, and classes of the other words by their ending. The next symbol's score is bilinear in the vectors of the two
symbols before it and its own, plus a bias. Inside a class a second softmax chooses the word: each of the words that
every task has (FREQUENT at most) has a vector of its own, as have all others of the class together, and its score is
bilinear in that and in a vector of the symbol before, plus the log of its share of the class. Only the words beyond
have the share of their count among the others, one unit being kept for unseen words.

Texts are cut and numbered once, for learning and for scoring. Training texts are dealt by a hash to learners of about
LEARNER_TOKENS tokens each, in the order of the hash, so what is learned does not depend on how files or partitions lie. Every
learner takes its texts once through noise-contrastive estimation in numpy, from a common start
(small random vectors, biases of the symbols' shares), and the learners' parameters are averaged by their tokens. The
normaliser depends on the two symbols before only: batched matrix products give it for all pairs of symbols once, and
every token's log probability is then normalised exactly. Inside a class it depends on the symbol before only, and is
had in the same way. A word's vector is averaged by how often each learner has the word, so a learner gives only words it has.

Words beyond the most frequent ones are scored by a join with the counts: no single word of them is frequent, so no
key of that join is hot.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.llm.common import stored

#: Symbols: frequent words, classes of other words, the end. One more, the begin, is only ever a context.
WORD_SYMBOLS = 383
CLASSES = 128
SYMBOLS = WORD_SYMBOLS + CLASSES + 1
END = SYMBOLS - 1
BEGIN = SYMBOLS
#: At most so many words, the most frequent, whose counts every task has; the others are joined.
FREQUENT = 1 << 17
CONTEXT = 2
DIMENSIONS = 24
NOISE = 64
BATCH = 2048
BUFFER = 1 << 16
#: Symbols scored at once.
SCORED = 1 << 16
RATE = 0.15
#: Noise words for the words of one class in a buffer.
INSIDE_NOISE = 32
_LOG_INSIDE = np.float32(math.log(INSIDE_NOISE))
#: Tokens of one learner, about.
LEARNER_TOKENS = 8_000_000
#: Bytes of text that are cut into words at once, and texts.
HELD_BYTES = 8_000_000
HELD_TEXTS = 1000


def word_class(word: bytes) -> int:
    """The symbol of a word that has none of its own: a hash of its last three bytes."""
    return WORD_SYMBOLS + zlib.crc32(word[-3:]) % CLASSES


class Model:
    """Vectors of contexts ``e`` and targets ``r``, weights ``c`` by position before the target, biases ``b``."""

    def __init__(self, e: np.ndarray, r: np.ndarray, c: np.ndarray, b: np.ndarray):
        self.e, self.r, self.c, self.b = e, r, c, b
        self.norms: np.ndarray | None = None

    @classmethod
    def start(cls, shares: np.ndarray) -> Model:
        rng = np.random.default_rng(7)
        return cls(
            rng.normal(0, 0.1, (SYMBOLS + 1, DIMENSIONS)).astype(np.float32),
            rng.normal(0, 0.1, (SYMBOLS, DIMENSIONS)).astype(np.float32),
            np.ones((CONTEXT, DIMENSIONS), np.float32),
            np.log(shares).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.e, self.r, self.c, self.b)])

    @classmethod
    def unflat(cls, flat: np.ndarray) -> Model:
        shapes = [(SYMBOLS + 1, DIMENSIONS), (SYMBOLS, DIMENSIONS), (CONTEXT, DIMENSIONS), (SYMBOLS,)]
        ends = np.cumsum([math.prod(s) for s in shapes])
        return cls(*(part.reshape(s).astype(np.float32) for part, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)))

    def normalise(self) -> Model:
        """Log normalisers of every context: rows of the symbol two before, columns of the one before."""
        norms = np.empty((SYMBOLS + 1, SYMBOLS + 1), np.float32)
        near = self.e * self.c[0]
        for far in range(SYMBOLS + 1):
            scores = (near + self.e[far] * self.c[1]) @ self.r.T + self.b
            top = scores.max(1, keepdims=True)
            norms[far] = top[:, 0] + np.log(np.exp(scores - top).sum(1))
        self.norms = norms
        return self

    def log_probabilities(self, ids: np.ndarray, before=(BEGIN, BEGIN)) -> np.ndarray:
        """Natural log probability of each symbol of a text (its end included) after those before it; ``before`` are the two before the first."""
        return self.of_symbols(ids, *contexts(ids, before))

    def of_symbols(self, ids: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """The same with the symbols one and two before each given."""
        hidden = self.e[near] * self.c[0] + self.e[far] * self.c[1]
        return np.einsum("ij,ij->i", hidden, self.r[ids]).astype(np.float64) + self.b[ids] - self.norms[far, near]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def contexts(ids: np.ndarray, before=(BEGIN, BEGIN)) -> tuple[np.ndarray, np.ndarray]:
    padded = np.concatenate([before, ids[:-1]])
    return padded[1:], padded[:-1].copy()


class Trainer:
    """Noise-contrastive estimation with adaptive steps. A batch shares its noise, so all but gathering is products."""

    def __init__(self, model: Model, shares: np.ndarray, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.noise, self.log_noise = np.cumsum(shares / shares.sum()), np.log(NOISE * shares / shares.sum()).astype(np.float32)
        self.sums = [np.full_like(x, 1e-3) for x in (model.e, model.r, model.c, model.b)]

    @staticmethod
    def _gather(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
        """Sums of the rows that go to each place."""
        order = np.argsort(at.astype(np.int16), kind="stable")
        sorted_at = at[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_at[1:] != sorted_at[:-1]]))
        out = np.zeros((size, rows.shape[1]), np.float32)
        out[sorted_at[first]] = np.add.reduceat(rows[order], first)
        return out

    def step(self, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> None:
        m, n = self.m, len(target)
        noise = np.minimum(np.searchsorted(self.noise, self.rng.random(NOISE)), SYMBOLS - 1)
        e_near, e_far, r_target, r_noise = m.e[near], m.e[far], m.r[target], m.r[noise]
        hidden = e_near * m.c[0] + e_far * m.c[1]
        right = _sigmoid(self.log_noise[target] - m.b[target] - np.einsum("ij,ij->i", hidden, r_target))
        wrong = -_sigmoid(hidden @ r_noise.T + (m.b[noise] - self.log_noise[noise]))
        g_hidden = right[:, None] * r_target + wrong @ r_noise
        g_r = self._gather(target, right[:, None] * hidden, SYMBOLS)
        np.add.at(g_r, noise, wrong.T @ hidden)
        g_b = np.bincount(target, right, SYMBOLS) + np.bincount(noise, wrong.sum(0), SYMBOLS)
        g_e = self._gather(near, g_hidden * m.c[0], SYMBOLS + 1) + self._gather(far, g_hidden * m.c[1], SYMBOLS + 1)
        g_c = np.stack([(g_hidden * e_near).sum(0), (g_hidden * e_far).sum(0)])
        for value, total, gradient in zip((m.e, m.r, m.c, m.b), self.sums, (g_e, g_r, g_c, g_b.astype(np.float32)), strict=True):
            gradient /= n
            total += gradient * gradient
            value += RATE * gradient / np.sqrt(total)

    def run(self, texts: list[np.ndarray]) -> None:
        if not texts:
            return
        sides = [contexts(t) for t in texts]
        near, far, target = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides]), np.concatenate(texts)
        order = self.rng.permutation(len(target))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            self.step(near[at], far[at], target[at])


class Inside:
    """Words inside classes: vectors ``a`` of the symbol before, ``r`` of words; the rows of a class lie together."""

    def __init__(self, a: np.ndarray, r: np.ndarray, starts: np.ndarray, biases: np.ndarray):
        self.a, self.r, self.starts, self.biases = a, r, starts, biases
        self.norms: np.ndarray | None = None

    @classmethod
    def start(cls, starts: np.ndarray, biases: np.ndarray) -> Inside:
        """All words at their shares: vectors of words are zero."""
        a = np.random.default_rng(8).normal(0, 0.1, (SYMBOLS + 1, DIMENSIONS)).astype(np.float32)
        return cls(a, np.zeros((len(biases), DIMENSIONS), np.float32), starts, biases)

    def normalise(self) -> Inside:
        """Log normalisers: rows of the symbol before, columns of the class."""
        self.norms = np.empty((SYMBOLS + 1, CLASSES), np.float32)
        for k in range(CLASSES):
            at = slice(self.starts[k], self.starts[k + 1])
            scores = self.a @ self.r[at].T + self.biases[at]
            top = scores.max(1, keepdims=True)
            self.norms[:, k] = top[:, 0] + np.log(np.exp(scores - top).sum(1))
        return self

    def log_probabilities(self, near: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log probability of each row in its class after the symbol before."""
        return np.einsum("ij,ij->i", self.a[near], self.r[rows]).astype(np.float64) + self.biases[rows] - self.norms[near, classes]


class InsideTrainer:
    """Noise-contrastive estimation class by class; a class's words in a buffer share noise drawn by the class's counts."""

    def __init__(self, model: Inside, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.noise = np.cumsum(np.exp(model.biases.astype(np.float64)))
        self.seen = np.zeros(len(model.r))
        self.sums = [np.ones_like(model.a), np.ones_like(model.r)]

    def step(self, k: int, near: np.ndarray, rows: np.ndarray) -> None:
        """``rows``, sorted, are all of class ``k``."""
        m, first, end = self.m, self.m.starts[k], self.m.starts[k + 1]
        before = self.noise[first - 1] if first else 0.0
        noise = np.minimum(np.searchsorted(self.noise, before + self.rng.random(INSIDE_NOISE) * (self.noise[end - 1] - before)), end - 1)
        hidden, r_target, r_noise = m.a[near], m.r[rows], m.r[noise]
        # Noise has the shares that are the biases, so they cancel.
        right = _sigmoid(_LOG_INSIDE - np.einsum("ij,ij->i", hidden, r_target))
        wrong = -_sigmoid(hidden @ r_noise.T - _LOG_INSIDE)
        g_r = np.zeros((end - first, DIMENSIONS), np.float32)
        runs = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        g_r[rows[runs] - first] = np.add.reduceat(right[:, None] * hidden, runs)
        np.add.at(g_r, noise - first, (wrong.T @ hidden).astype(np.float32))
        g_a = Trainer._gather(near, right[:, None] * r_target + wrong @ r_noise, SYMBOLS + 1)
        self.seen[rows[runs]] += np.append(runs[1:], len(rows)) - runs
        for value, total, gradient in ((m.a, self.sums[0], g_a), (m.r[first:end], self.sums[1][first:end], g_r)):
            total += gradient * gradient
            value += RATE * gradient / np.sqrt(total)

    def run(self, texts: list[np.ndarray], rows: list[np.ndarray]) -> None:
        if not texts:
            return
        near, row = np.concatenate([contexts(t)[0] for t in texts]), np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        bounds = np.searchsorted(row[order], self.m.starts)
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            at = order[bounds[k] : bounds[k + 1]]
            self.step(k, near[at], row[at])


class Vocabulary:
    """The frequent words, in order, with counts; the first have symbols of their own."""

    def __init__(self, frequent: list[bytes], counts: np.ndarray, class_units: np.ndarray):
        self.at = {w: i for i, w in enumerate(frequent)}
        self.symbols = np.array([i if i < WORD_SYMBOLS else word_class(w) for i, w in enumerate(frequent)] + [-1], np.int64)
        self.log_counts = np.concatenate([np.log10(counts + 1.0), [0.0]])
        # Rows inside classes: a class's words by their place, then all its other words together.
        classes = self.symbols[WORD_SYMBOLS:-1] - WORD_SYMBOLS
        sizes = np.bincount(classes, minlength=CLASSES) + 1
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.other = self.starts[1:] - 1
        order = np.argsort(classes, kind="stable")
        self.rows = np.full(len(self.symbols), -1, np.int64)
        self.rows[WORD_SYMBOLS + order] = np.arange(len(order)) + classes[order]
        units = np.empty(self.starts[-1])
        units[self.rows[WORD_SYMBOLS:-1]] = counts[WORD_SYMBOLS:] + 1.0
        rest = class_units - np.bincount(classes, counts[WORD_SYMBOLS:] + 1.0, CLASSES)
        units[self.other] = rest
        self.biases = np.log(units / np.repeat(class_units, sizes)).astype(np.float32)
        #: log10 of what the counts of a class's other words are divided by.
        self.log_rest = np.log10(rest)

    def encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place among the frequent words or -1, symbol) of each word."""
        get = self.at.get
        places = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
        symbols = self.symbols[places]
        for i in np.flatnonzero(places < 0).tolist():
            symbols[i] = word_class(found[i])
        return places, symbols

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, row inside its class or -1) of each word, from its place or -1 - class."""
        places = np.where(codes < 0, -1, codes)
        symbols = np.where(codes < 0, WORD_SYMBOLS - 1 - codes.astype(np.int64), self.symbols[places])
        return symbols, self.inside(places, symbols)

    def inside(self, places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The row of each word inside its class; -1 for words that have symbols of their own."""
        return np.where(places < 0, self.other[np.maximum(symbols - WORD_SYMBOLS, 0)], self.rows[places])


_SHARED: dict[str, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """A worker serves many tasks; it keeps the vocabulary of the last broadcast."""
    if shared.id not in _SHARED:
        _SHARED.clear()
        _SHARED[shared.id] = Vocabulary(*shared.value["vocabulary"])
    return _SHARED[shared.id]


class _Shared:
    """A broadcast with a name of its own, by which workers know what they have."""

    def __init__(self, spark, value):
        self.broadcast, self.id = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def _texts(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(numbers, pieces) of texts in order, of about ``HELD_BYTES`` at a time; longer texts are cut at spaces."""
    numbers, pieces, held = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            cut = _SPACE.search(text, at + HELD_BYTES) if len(text) - at > HELD_BYTES else None
            end = cut.start() if cut else len(text)
            numbers.append(number)
            pieces.append(text[at:end].lower())
            held += end - at
            if held >= HELD_BYTES:
                yield numbers, pieces
                numbers, pieces, held = [], [], 0
            if end == len(text):
                break
            at = end
    if pieces:
        yield numbers, pieces


def cut_words(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """For texts of about ``HELD_BYTES`` at a time: the distinct words, each word in order by number, and the number of its text."""
    for numbers, pieces in _pieces(texts):
        lists = pc.ascii_split_whitespace(pa.array(pieces, pa.large_binary()).view(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        names = coded.dictionary.view(pa.large_binary()).to_pylist()
        word, of = coded.indices.to_numpy(), np.repeat(np.array(numbers, np.int64), np.diff(lists.offsets.to_numpy()))
        if b"" in names:  # space at the ends of a text
            some = word != names.index(b"")
            word, of = word[some], of[some]
        yield names, word, of


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, HELD_TEXTS):
            yield whole.slice(start, HELD_TEXTS)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts: summed in each task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            for names, word, _ in cut_words(batch.column(0).to_pylist()):
                counts = np.bincount(word, minlength=len(names))
                had = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in had.tolist()], pa.binary()), pa.array(counts[had])], names=["word", "n"])

    return _texts(docs).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def encode(source: DataFrame, shared: _Shared) -> DataFrame:
    """``source`` with, for its text: a row number, each word's place among the frequent ones or -1 - class, and the other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, row = _vocabulary(shared), TaskContext.get().partitionId() << 36
        get = vocabulary.at.get
        for batch in _slices(batches):
            codes, rare = [[] for _ in range(batch.num_rows)], [Counter() for _ in range(batch.num_rows)]
            for names, word, of in cut_words(batch.column(batch.num_columns - 1).to_pylist()):
                places = np.array([get(name, -1) for name in names], np.int32) if names else np.zeros(0, np.int32)
                for i in np.flatnonzero(places < 0).tolist():
                    places[i] = -1 - (word_class(names[i]) - WORD_SYMBOLS)
                code = places[word]
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                for text, part in zip(of[starts].tolist(), np.split(code, starts[1:]) if len(starts) else [], strict=True):
                    codes[text].append(part)
                lone = np.flatnonzero(code < 0)
                for text, number in zip(of[lone].tolist(), word[lone].tolist(), strict=True):
                    rare[text][names[number]] += 1
            ends = np.cumsum([0, *(sum(map(len, parts)) for parts in codes)]).astype(np.int32)
            flat = [part for parts in codes for part in parts]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
            lone = [pa.array([list(x) for x in rare], pa.list_(pa.binary())), pa.array([list(x.values()) for x in rare], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.arange(row, row + batch.num_rows)), lists, *lone], names=[*batch.schema.names[:-1], *_CODED])
            row += batch.num_rows

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("text").schema]
    return source.mapInArrow(run, ", ".join([*fields, "__row bigint", "__codes array<int>", "__words array<binary>", "__times array<int>"]))


_CODED = ["__row", "__codes", "__words", "__times"]


def train(coded: DataFrame, n_learners: int, shared: _Shared, shares: np.ndarray) -> tuple[Model, Inside]:
    """The average over learners of what each learns from its texts: the model, and each word the learner has.

    ``coded`` are rows (order, __codes); ``order`` is a hash that tells the learner and a text's turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, learner, state = _vocabulary(shared), None, None
        for batch in batches:
            for number, _, codes in zip(*(batch.column(i) for i in range(3)), strict=True):
                if number.as_py() != learner:
                    if state is not None:
                        yield state.learned(columns)
                    learner = number.as_py()
                    state = _Learner(vocabulary, shares, learner)
                state.read(codes.values.to_numpy(zero_copy_only=False))
        if state is not None:
            yield state.learned(columns)

    columns = [f"v{i}" for i in range(DIMENSIONS)]
    dealt = coded.select(F.pmod("order", F.lit(n_learners)).alias("learner"), "order", "__codes")
    dealt = dealt.repartition(n_learners, "learner").sortWithinPartitions("learner", "order", "__codes")
    found = dealt.mapInArrow(run, "at bigint, w double, " + ", ".join(f"{c} float" for c in columns))
    found = found.groupBy("at").agg(*[(F.sum(F.col(c) * F.col("w")) / F.sum("w")).cast("float").alias(c) for c in columns]).toArrow()
    vocabulary = _vocabulary(shared)
    model, inside = Model.start(shares), Inside.start(vocabulary.starts, vocabulary.biases)
    if found.num_rows:
        length, size = len(model.flat()), len(model.flat()) + inside.a.size
        values = np.zeros((-(-size // DIMENSIONS) + len(inside.r), DIMENSIONS), np.float32)
        values[found["at"].to_numpy()] = np.stack([found[c].to_numpy() for c in columns], 1)
        flat = values[: len(values) - len(inside.r)].ravel()
        model, inside.a, inside.r = Model.unflat(flat[:length]), flat[length:size].reshape(inside.a.shape), values[len(values) - len(inside.r) :]
    return model.normalise(), inside.normalise()


class _Learner:
    """Both models on their way through one learner's texts."""

    def __init__(self, vocabulary: Vocabulary, shares: np.ndarray, seed: int):
        self.vocabulary = vocabulary
        self.trainer = Trainer(Model.start(shares), shares, seed)
        self.inner = InsideTrainer(Inside.start(vocabulary.starts, vocabulary.biases), seed)
        self.held, self.rows, self.size, self.total = [], [], 0, 0

    def read(self, codes: np.ndarray) -> None:
        symbols, rows = self.vocabulary.decode(codes)
        self.held.append(np.append(symbols, END))
        self.rows.append(np.append(rows, -1))
        self.size += len(codes) + 1
        if self.size >= BUFFER:
            self._learn()

    def _learn(self) -> None:
        self.trainer.run(self.held)
        self.inner.run(self.held, self.rows)
        self.held, self.rows, self.size, self.total = [], [], 0, self.total + self.size

    def learned(self, columns: list[str]) -> pa.RecordBatch:
        """The model in rows of as many numbers as a vector has, then the vectors of words, and what each row weighs."""
        self._learn()
        flat = np.concatenate([self.trainer.m.flat(), self.inner.m.a.ravel()])
        flat = np.append(flat, np.zeros(-len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)
        had = np.flatnonzero(self.inner.seen)
        at, weight = np.concatenate([np.arange(len(flat)), len(flat) + had]), np.concatenate([np.full(len(flat), float(self.total)), self.inner.seen[had]])
        values = np.concatenate([flat, self.inner.m.r[had]]).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(weight), *(pa.array(v) for v in values.T.copy())], names=["at", "w", *columns])


def _scored(lbl: Model, inner: Inside, symbols: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log probability of each of some texts, end to end in ``symbols``, of which ``sizes`` are theirs."""
    if len(sizes) == 1 and sizes[0] > SCORED:
        ids, rows, total = np.append(symbols, END), np.append(rows, -1), 0.0
        for first in range(0, len(ids), SCORED):
            # Each stretch with the two symbols before it.
            before = np.concatenate([[BEGIN, BEGIN], ids[max(first - 2, 0) : first]])[-2:]
            part = ids[first : first + SCORED]
            total += _of_each(lbl, inner, part, rows[first : first + SCORED], *contexts(part, before)).sum()
        return np.array([total])
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    ids, inside = np.full(ends[-1] + 1, END, np.int64), np.full(ends[-1] + 1, -1, np.int64)
    words = np.ones(len(ids), bool)
    words[ends] = False
    ids[words], inside[words] = symbols, rows
    near, far = contexts(ids)
    near[starts] = far[starts] = BEGIN
    far[(starts + 1)[sizes > 0]] = BEGIN
    return np.add.reduceat(_of_each(lbl, inner, ids, inside, near, far), starts)


def _of_each(lbl: Model, inner: Inside, ids: np.ndarray, rows: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    out = lbl.of_symbols(ids, near, far)
    outside = np.flatnonzero((ids >= WORD_SYMBOLS) & (ids != END))
    out[outside] += inner.log_probabilities(near[outside], rows[outside], ids[outside] - WORD_SYMBOLS)
    return out


def score(docs: DataFrame, training: DataFrame | Column, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default) with n_tokens, n_known, train_tokens, base_score and score for each row.

    Tokens are the words of the whole text (A-Z lower-cased) and one end. base_score adds log10((c + 1) / (N + V + 1))
    over tokens, with c a token's count in ``training`` (a table of texts, or a test of the rows of ``docs`` to learn from,
    which are then cut into words once for both), N and V its tokens and distinct tokens; score adds the
    model's log10 probabilities. A null or empty text is an end alone. Repeated rows are scored alike; other columns
    don't matter. Without training texts nothing is known and every score still normalises. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    keep = ["doc_id"] if keep is None else keep
    texts = docs.where(training) if isinstance(training, Column) else training
    counts = stored(count_words(texts), "word-counts")
    n_texts = texts.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = total + n_texts, distinct + bool(n_texts)
    base_unit = math.log10(n + v + 1)

    # Counts in steps of a sixteenth of a doubling; as many of the upper steps as hold at most FREQUENT words.
    step = F.floor(F.log2("n") * 16).cast("long")
    steps = sorted(((r.step, r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    held = np.cumsum([c for _, c in steps]) <= FREQUENT
    least = min((s for (s, _), h in zip(steps, held, strict=True) if h), default=1 << 20)
    top = counts.where(step >= least).toArrow()
    order = sorted(zip(top["n"].to_pylist(), top["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    frequent, frequent_counts = [w for _, w in order], np.array([c for c, _ in order], np.float64)
    ending = F.expr("crc32(substring(word, greatest(octet_length(word) - 2, 1), 3))") % CLASSES
    class_counts, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in counts.groupBy(ending.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        class_counts[row.k], class_words[row.k] = row.n, row.v
    for word, c in zip(frequent[:WORD_SYMBOLS], frequent_counts, strict=False):
        class_counts[word_class(word) - WORD_SYMBOLS] -= c
        class_words[word_class(word) - WORD_SYMBOLS] -= 1
    own = np.zeros(WORD_SYMBOLS)
    own[: min(len(frequent), WORD_SYMBOLS)] = frequent_counts[:WORD_SYMBOLS]
    shares = np.concatenate([own, class_counts, [n_texts]]) + 1.0
    shares /= shares.sum()

    vocabulary = (frequent, frequent_counts, class_counts + class_words + 1.0)
    shared = _Shared(spark, {"vocabulary": vocabulary})
    order = F.xxhash64(*[F.col(f"`{c}`") for c in keep], "text")
    learns = training if isinstance(training, Column) else F.lit(False)
    source = _texts(docs, *[F.col(f"`{c}`") for c in keep], learns.alias("__learns"))
    source = source.select(*[F.col(f"`{c}`") for c in keep], "__learns", order.alias("order"), "text")
    coded = stored(encode(source, shared), "lm-coded")
    if isinstance(training, Column):
        learning = coded.where("__learns")
    else:
        learning = stored(encode(_texts(training).select(F.xxhash64("text").alias("order"), "text"), shared), "lm-coded")
    model, inside = train(learning.select("order", "__codes"), max(1, round(n / LEARNER_TOKENS)), shared, shares)
    fitted = spark.sparkContext.broadcast((model.flat(), model.norms, inside.a, inside.r, inside.norms))
    end_log = math.log10(n_texts + 1)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in coded.select(*[F.col(f"`{c}`") for c in keep]).schema]
    names = [*keep, "__row", "n_tokens", "__known", "__base", "__score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        lbl = Model.unflat(fitted.value[0])
        inner = Inside(*fitted.value[2:4], vocabulary.starts, vocabulary.biases)
        lbl.norms, inner.norms = fitted.value[1], fitted.value[4]
        for batch in batches:
            lists = batch.column(len(keep) + 1)
            ends, codes = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(ends)
            model_scores, base_logs, known = (np.zeros(len(sizes)) for _ in range(3))
            first = 0
            while first < len(sizes):
                # Texts go together up to SCORED symbols; a longer one goes alone, in stretches.
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + SCORED, "right")) - 1)
                at, own = slice(first, last), codes[ends[first] : ends[last]]
                symbols, rows = vocabulary.decode(own)
                model_scores[at] = _scored(lbl, inner, symbols, rows, sizes[at]) / math.log(10)
                text, unseen = np.repeat(np.arange(last - first), sizes[at]), own < 0
                model_scores[at] -= np.bincount(text[unseen], vocabulary.log_rest[-1 - own[unseen]], last - first)
                base_logs[at] = np.bincount(text, vocabulary.log_counts[np.where(unseen, -1, own)], last - first)
                known[at] = np.bincount(text[~unseen], minlength=last - first)
                first = last
            columns = (sizes + 1, known.astype(np.int64) + (n_texts > 0), base_logs + end_log - (sizes + 1) * base_unit, model_scores)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)

    schema = ", ".join([*fields, "__row bigint", "n_tokens bigint", "__known bigint", "__base double", "__score double"])
    scored = coded.select(*[F.col(f"`{c}`") for c in keep], "__row", "__codes").mapInArrow(run, schema)
    rows = coded.select("__row", "__words", "__times")
    pairs = rows.select("__row", F.explode(F.arrays_zip(F.col("__words").alias("word"), F.col("__times").alias("times"))).alias("x")).select("__row", "x.word", "x.times")
    extra = (
        pairs.join(counts.where(step < least), "word")
        .groupBy("__row")
        .agg(F.sum("times").alias("__more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("__logs"))
    )
    out = scored.join(extra, "__row", "left")
    more, logs = F.coalesce("__more", F.lit(0)), F.coalesce("__logs", F.lit(0.0))
    return out.select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens", (F.col("__known") + more).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("__base") + logs).alias("base_score"), (F.col("__score") + logs).alias("score"),
    )
