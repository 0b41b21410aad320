"""Quality by weak supervision: rules vote good, bad or abstain; expectation-maximisation weighs them.

The latent quality of a document is good or bad; given it, the rules that don't abstain vote independently, each with
its own chance to be right on either. Documents with equal votes are alike, so the corpus is counted by vote pattern (at most
``3 ** len(RULES)`` of them, whatever its size), the model is fitted on those counts on the driver, and each
document's posterior is the sum of its votes' log odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.llm.common import stored, window_hashes, word_hashes, words

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRAS = ["n_lines", "n_upper", "n_lower", "n_digits", "n_exclaims", "n_bars", "n_ended_lines", "n_distinct", "n_wide", "n_stutters"]

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_SPACES = b"\t\n\v\f\r "
_ENDS = (b".", b"!", b"?", b'"', b":", b";", "…".encode(), "。".encode(), "”".encode(), "»".encode())


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a run of ``window`` words that the text has twice or more."""
    runs = window_hashes(hashes, window)
    if len(runs) < 2:
        return 0
    order = np.sort(runs)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(runs, twice)
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[: len(runs)] += starts
    edges[window : window + len(runs)] -= starts
    return int((np.cumsum(edges) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """``MEASURES`` and ``EXTRAS`` of a text; all 0 for none."""
    if not text:
        return (0,) * (len(MEASURES) + len(EXTRAS))
    found = words(text, lower=False)
    hashes = word_hashes(found)
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]

    def of(members: bytes) -> int:
        return len(text) - len(text.translate(None, members))

    raw = np.frombuffer(text, np.uint8)
    return (
        len(found),
        int(((raw & 0xC0) != 0x80).sum()) - of(_SPACES),
        of(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        len(lines),
        of(_UPPER),
        of(_LOWER),
        of(_DIGITS),
        of(b"!"),
        of(b"|"),
        sum(x.rstrip(_SPACES).endswith(_ENDS) for x in lines),
        len(np.unique(hashes)),
        int((raw >= 0xC0).sum()),
        int((hashes[1:] == hashes[:-1]).sum()),
    )


def measured(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` (all by default) and the measures as longs. One pass, no shuffle, whole texts."""
    names = MEASURES + EXTRAS
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    body = "__text"
    while body in keep:
        body += "_"
    kept = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").cast("binary").alias(body))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop(body).schema), *(f"{n} bigint" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(body)
            values = np.array([measure(x.as_py()) for x in batch.column(at)], np.int64).reshape(batch.num_rows, len(names))
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, *(pa.array(values[:, i]) for i in range(len(names)))], names=[*keep, *names])

    return kept.mapInArrow(run, schema)


def _ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 2).otherwise(1)


def rules() -> dict[str, Column]:
    """Each rule's vote on measured rows: 0 bad, 1 abstains, 2 good."""
    symbols, exclaims, bars = (_ratio(c, "n_words") for c in ("n_symbols", "n_exclaims", "n_bars"))
    ascii_letters = F.col("n_upper") + F.col("n_lower")
    upper, ended = F.col("n_upper") / F.greatest(ascii_letters, F.lit(1)), _ratio("n_ended_lines", "n_lines")
    letters = (ascii_letters + F.col("n_wide")) / F.greatest(F.col("word_chars"), F.lit(1))
    length, repeats = _ratio("word_chars", "n_words"), _ratio("n_repeat_words", "n_words")
    twin_lines, digits, fresh = _ratio("n_dup_lines", "n_lines"), _ratio("n_digits", "word_chars"), _ratio("n_distinct", "n_words")
    stutters = _ratio("n_stutters", "n_words")
    plain, enough = symbols + exclaims + bars, F.col("n_words") >= 20
    return {
        "symbols": _vote(symbols < 0.05, symbols > 0.1),
        "symbol_share": _vote(_ratio("n_symbols", "word_chars") < 0.01, _ratio("n_symbols", "word_chars") > 0.03),
        "letters": _vote(letters > 0.9, letters < 0.75),
        "bars": _vote(bars < 0.02, bars > 0.1),
        "marks": _vote(plain < 0.05, plain > 0.3),
        "exclaims": _vote(exclaims < 0.05, exclaims > 0.2),
        "capitals": _vote(upper < 0.2, upper > 0.5),
        "line_starts": _vote((upper < 0.3) & (ended >= 0.3), (upper > 0.5) & enough),
        "twin_lines": _vote((twin_lines < 0.1) & enough, twin_lines > 0.3),
        "repeats": _vote((repeats < 0.15) & enough, repeats > 0.25),
        "variety": _vote(fresh.between(0.2, 1) & enough, (fresh < 0.1) & enough),
        "stutters": _vote((stutters < 0.1) & enough, (stutters > 0.3) & enough),
        "word_length": _vote(length.between(3, 10), (length < 2) | (length > 15)),
        "line_ends": _vote(ended >= 0.5, (ended < 0.1) & enough),
        "digits": _vote(digits < 0.05, digits > 0.25),
    }


class VoteModel:
    """Fitted log odds in favour of good: ``prior``, and for each rule (of a bad vote, of a good vote)."""

    def __init__(self, prior: float, weights: dict[str, tuple[float, float]], accuracy: dict[str, float]):
        self.prior, self.weights, self.accuracy = prior, weights, accuracy

    def posterior(self) -> Column:
        odds = F.lit(self.prior)
        for name, vote in rules().items():
            bad, good = self.weights[name]
            odds = odds + F.when(vote == 0, bad).when(vote == 2, good).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


# How often a rule is expected to call a good and a bad document bad, and what that expectation counts for, as a share
# of the corpus. Without it the two classes could settle on any split that groups of related rules happen to make.
EXPECTED_BAD_CALLS = (0.3, 0.005)
EXPECTATION_WEIGHT = 0.02


def fit(patterns: np.ndarray, counts: np.ndarray, names: list[str], rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over vote patterns (votes 0, 1, 2 by row) and how many documents have each.

    A rule that abstains says nothing of the document. It starts from the number of bad votes, which settles which
    class is the bad one. Without any document the posterior is one half.
    """
    if not len(counts):
        return VoteModel(0.0, {n: (0.0, 0.0) for n in names}, {n: 0.5 for n in names})
    bad, good = (patterns == 0).astype(float), (patterns == 2).astype(float)
    strength = EXPECTATION_WEIGHT * counts.sum()
    q = np.array([0.95, 0.5, 0.1])[np.minimum(bad.sum(1), 2).astype(int)]
    for _ in range(rounds):
        calls, sizes = [], []
        for share, expected in zip((1 - q, q), EXPECTED_BAD_CALLS, strict=True):
            weight = counts * share
            calls.append((weight @ bad + strength * expected) / (weight @ (bad + good) + strength))
            sizes.append(weight.sum() + strength)
        for_bad, for_good = np.log(calls[1] / calls[0]), np.log((1 - calls[1]) / (1 - calls[0]))
        prior = float(np.log(sizes[1] / sizes[0]))
        new = 1 / (1 + np.exp(-np.clip(prior + bad @ for_bad + good @ for_good, -500, 500)))
        done = np.abs(new - q).max() < 1e-9
        q = new
        if done:
            break
    right, cast = (counts * q) @ good + (counts * (1 - q)) @ bad, counts @ (bad + good)
    accuracy = {n: float(r / c) if c else 0.5 for n, r, c in zip(names, right, cast, strict=True)}
    return VoteModel(prior, {n: (float(b), float(g)) for n, b, g in zip(names, for_bad, for_good, strict=True)}, accuracy)


def learn(rows: DataFrame) -> VoteModel:
    """The vote model of measured rows: counts by pattern over all of them, at most ``3 ** rules`` to the driver."""
    names = list(rules())
    votes = rows.select(*(v.cast("int").alias(n) for n, v in rules().items()))
    found = votes.groupBy(*names).count().orderBy(*names).collect()
    return fit(np.array([[r[n] for n in names] for r in found], int).reshape(len(found), len(names)), np.array([r["count"] for r in found], float), names)


def failed() -> Column:
    """The base rule: under 20 words, or more than 30% of the words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``df``: its columns but the text, the measures, base_failed, posterior and kept.

    ``kept`` is false if the base rule fails, else whether the posterior of good quality reaches ``threshold``. A null
    or empty text has no words, so the base rule fails. Ties and repeated rows are judged alike; columns of ``df``
    with a measure's name are replaced; an empty table gives an empty result.
    """
    ours = {*MEASURES, *EXTRAS, "base_failed", "posterior", "kept"}
    rows = stored(measured(df, text, [c for c in df.columns if c != text and c not in ours]), "quality")
    model = learn(rows)
    return (
        rows.withColumn("base_failed", failed())
        .withColumn("posterior", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def keep_good(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that :func:`judge` keeps, with their columns.

    The measures are taken twice, once to learn and once to filter: each row is decided where it is read, and texts
    are not shuffled.
    """
    model = learn(stored(measured(df, text, []), "quality-votes"))
    names = [n for n in df.columns]
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(f"`{text}`").alias("__text"))
    judged = measured(row, "__text", ["__row"])
    kept = judged.where(~failed() & (model.posterior() >= threshold))
    return kept.select(*[F.col("__row")[n].alias(n) for n in names])
