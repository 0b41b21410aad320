"""Token counts by byte-pair merging, without making the tokens.

A text is cut at special strings (one token each) and then by the pre-tokenizer's pattern. Of each piece's bytes,
held as a linked list, a heap gives the adjacent pair of lowest rank again and again; the number of tokens is the
number of bytes less the number of merges. Pieces recur, so counts are kept in a dictionary of bounded size; a piece
of any length takes O(n log n).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The pre-tokenizer's pattern of byte-level BPE. Letters and numbers come first here, which changes no cut,
# as contractions start with neither.
PIECES = r""" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Below this code point the same pattern is spelled out for the standard library's engine, which is faster.
LATIN_END = 0x250

CACHE_SIZE = 1_000_000
CACHED_LENGTH = 64
_LOADED: dict[str, PairMerger] = {}


def byte_symbols() -> list[str]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def latin_pieces() -> re.Pattern:
    """``PIECES`` for texts whose code points are all below ``LATIN_END``."""

    def members(kind: str) -> str:
        return "".join(f"\\u{i:04x}" for i in range(LATIN_END) if regex.match(kind, chr(i)))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    pattern = PIECES.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for short, full in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\s", f"[{spaces}]"), (r"\S", f"[^{spaces}]")):
        pattern = pattern.replace(short, full)
    return re.compile(pattern)


class PairMerger:
    """Merges as numbers: ``ranks[left][right]`` is a pair's rank; left, right and merged symbol stand in lists by rank."""

    def __init__(self, merges: list[tuple[str, str]], specials: list[str]):
        numbers = {s: i for i, s in enumerate(byte_symbols())}
        for a, b in merges:
            for s in (a, b, a + b):
                numbers.setdefault(s, len(numbers))
        self.ranks: list[dict[int, int]] = [{} for _ in numbers]
        self.left, self.right, self.merged = ([numbers[x] for x in column] for column in ([m[0] for m in merges], [m[1] for m in merges], [a + b for a, b in merges]))
        for rank, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            self.ranks[a].setdefault(b, rank)
        self.pieces = regex.compile(PIECES)
        self.latin = latin_pieces()
        self.beyond = re.compile(f"[^\\x00-\\u{LATIN_END - 1:04x}]")
        # Longest first, as the leftmost longest special string counts.
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.special_strings = specials
        self.cache: dict[str, int] = {}

    @classmethod
    def load(cls, content: str) -> PairMerger:
        """From the text of a tokenizer file of the tokenizers library. Raises on settings this merger doesn't follow."""
        spec = json.loads(content)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "ignore_merges": False}
        odd = {k: model.get(k) for k, v in plain.items() if model.get(k) not in (v, None, False, "")}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer") or odd:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {odd or before}")
        added = spec.get("added_tokens", [])
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
            raise ValueError("added tokens that strip or want whole words are not supported")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        missing = {a + b for a, b in merges} - model["vocab"].keys()
        if missing:
            raise ValueError(f"{len(missing)} merges lead to no token")
        return cls(merges, [t["content"] for t in added])

    def merged_length(self, piece: str) -> int:
        """Initial symbols minus merges."""
        data = piece.encode("utf-8", "surrogatepass")
        n = len(data)
        symbols = list(data)
        ranks = self.ranks
        # A heap entry is rank * n + position.
        heap = [
            rank * n + i
            for i, (a, b) in enumerate(zip(data, data[1:]))  # noqa: B905
            if (rank := ranks[a].get(b)) is not None
        ]
        if not heap:
            return n
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            rank, i = divmod(pop(heap), n)
            if symbols[i] != self.left[rank] or (j := after[i]) == n or symbols[j] != self.right[rank]:
                continue  # one of the two has been merged since
            made = symbols[i] = self.merged[rank]
            symbols[j] = -1
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks[made].get(symbols[k])) is not None:
                    push(heap, rank * n + i)
            if (k := before[i]) >= 0 and (rank := ranks[symbols[k]].get(made)) is not None:
                push(heap, rank * n + k)
        return n - merges

    def _plain(self, text: str) -> int:
        cache, total = self.cache, 0
        for piece in (self.pieces if self.beyond.search(text) else self.latin).findall(text):
            n = cache.get(piece)
            if n is None:
                n = self.merged_length(piece)
                if len(piece) <= CACHED_LENGTH:
                    if len(cache) >= CACHE_SIZE:
                        cache.clear()
                    cache[piece] = n
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.specials is None or not any(s in text for s in self.special_strings):
            return self._plain(text)
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``df`` without its text, with n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    ``tokenizer_path`` is a byte-level BPE file of the tokenizers library; the driver reads it once and broadcasts its
    merges (a fixed vocabulary). Counts equal that library's without added tokens. A null or empty text has 0 of all.
    Rows, with their ties and repeats, are kept one to one; existing columns of the three names are replaced. An
    empty table gives an empty result.
    """
    spark: SparkSession = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    PairMerger.load(content)  # fail here rather than in a task
    shared = spark.sparkContext.broadcast(content)
    digest = hashlib.sha256(content.encode()).hexdigest()

    def counted(batches):
        # A Python worker serves many tasks; it keeps the merger and what it has counted.
        if digest not in _LOADED:
            _LOADED.clear()
            _LOADED[digest] = PairMerger.load(shared.value)
        merger = _LOADED[digest]
        for texts in batches:
            yield texts.map(merger.count).astype("int64")

    counted.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(counted, "long")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in {text, "n_bytes", "n_tokens", "over_limit"}]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return (
        df.select(*kept, F.octet_length(body).cast("long").alias("n_bytes"), udf(body).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )

