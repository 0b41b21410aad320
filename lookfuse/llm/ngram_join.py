"""Similarity join of documents on word n-grams by Jaccard, exact, by partitioning the universe of n-grams.

Two sets of sizes a <= b whose Jaccard similarity is at least p% differ in at most H = (a + b)(100 - p) / (100 + p)
elements, and b <= 100 a / p. Sizes fall into bands; a pair is looked for under the scheme of the smaller set's band.

A scheme hashes the universe into segments. If the values v of a document's segments add up to more than H, then in
one of them the pair differs in fewer than v elements: v = 1 asks for equal contents, v = 2 for contents that are
equal once at most one element is deleted from one of them, v = 0 for nothing. How many segments of which value a band
has is chosen by cost: signatures to be shuffled (one for v = 1; one and one for each element for v = 2), and
documents that chance brings together, the more the smaller the contents. A document takes the segments in order, so
both sides of a pair use a common prefix of them, and leaves off once its values reach what its own size asks for.
Empty contents say nothing and have value 0; a document that doesn't reach its sum, for too many segments are empty,
goes on under further hash functions, and in the end with each element by itself, which misses nothing.

Documents with equal contents meet in a bucket. Copies are one document from the start. In a bucket documents are
compared with one of them, then, as far as they are not yet connected, with members of other components that could be
linked by a parity sketch, which never rules out a linked pair. Each comparison takes both whole texts and counts the
common n-grams themselves. Large groups of copies thus cost comparisons in proportion to their size, not its square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.llm.common import mixed, shingle_hashes, stored, words
from lookfuse.llm.components import components

#: Hash functions tried for documents whose segments are too often empty.
SEEDS = 6
#: Segments beyond those that a band asks for, as a share, to make up for empty ones.
SPARE = 0.12
#: Cost model: documents that a content of no element would bring together, and how much fewer each element leaves,
#: in units of one signature.
CHANCE, FALL = 64.0, 0.25
#: Bits of a sketch for sets of up to so many elements, and beyond the last.
SKETCH_BITS = ((400, 1 << 10), (1600, 1 << 12), (6400, 1 << 14), (1 << 62, 1 << 16))
#: Strays of a bucket that a task holds at once, about.
STRAYS = 1024
#: Partners of a stray that are compared first.
LIKELIEST = 2
#: Rows of signatures handed to Spark at once.
CHUNK = 1 << 18
#: Texts of one task that are remembered so that copies give no signatures again.
REMEMBERED = 1 << 18


class Bands:
    """Size bands, their schemes, and how much two sets may differ."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError(f"percent must be from 50 to 100, not {percent}")
        self.percent = percent
        self.starts = [1]

    def _grow(self, size: int) -> None:
        while self.starts[-1] <= size:
            self.starts.append(math.floor(self.starts[-1] * 100 * 100 / self.percent**2) + 1)

    def band(self, size: int) -> int:
        self._grow(size)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def first(self, band: int) -> int:
        while len(self.starts) <= band:
            self._grow(self.starts[-1])
        return self.starts[band]

    def apart(self, a: int, b: int) -> int:
        """The most elements by which linked sets of these sizes may differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    @lru_cache(maxsize=100_000)  # noqa: B019
    def need(self, size: int, band: int) -> int:
        """What the values of a set's segments must add up to under a band's scheme."""
        last = self.first(band + 1) - 1
        larger = size * 100 // self.percent if size <= last else 0
        return 1 + max(self.apart(size, larger) if larger else 0, self.apart(size, min(size, last)))

    def schemes(self, size: int) -> list[int]:
        """The bands under which a set may meet a partner: its own, and the one before if a partner can be there."""
        own = self.band(size)
        smallest = -(-size * self.percent // 100)
        return [own] if own == 0 or smallest >= self.first(own) else [own - 1, own]

    @lru_cache(maxsize=1000)  # noqa: B019
    def allocation(self, band: int) -> tuple[int, int]:
        """(segments of value 1, segments of value 2) of a band's scheme: the cheapest that reach the largest need."""
        low, high = self.first(band), self.first(band + 1) - 1
        need = self.need(high, band)
        if need == 1:
            return 1, 0
        goal = need + math.ceil(SPARE * need)

        def cost(exact: int, loose: int) -> float:
            load = (low + high) / 2 / (exact + loose)
            one = 1 + CHANCE * (math.exp(-load * (1 - FALL)) - math.exp(-load))
            two = (1 + load) * (1 + CHANCE * math.exp(-max(load - 1, 0) * (1 - FALL)))
            return exact * one + loose * two

        options = [(max(goal - 2 * loose, 0), loose) for loose in range(goal // 2 + 2)] if goal < 200 else [(goal - 2 * x, x) for x in range(0, goal // 2, goal // 50)]
        return min(options, key=lambda x: cost(*x))


def signatures(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """The signatures of a set of distinct hashes. Equal signatures make a pair a candidate."""
    n, out = len(tokens), []
    for band in bands.schemes(n):
        exact, loose = bands.allocation(band)
        m, need = exact + loose, bands.need(n, band)
        for seed in range(SEEDS):
            salt = mixed(np.array([band * 64 + seed + 1], np.uint64))
            h = mixed(tokens ^ salt)
            segment = ((h >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            segment = segment.astype(np.uint16 if m < 1 << 16 else np.int64)
            order = np.argsort(segment, kind="stable")
            segment, h = segment[order], h[order]
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            here, sums = segment[starts].astype(np.int64), np.add.reduceat(h, starts)
            sizes = np.diff(np.concatenate([starts, [n]]))
            values = np.where(here < exact, 1, np.minimum(sizes, 2))
            reached = np.cumsum(values)
            covered = int(reached[-1]) >= need
            # A prefix ends at a segment; those without an element before it add nothing.
            used = int(np.searchsorted(reached, need)) + 1 if covered else len(here)
            place = mixed(salt + here[:used].astype(np.uint64) + np.uint64(1))
            out.append(mixed(sums[:used] ^ place))
            if loose:
                wide = np.flatnonzero((here[:used] >= exact) & (sizes[:used] > 1))
                if len(wide):
                    at = np.repeat(wide, sizes[wide])
                    own = np.concatenate([h[starts[i] : starts[i] + sizes[i]] for i in wide])
                    out.append(mixed((sums[at] - own) ^ place[at]))
            if covered:
                break
        else:
            out.append(mixed(tokens ^ mixed(np.array([band * 64 + 63], np.uint64))))
    return np.concatenate(out)


def _signed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(sig, key, n): signatures of each text, by its hash ``key``, and one row of negative n that tells its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()

        def rows(sigs: list, keys: list, sizes: list) -> pa.RecordBatch:
            lengths = [len(s) for s in sigs]
            columns = (np.concatenate(sigs).astype(np.int64), np.repeat(np.array(keys, np.int64), lengths), np.repeat(np.array(sizes, np.int32), lengths))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["sig", "key", "n"])

        for batch in batches:
            sigs, keys, sizes, held = [], [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                tokens = shingle_hashes(text.as_py(), width)
                sigs.append(np.array([key], np.int64).astype(np.uint64))
                keys.append(key)
                sizes.append(-len(tokens))
                if len(tokens):
                    sigs.append(signatures(tokens, bands))
                    keys.append(key)
                    sizes.append(len(tokens))
                held += len(sigs[-1])
                if held > CHUNK:
                    yield rows(sigs, keys, sizes)
                    sigs, keys, sizes, held = [], [], [], 0
            if sigs:
                yield rows(sigs, keys, sizes)

    return docs.select("key", F.col("text").cast("binary")).mapInArrow(run, "sig bigint, key bigint, n int")


def _buckets(signed: DataFrame) -> DataFrame:
    """Of rows sorted by (sig, key): size rows once each, and signatures that several texts have.

    Each row of a bucket names its first member as pivot. Buckets are runs of rows, read as a stream: memory is that
    of a batch, however large a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: (sig, key, n), its run's (first key, first n), whether a row of its run came before
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, key, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if held is not None:
                sig, key, n = np.concatenate([[held[0]], sig]), np.concatenate([[held[1]], key]), np.concatenate([[held[2]], n])
            fresh = np.ones(len(sig), bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]) | ((n[1:] < 0) != (n[:-1] < 0))
            sig, key, n = sig[fresh], key[fresh], n[fresh]
            joined = (sig[1:] == sig[:-1]) & (n[1:] > 0) & (n[:-1] > 0)
            first = np.flatnonzero(np.concatenate([[True], ~joined]))
            run_of = np.cumsum(np.concatenate([[True], ~joined])) - 1
            pivot, pivot_n = key[first][run_of], n[first][run_of]
            several = np.concatenate([[False], joined]) | np.concatenate([joined, [False]])
            if held is not None:
                mine = run_of == 0
                pivot[mine], pivot_n[mine] = held[3], held[4]
                several[0] |= held[5]
            out = (several | (n <= 0))[:-1]
            columns = [sig[:-1][out], key[:-1][out], n[:-1][out], pivot[:-1][out], pivot_n[:-1][out]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["sig", "key", "n", "pivot", "pivot_n"])
            before = bool(joined[-1]) if len(sig) > 1 else bool(held and several[0])
            held = (sig[-1], key[-1], n[-1], pivot[-1], pivot_n[-1], before)
        if held is not None and (held[5] or held[2] <= 0):
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(held[:5], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)], names=["sig", "key", "n", "pivot", "pivot_n"])

    dealt = signed.repartition("sig").sortWithinPartitions("sig", "key", "n")
    return dealt.mapInArrow(run, "sig bigint, key bigint, n int, pivot bigint, pivot_n int")


def shingle_set(text: bytes | None, width: int) -> set[tuple[bytes, ...]]:
    found = words(text)
    if len(found) < width:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(width)), strict=False))


def linked(a: set, b: set, percent: int) -> bool:
    """Whether two sets, not empty, reach the similarity."""
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose texts are linked, by counting the n-grams they share."""
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, own = a, shingle_set(text_a.as_py(), width)
                keep.append(linked(own, shingle_set(text_b.as_py(), width), percent))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def _close(a: str, b: str, percent: int) -> Column:
    small, large = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
    return 100 * small >= percent * large


def sketch(tokens: np.ndarray) -> bytes:
    """The parity of how many elements fall on each bit: two sketches differ in no more bits than the sets in elements.

    Larger sets have longer sketches; a longer one is folded to the length of a shorter one by exclusive or.
    """
    bits = next((b for n, b in SKETCH_BITS if len(tokens) <= n), SKETCH_BITS[-1][1])
    parity = np.bincount((mixed(tokens) >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _sketched(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sketch(shingle_hashes(t.as_py(), width)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["node", "sketch"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, sketch binary")


class _Strays:
    """Strays of one bucket, held against its members as they come by."""

    def __init__(self, percent: int, likeliest: int | None):
        self.percent, self.likeliest = percent, likeliest
        self.reset(None)

    def reset(self, group) -> None:
        self.group, self.node, self.c, self.n, self.sketch = group, [], [], [], []
        self.best: dict[int, list[tuple[int, int]]] = {}

    def settle(self, out: list[tuple[int, int]]) -> None:
        for x, found in self.best.items():
            out.extend((min(x, y), max(x, y)) for _, y in found)
        self.best = {}

    def against(self, node: np.ndarray, c: np.ndarray, n: np.ndarray, sketches: list[bytes], out: list[tuple[int, int]]) -> None:
        lengths = np.array([len(s) for s in sketches])
        own = np.array([len(s) for s in self.sketch])
        mine = [np.array(x, np.int64) for x in (self.node, self.c, self.n)]
        for long in np.unique(lengths):
            those = np.flatnonzero(lengths == long)
            right = np.frombuffer(b"".join(sketches[i] for i in those), np.uint64).reshape(len(those), -1)
            for other in np.unique(own):
                strays = np.flatnonzero(own == other)
                left = np.frombuffer(b"".join(self.sketch[i] for i in strays), np.uint64).reshape(len(strays), -1)
                words_ = min(left.shape[1], right.shape[1])
                folded = [np.bitwise_xor.reduce(x.reshape(len(x), -1, words_), 1) for x in (left, right)]
                step = max(1, (1 << 21) // (len(strays) * words_))
                for i in range(0, len(those), step):
                    at = those[i : i + step]
                    apart = np.bitwise_count(folded[0][:, None] ^ folded[1][None, i : i + step]).sum(2, dtype=np.int64)
                    a, b = mine[2][strays][:, None], n[at][None]
                    near = apart <= (a + b) * (100 - self.percent) // (100 + self.percent)
                    near &= (100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)) & (mine[1][strays][:, None] != c[at][None])
                    for x, y in np.argwhere(near).tolist():
                        pair = int(mine[0][strays[x]]), int(node[at[y]])
                        if self.likeliest is None:
                            out.append((min(pair), max(pair)))
                            continue
                        held = self.best.setdefault(pair[0], [])
                        held.append((int(apart[x, y]), pair[1]))
                        held.sort()
                        del held[self.likeliest :]


def _near(member: DataFrame, sketches: DataFrame, percent: int, likeliest: int | None) -> DataFrame:
    """Pairs (a, b) of unconnected members of a bucket that could be linked by their sketches.

    A bucket's strays are its members outside its largest component. They are held in memory, in shares of about
    ``STRAYS``, and all members of the bucket pass by in blocks, so pairs that can't be linked are never rows. With
    ``likeliest`` only so many of the nearest partners of each stray and bucket are given.
    """
    by_part = member.groupBy("sig", "c").agg(F.count("*").alias("share"))
    by_sig = by_part.groupBy("sig").agg(F.max_by("c", F.struct("share", "c")).alias("main"), (F.sum("share") - F.max("share")).alias("strays")).withColumnRenamed("sig", "s")
    marked = member.join(by_sig, F.col("sig") == F.col("s")).drop("s").withColumn("shares", F.ceil(F.col("strays") / STRAYS).cast("long"))
    marked = marked.join(sketches.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).drop("of")
    names = ["sig", "part", "role", "node", "c", "n", "sketch"]
    strays = marked.where("c <> main").withColumn("part", F.pmod(F.xxhash64("node"), "shares")).withColumn("role", F.lit(0)).select(names)
    others = marked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).withColumn("role", F.lit(1)).select(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strays = _Strays(percent, likeliest)

        def rows(out: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(out, np.int64).reshape(len(out), 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            out: list[tuple[int, int]] = []
            sig, part, role, node, c, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            made = batch.column(6).to_pylist()
            change = (sig[1:] != sig[:-1]) | (part[1:] != part[:-1]) | (role[1:] != role[:-1])
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for i, k in zip(edges, edges[1:]):  # noqa: B905
                if i == k:
                    continue
                if strays.group != (sig[i], part[i]):
                    strays.settle(out)
                    strays.reset((sig[i], part[i]))
                if role[i] == 0:
                    strays.node.extend(node[i:k].tolist())
                    strays.c.extend(c[i:k].tolist())
                    strays.n.extend(n[i:k].tolist())
                    strays.sketch.extend(made[i:k])
                elif strays.node:
                    strays.against(node[i:k], c[i:k], n[i:k].astype(np.int64), made[i:k], out)
            yield rows(out)
        out = []
        strays.settle(out)
        yield rows(out)

    dealt = strays.unionByName(others).repartition("sig", "part").sortWithinPartitions("sig", "part", "role", "node")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def link_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, key, n_shingles, component_id): one row for each row of ``docs``.

    Documents are linked if 100 * intersection >= percent * union of their sets of distinct ``width``-word shingles
    (A-Z lower-cased; the whole sequence if there are fewer words). component_id is the smallest doc_id reachable by
    links, the document's own included. A document without words or text has n_shingles 0 and is its own component.
    Rows that repeat a doc_id are one document, linked by any of its texts; a row without one is linked with nothing
    and has no component. Equal texts are one from the start (by 64-bit hash, told apart by a second one). Other
    columns don't matter. An empty table gives an empty result. ``key`` is the text's hash.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("key"))
    found = stored(_buckets(_signed(keyed, width, percent)), "ngram-buckets")
    sizes = found.where("n <= 0").groupBy("key").agg(F.max(-F.col("n")).cast("long").alias("n_shingles"))

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("key"), F.xxhash64(body, F.lit(1)).alias("check"))
    classes = stored(named.where("doc_id is not null").groupBy("key", "check").agg(F.min("doc_id").alias("node")), "ngram-classes")
    buckets = found.where("n > 0")

    # Of all that a text shares a bucket with as pivot, the one it shares most with comes first.
    stars = stored(
        buckets.where(_close("n", "pivot_n", percent) & (F.col("key") != F.col("pivot"))).groupBy("pivot", "key").agg(F.count("*").alias("n")), "ngram-stars"
    )
    nodes = classes.select(F.col("key").alias("k"), "node")

    def as_nodes(pairs: DataFrame, a: str, b: str) -> DataFrame:
        first = nodes.withColumnsRenamed({"k": "k_a", "node": "n_a"})
        second = nodes.withColumnsRenamed({"k": "k_b", "node": "n_b"})
        both = pairs.join(first, F.col(a) == F.col("k_a")).join(second, F.col(b) == F.col("k_b"))
        return both.select(F.least("n_a", "n_b").alias("a"), F.greatest("n_a", "n_b").alias("b")).where("a <> b").distinct()

    wanted = buckets.select("key").distinct().join(classes, "key").select("node", F.col("key").alias("want"))
    texts = stored(
        keyed.join(wanted, (F.col("doc_id") == F.col("node")) & (F.col("key") == F.col("want"))).select("node", "want", F.col("text").cast("binary").alias("text")).dropDuplicates(["node", "want"]),
        "ngram-texts",
    )

    best = stars.groupBy("key").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot"))
    # Texts of one doc_id are linked by it.
    rows = named.join(classes, ["key", "check"]).select("doc_id", "node")
    several = rows.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    by_id = rows.join(several, "doc_id").select(F.col("low").alias("a"), F.col("node").alias("b")).where("a <> b")

    tested = stored(as_nodes(best, "pivot", "key"), "ngram-tested")
    links = stored(_verified(tested, texts, width, percent).unionByName(by_id), "ngram-links")
    labels = stored(components(links), "ngram-labels")

    # What is left are buckets whose members are not all connected. Each of a bucket's strays is held against the other
    # members; first the likeliest of them are compared, which connects most, then all that could be linked.
    member = buckets.select("sig", "key", "n").join(nodes, F.col("key") == F.col("k")).select("sig", "n", "node")
    sketches = None
    for likeliest in (LIKELIEST, None):
        at = labels.withColumnRenamed("node", "at")
        member = stored(member.join(at, F.col("node") == F.col("at"), "left").select("sig", "n", "node", F.coalesce("component", "node").alias("c")), "ngram-members")
        open_ = member.groupBy("sig").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("sig")
        member = stored(member.join(open_, "sig", "left_semi"), "ngram-members")
        if sketches is None:
            wanted = member.select("node").distinct().withColumnRenamed("node", "want_node")
            sketches = stored(_sketched(texts.join(wanted, F.col("node") == F.col("want_node"), "left_semi"), width), "ngram-sketches")
        rest = _near(member, sketches, percent, likeliest).distinct().join(tested, ["a", "b"], "left_anti")
        rest = stored(rest, "ngram-tested")
        new = stored(_verified(rest, texts, width, percent), "ngram-links")
        tested = tested.unionByName(rest)
        if not new.isEmpty():
            labels = stored(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new)), "ngram-labels")
        member = member.drop("c")

    ends = classes.join(labels.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left").select("key", "check", F.coalesce("component", "node").alias("class_id"))
    out = named.join(ends, ["key", "check"], "left").join(sizes, "key", "left")
    empty = F.col("n_shingles") == 0
    return out.select("doc_id", "key", "n_shingles", F.when(empty | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("component_id"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each component of :func:`link_components` the document of smallest id, once; columns as they are.

    Documents without words and rows without a doc_id all stay.
    """
    placed = stored(link_components(docs, width, percent), "ngram-placed").where("doc_id is not null and n_shingles > 0")
    placed = placed.groupBy("doc_id", "key").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    lost = placed.where("doc_id <> component_id").select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"))
    twice = placed.where("doc_id = component_id and rows > 1").select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"))
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = (F.col("doc_id") == F.col("__doc")) & (F.col("__own") == F.col("__key"))
    keyed = docs.withColumn("__own", key)
    once = keyed.join(lost.unionByName(twice), same, "left_anti")
    return once.unionByName(keyed.join(twice, same, "left_semi").dropDuplicates(["doc_id", "__own"])).select(*[F.col(f"`{c}`") for c in docs.columns])
