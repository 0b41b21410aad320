"""Mixing sources to target weights along a curriculum.

Each source has a weight, which settles how many words the mix takes of it, and a schedule, which settles when: a
piecewise linear density over training time. A source's documents stand in a fixed random order; a document that
begins at word c of its source (c plus the source's size on a second pass, and so on) is due when the integral of the
schedule reaches c's share of the target. That integral is inverted in closed form, so a position is an expression of
the row, and the mix is a range sort by position.

The running sum of sizes within a source is taken in two steps, as one source may hold much of the corpus: sums by
hash range of the order, then a running sum within each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookfuse.llm.common import WORD

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Densities at the start, the middle and the end of training; sources take them in turn, in their order.
SCHEDULES = ((1.6, 1.0, 0.4), (1.0, 1.0, 1.0), (0.4, 1.0, 1.6))
SEED = "mix"
#: Hex digits of the order's hash that make a range: 4096 ranges of each source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with rank, weight and target.

    Sources rank by code point, null last, and take the weights in turn. Targets share the whole size by weight;
    none is above ``max_repeats`` times its source's size, and what is cut off goes to the others by weight.
    In ascending order of the size of a weight's share, sources are cut off as long as their limit is below what their
    weight would give them; that is the fixed point of sharing again and again. One row per source passes one task.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    limit = F.col("source_size") * max_repeats
    order = Window.orderBy((limit / F.col("weight")).asc(), F.col("rank").asc())
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = (
        ranked.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("left", F.col("total") - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(onward))
        .withColumn("cut", limit * F.col("weights") <= F.col("left") * F.col("weight"))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum(F.when(F.col("cut"), limit)).over(whole), F.lit(0)))
        .withColumn("rest_weight", F.sum(F.when(~F.col("cut"), F.col("weight"))).over(whole))
    )
    target = F.when(F.col("cut"), limit.cast("double")).otherwise((F.col("rest") * F.col("weight")).cast("double") / F.col("rest_weight"))
    return shared.select("source", "source_size", "rank", "weight", target.alias("target"))


def due(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The time, 0 to 1, at which the integral of a source's schedule reaches ``share`` of its whole."""
    time = None
    for number, densities in enumerate(schedules):
        pieces = len(densities) - 1
        area = sum((a + b) / 2 for a, b in zip(densities, densities[1:])) / pieces  # noqa: B905
        reached, inverse = 0.0, None
        for i in range(pieces):
            start, end = densities[i] / area, densities[i + 1] / area
            rest = share - F.lit(reached)
            root = F.sqrt(F.greatest(F.lit(start * start) + F.lit(2 * (end - start) * pieces) * rest, F.lit(0.0)))
            here = F.lit(i / pieces) + F.lit(2.0) * rest / (F.lit(start) + root)
            reached += (start + end) / 2 / pieces
            # Built from the last piece backwards below, so that each holds up to its own end.
            inverse = [*(inverse or []), (reached, here)]
        piecewise = inverse[-1][1]
        for end, here in reversed(inverse[:-1]):
            piecewise = F.when(share <= F.lit(end), here).otherwise(piecewise)
        chosen = rank % len(schedules) == number
        time = F.when(chosen, piecewise) if time is None else time.when(chosen, piecewise)
    return F.least(F.greatest(time, F.lit(0.0)), F.lit(1.0))


def plan_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    schedules=SCHEDULES,
    seed: str = SEED,
    carry: bool = False,
) -> DataFrame:
    """Each document with size, source_size, target, taken, and ``starts``: words of its source before it.

    A document's size is its number of words, 0 for a null or empty text. A source's documents stand in the order of
    md5 of seed and id; of its target, rounded to a whole word, each pass takes the documents one after another, and
    the last one taken gives only the words that are left. So a source's taken words add up to its target, and no
    document gives more than ``max_repeats`` times its size. Null sources are one source, ranked last. Rows without an
    id are ordered by their text. Repeated rows are documents of their own. With ``carry``, whole rows come along as a
    struct, ``row``. An empty table gives an empty result.
    """
    body = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
        F.coalesce(F.regexp_count(body, F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.xxhash64(body).cast("string")))).alias("order"),
        F.xxhash64(body).alias("tie"),
    ).withColumn("range", F.substring("order", 1, RANGE_DIGITS))
    # Only what the sums need: the texts are counted again rather than kept.
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    sizes = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))).alias("o")
    targets = source_targets(sizes, weights, max_repeats).alias("t")
    known = offsets.join(targets, F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("at_source"), F.col("o.range").alias("at_range"), "offset", "source_size", "rank", "target"
    )
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("range") == F.col("at_range")))
    within = Window.partitionBy("at_source", "at_range").orderBy("order", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    whole = F.floor(F.col("target") + 0.5)
    out = placed.withColumn("starts", starts).withColumn(
        "passes",
        F.array(*[F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - F.col("source_size") * p - F.col("starts"))) for p in range(max_repeats)]),
    )
    taken = sum((F.col("passes")[p] for p in range(max_repeats)), F.lit(0).cast("long"))
    first = due((F.col("starts") + F.col("passes")[0] / F.lit(2)) / F.col("target"), F.col("rank"), schedules)
    return out.select(
        "doc_id", *(["row"] if carry else []), "size", "source_size", "target", taken.alias("taken"),
        F.when(F.col("passes")[0] > 0, first).alias("position"), "starts", "rank", "passes",
    )


def mixed_order(docs: DataFrame, schedules=SCHEDULES, **options) -> DataFrame:
    """The mix itself: a row for each time a document is taken, sorted by position over the whole table.

    The columns of ``docs``, then pass (0 for the first), words (those taken, fewer than the document's only for the
    last one of a source) and position. Options and edge cases are those of :func:`plan_mix`.
    """
    kept = [c for c in docs.columns if c not in ("pass", "words", "position")]
    planned = plan_mix(docs, schedules=schedules, carry=True, **options)
    share = (F.col("source_size") * F.col("pass") + F.col("starts") + F.col("words") / F.lit(2)) / F.col("target")
    return (
        planned.select("row", "doc_id", "source_size", "starts", "target", "rank", F.posexplode("passes").alias("pass", "words"))
        .where("words > 0")
        .withColumn("position", due(share, F.col("rank"), schedules))
        .orderBy("position", "doc_id", "pass")
        .select(*[F.col("row")[c].alias(c) for c in kept], "pass", "words", "position")
    )
