"""Boilerplate lines, found by how many sites have them. DataFrame operations only.

Lines are compared by the 64-bit hash of their trimmed text. Counts rule out lines that can't be on enough sites; each
other line gets a HyperLogLog sketch of its sites, made in every task and merged by the aggregation, so a line on a
third of all documents costs no more than any. Estimates far from the threshold decide; near it, distinct sites are
counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.llm.common import stored

MIN_SITES = 10
MIN_WORDS = 3
#: What the pipeline asks of a long line: a passage of so many words on so many sites is no coincidence.
LONG_SITES = 3
LONG_WORDS = 20
#: What the pipeline takes instead of 3 and of 20 words, in code points, so that scripts without spaces count too.
LINE_CHARS = 20
LONG_CHARS = 120
#: log2 of a sketch's registers: a standard error of 1.6%.
SKETCH_BITS = 12
#: Estimates within this share of the threshold are counted exactly; over nine standard errors.
NEAR = 0.15

_SPACES = "\t\n\v\f\r "


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_SPACES)))


def _eligible(line: Column, min_words: int, min_chars: int | None = None) -> Column:
    """Whether a line has that many words, or without outer spaces that many code points.

    Anchored and without backtracking: linear even in a line of one long word.
    """
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    enough = line.rlike(f"^{space}*+" + f"{word}++{space}++" * (min_words - 1) + word)
    return enough if min_chars is None else enough | (F.char_length(F.btrim(line, F.lit(_SPACES))) >= min_chars)


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Of rows (line, site, doc), all bigint: the lines on at least ``min_sites`` distinct sites, with their first doc.

    A further column ``need``, the same for all rows of a line, has a line's own number of sites instead.
    """
    need = F.max("need") if "need" in lines.columns else F.lit(min_sites)
    often = (
        lines.groupBy("line")
        .agg(F.count("*").alias("n"), F.min("site").alias("low"), F.max("site").alias("high"), need.alias("need"))
        .where((F.col("n") >= F.col("need")) & ((F.col("low") != F.col("high")) | (F.col("need") <= 1)))
        .select("line")
    )
    spread = (
        lines.join(often, "line", "left_semi")
        .groupBy("line")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"), F.min("doc").alias("first_doc"), need.alias("need"))
    )
    spread = stored(spread.where(F.col("sites") >= (1 - NEAR) * F.col("need")), "line-spread")
    sure = F.col("sites") > (1 + NEAR) * F.col("need")
    exact = (
        lines.join(spread.where(~sure).select("line"), "line", "left_semi")
        .groupBy("line")
        .agg(F.count_distinct("site").alias("exact_sites"), need.alias("need"))
        .where(F.col("exact_sites") >= F.col("need"))
    )
    counted = spread.where(~sure).join(exact.select("line"), "line")
    return spread.where(sure).select("line", "first_doc").unionByName(counted.select("line", "first_doc"))


def drop_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, text: str = "text", site: str = "source", doc_id: str = "doc_id",
    long_sites: int | None = None, long_words: int = LONG_WORDS, min_chars: int | None = None, long_chars: int | None = None,
) -> DataFrame:
    """``docs`` with ``text`` less its boilerplate lines, and n_lines and n_removed.

    A line (between newlines; outer spaces don't count) of ``min_words`` words or more that stands on at least
    ``min_sites`` distinct sites is boilerplate; with ``long_sites``, one of ``long_words`` words or more that stands on
    that many is too. With ``min_chars`` and ``long_chars`` so many code points stand in for the words. The document of smallest id that has it keeps it; it goes from every
    other. Nothing else of a text changes. A null site is a site of its own. A null text stays null with 0 lines, an
    empty one has one line. Rows without an id never keep a boilerplate line as the first, unless all are without.
    Rows that repeat an id keep or lose a line together. Columns named n_lines or n_removed are replaced. An empty
    table gives an empty result.
    """
    body = F.col(f"`{text}`").cast("string")
    # A document's list of lines to drop may be shared by rows of equal keys: every line in it goes wherever it stands.
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(2**63 - 1))
    need = [] if long_sites is None else [F.when(_eligible(F.col("raw"), long_words, long_chars), long_sites).otherwise(min_sites).alias("need")]
    lines = (
        docs.select(key.alias("doc"), F.xxhash64(F.coalesce(F.col(f"`{site}`").cast("string"), F.lit("\u0000none"))).alias("site"), F.explode(_lines(body)).alias("raw"))
        .where(_eligible(F.col("raw"), min_words, min_chars))
        .select(_hash(F.col("raw")).alias("line"), "site", "doc", *need)
    )
    lines = stored(lines, "lines")
    found = stored(boilerplate(lines, min_sites), "boilerplate")
    listed = (
        lines.join(found, "line").where(F.col("doc") != F.col("first_doc")).groupBy("doc").agg(F.collect_set("line").alias("__drop")).withColumnRenamed("doc", "__doc")
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    parts = _lines(F.col(f"`{text}`").cast("string"))
    left = F.filter(parts, lambda x: ~(_eligible(x, min_words, min_chars) & F.array_contains(F.col("__drop"), _hash(x))))
    joined = docs.select(*[F.col(f"`{c}`") for c in names], key.alias("__key")).join(listed, F.col("__key") == F.col("__doc"), "left")
    touched = F.col("__drop").isNotNull()
    cleaned = joined.withColumn("__left", F.when(touched, left))
    n_lines = F.coalesce(F.size(parts), F.lit(0))
    return cleaned.select(
        *[(F.when(touched, F.array_join("__left", "\n")).otherwise(F.col(f"`{c}`")) if c == text else F.col(f"`{c}`")).alias(c) for c in names],
        F.when(F.col(f"`{text}`").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(touched, F.size(parts) - F.size("__left")).otherwise(0).cast("long").alias("n_removed"),
    )
