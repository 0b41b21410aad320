"""What several operators share: words, hashes, folds and written intermediate tables.

Words are runs of anything but the six ASCII spaces (``[^\\x20\\x09-\\x0D]+``). They are cut and lower-cased (A-Z only)
as UTF-8 bytes, which gives the same words as on characters, since bytes of other characters are all above 0x7F.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.session import scratch_folder

WORD = r"[^\x20\x09-\x0D]+"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def words(text: bytes | None, lower: bool = True) -> list[bytes]:
    if not text:
        return []
    return (text.lower() if lower else text).split()


def term_table(digits: bool) -> bytes:
    """For ``bytes.translate``: A-Z to a-z, every other byte below 0x80 that is no letter (or digit) to a space."""
    stays = set(b"abcdefghijklmnopqrstuvwxyz") | (set(b"0123456789") if digits else set())
    return bytes(i + 32 if 0x41 <= i <= 0x5A else i if i >= 0x80 or i in stays else 0x20 for i in range(256))


def term_lists(text: bytes | None, table: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about ``size`` bytes of it, so a long text needs no list of all its terms.

    Spaces, as ``table`` makes them, end a term; cuts are made at spaces only.
    """
    at, end = 0, len(text or b"")
    while at < end:
        stop, piece = min(at + size, end), b""
        while True:
            piece += text[at:stop].translate(table)
            at = stop
            if at == end:
                break
            cut = piece.rfind(b" ")
            if cut >= 0:
                at -= len(piece) - cut - 1
                piece = piece[:cut]
                break
            stop = min(at + size, end)
        yield piece.split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` hashes."""
    n = max(len(hashes) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out + hashes[i : i + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words; of the whole sequence if it is shorter."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(found)
    if len(found) < width:
        # Seeded by the length, so that a short text never equals a full run.
        return window_hashes(hashes + np.uint64(len(found)), len(found))
    return np.unique(window_hashes(hashes, width))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def held_out(doc_id: Column, divisor: int, part: int) -> Column:
    """Whether a document is kept out of learning; one without an id is not."""
    return F.coalesce(remainder(doc_id, divisor) == part, F.lit(False))


def stored(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: computed once, without lineage."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
