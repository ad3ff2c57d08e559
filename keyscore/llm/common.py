"""What the operators share: registration, table access, word hashes on Arrow buffers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Bytes that separate words: blank and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"

IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS.encode())] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: An odd multiplier for polynomial hashes modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty; other columns only where named."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def fold(column: str, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows with the largest ``n`` (1 or more), ``limit`` at most.

    The cut is found from a histogram of at most 2,048 steps, so no task sends its own longest list to the driver; a step
    that would pass the limit is left out as a whole.
    """
    step = F.floor(F.log2("n") * 32)
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    total, cut = 0, 1 << 31
    for r in sorted(histogram, key=lambda r: -r.step):
        total += r.rows
        if total > limit:
            break
        cut = r.step
    return counts.where(step >= cut)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows, without a copy; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets.astype(np.int64) - int(offsets[0] if len(offsets) else 0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


#: Bytes that are hashed at once: what a hash needs per byte is held for so many only, however long a text is.
SLICE = 1 << 20
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64. What is kept for later calls never exceeds two slices."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.cumprod(have, dtype=np.uint64, out=have)
        if len(have) <= 2 * SLICE:
            _POWERS[base] = have
    return have[:n]


def _hash_slice(flat: np.ndarray, offsets: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first and last bytes of the words of a slice; ``offsets`` are the places in it where a row begins."""
    solid = ~blank[flat]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    starts[offsets] = solid[offsets]
    first = np.flatnonzero(starts)
    del starts
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    before = offsets[offsets > 0] - 1
    stops[before] = solid[before]
    last = np.flatnonzero(stops)
    del stops
    sums = LOWER[flat].astype(np.uint64)
    sums += np.uint64(1)
    sums *= powers(BASE, len(flat))
    sums *= solid
    np.cumsum(sums, out=sums)
    raw = sums[last]
    raw -= np.where(first > 0, sums[np.maximum(first - 1, 0)], np.uint64(0))
    raw *= powers(INVERSE, len(flat))[first]
    return mix(raw ^ ((last - first + 1).astype(np.uint64) << np.uint64(48))), first, last


def word_spans(flat: np.ndarray, offsets: np.ndarray, blank: np.ndarray = IS_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word with A-Z lowered, and the words' first and last bytes.

    A row's end separates words as a blank does. Equal words have equal hashes; different ones differ but for a chance
    of 2**-64 a pair. The bytes are taken in slices that end between words.
    """
    n, start = len(flat), 0
    edges = np.unique(offsets[:-1])
    edges = edges[edges < n]
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while start < n:
        stop = min(n, start + SLICE)
        while stop < n:
            # on to the next blank or row, whichever is nearer; a word longer than a slice makes the slice longer
            ahead = flat[stop : stop + 4096]
            gap = np.flatnonzero(blank[ahead])
            edge = np.searchsorted(edges, stop)
            to_edge = int(edges[edge]) - stop if edge < len(edges) else n - stop
            to_gap = int(gap[0]) if len(gap) else len(ahead)
            stop += min(to_edge, to_gap)
            if len(gap) or to_edge <= to_gap:
                break
        inside = edges[np.searchsorted(edges, start) : np.searchsorted(edges, stop)] - start
        hashes, first, last = _hash_slice(flat[start:stop], inside, blank)
        parts.append((hashes, first + start, last + start))
        start = stop
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0]


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of ``word_spans``, and the words' offsets by row."""
    hashes, first, _ = word_spans(flat, offsets)
    return hashes, np.searchsorted(first, offsets).astype(np.int64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of ``size`` consecutive words, sorted; all words as one if there are fewer."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        out = words[: len(words) - width + 1].copy()
        for k in range(1, width):
            out *= np.uint64(BASE)
            out ^= out >> np.uint64(32)
            out += words[k : len(words) - width + 1 + k]
        return np.unique(mix(out + np.uint64(width)))


def chunks(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, one row at least."""
    _, offsets = flat_bytes(column)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        yield start, stop
        start = stop
