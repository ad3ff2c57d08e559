"""Byte-level BPE by rounds on padded matrices of equal-length pieces, and its exact inverse."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import query, sha, table, texts

NO_RANK = np.int32(np.iinfo(np.int32).max)
#: Widths of the padded matrices. A longer piece would need as many rounds as it has bytes, each over its whole
#: length; a heap merges it in the same order.
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
#: Pieces that a task takes up at a time, encoded pieces that a worker remembers, and the longest it remembers.
BLOCK, REMEMBERED, REMEMBERED_LENGTH = 100_000, 400_000, 64


class Ranks:
    """A rank file: token bytes by id, and pairs of ids to the id of their concatenation in a hash table."""

    def __init__(self, data: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, i in self.rank.items():
            self.token[i] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.known: dict[str, bytes] = {}
        keys, merged = [], []
        for token, i in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(i)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, NO_RANK, np.int32)
        todo, ids = np.array(keys, np.int64), np.array(merged, np.int32)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = todo[free]  # of several the last stays, the others go on
            won = self.keys[slot] == todo
            self.merged[slot[won]] = ids[won]
            todo, ids, slot = todo[~won], ids[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NO_RANK where the two make no token or one is negative (padding)."""
        shape = left.shape
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        slot = self._slot(keys[todo])
        while len(todo):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.merged[slot[hit]]
            on = ~hit & (there >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out.reshape(shape)

    def merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """The ids of each piece of at most ``width`` bytes: each round, every row merges its leftmost pair of least
        rank and closes the gap; rows without such a pair leave the matrix."""
        lengths = np.array([len(p) for p in pieces])
        flat = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        columns = np.arange(width)
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[columns < lengths[:, None]] = flat
        ranks = np.full((len(pieces), width), NO_RANK, np.int32)
        ranks[:, :-1] = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        out: list[bytes] = [b""] * len(pieces)
        where = np.arange(len(pieces))
        while len(where):
            at = ranks.argmin(axis=1)
            rows = np.arange(len(where))
            best = ranks[rows, at]
            going = best != NO_RANK
            if not going.all():
                for r in np.flatnonzero(~going):
                    out[where[r]] = ids[r, : lengths[r]].astype("<u4").tobytes()
                ids, ranks, where, lengths, at, best = ids[going], ranks[going], where[going], lengths[going], at[going], best[going]
                if not len(where):
                    break
                rows = rows[: len(where)]
            ids[rows, at] = best
            lengths -= 1
            shift = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, shift, 1)
            ids[columns >= lengths[:, None]] = -1
            ranks = np.take_along_axis(ranks, shift, 1)
            right = np.where(at + 1 < width, ids[rows, np.minimum(at + 1, width - 1)], -1)
            ranks[rows, at] = self.pair_ranks(ids[rows, at], right)
            left = np.where(at > 0, ids[rows, np.maximum(at - 1, 0)], -1)
            before = self.pair_ranks(left, ids[rows, at])
            has = at > 0
            ranks[rows[has], at[has] - 1] = before[has]
            keep = int(lengths.max())
            if keep < width * 3 // 4:
                width = max(keep, 2)
                ids, ranks, columns = ids[:, :width].copy(), ranks[:, :width].copy(), columns[:width]
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        first = self.pair_ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        now = first + [int(NO_RANK)]
        token, rank = self.token, self.rank
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or now[i] != r:
                continue
            j = after[i]
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0:
                    nxt = after[k]
                    now[k] = rank.get(token[ids[k]] + token[ids[nxt]], int(NO_RANK)) if nxt < n else int(NO_RANK)
                    if now[k] != NO_RANK:
                        heapq.heappush(heap, (now[k], k))
        return np.array([x for x, a in zip(ids, alive) if a], "<u4").tobytes()

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Little-endian ids of the distinct ``pieces``; a piece that is a token is that token."""
        out: dict[str, bytes] = {}
        buckets: dict[int, tuple[list[str], list[bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            whole = self.rank.get(data)
            if whole is not None:
                out[piece] = whole.to_bytes(4, "little")
            elif len(data) > WIDTHS[-1]:
                out[piece] = self.merge_long(data)
            else:
                names, rows = buckets.setdefault(next(w for w in WIDTHS if len(data) <= w), ([], []))
                names.append(piece)
                rows.append(data)
        for width, (names, rows) in buckets.items():
            most = max(1, (1 << 20) // width)
            for i in range(0, len(rows), most):
                out.update(zip(names[i : i + most], self.merge_rows(rows[i : i + most], width)))
        return out

    def blocks(self, text: str) -> Iterator[list[str]]:
        if len(text) < 4 * BLOCK:
            yield self.pattern.findall(text)
        else:
            found = (m[0] for m in self.pattern.finditer(text))
            while block := list(islice(found, BLOCK)):
                yield block

    def encode_all(self, rows: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        out: list[list[bytes]] = [[] for _ in rows]
        held: list[tuple[int, list[str]]] = []
        count = 0

        def flush() -> None:
            known = self.known
            if len(known) > REMEMBERED:
                known.clear()
            fresh = {p for _, block in held for p in block if p not in known}
            extra = self.encode_pieces(list(fresh)) if fresh else {}
            known.update(extra if count < BLOCK else {p: x for p, x in extra.items() if len(p) <= REMEMBERED_LENGTH})
            for i, block in held:
                out[i].append(b"".join([known.get(p) or extra[p] for p in block]))
            held.clear()

        for i, text in enumerate(rows):
            for block in self.blocks(text):
                held.append((i, block))
                count += len(block)
                if count >= BLOCK:
                    flush()
                    count = 0
        flush()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, Ranks] = {}


def load(data: bytes, pattern: str) -> Ranks:
    """One table for each file and Python worker."""
    key = sha(data) + pattern
    if key not in _LOADED:
        _LOADED[key] = Ranks(data, pattern)
    return _LOADED[key]


def shared_ranks(spark: SparkSession, path: str | None):
    """The rank file, read on the driver and sent once to each executor; its size is that of a vocabulary."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and ``ids``, the little-endian unsigned 32-bit ids of the text as binary, for each row.

    A null or empty text has empty ids; repeated rows and ids give a row each; other columns are not read.
    """
    data = shared_ranks(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(data.value, pattern)
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                ids = ranks.encode_all(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The columns of ``encode_documents`` and ``decoded``, the text's bytes; null ids decode to none."""
    data = shared_ranks(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(data.value, pattern)
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                decoded = [ranks.decode(x.as_py() or b"") for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of the ids and of the decoded bytes."""
    both = decode_documents(encode_documents(docs, path), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
