"""Subword lattice likelihood: every segmentation of a text into pieces of an existing vocabulary counts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import chunks, fold, mix, most_frequent, query, sha, table, texts
from keyscore.storage import materialize

#: What begins a word in the vocabulary's pieces.
MARK = "▁"
LOG_ZERO = -1e30
#: Words that a worker remembers, and the longest of those that are sent to all.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 64
#: Words whose counts every task gets; the counts of all others are joined.
FREQUENT = 80_000


class Lattice:
    """Pieces with log weights; a character without a piece is spelled by its bytes.

    The vocabulary's scores are log weights of pieces, or, as in vocabularies made by merging, minus their rank. Ranks
    stand for weights by Zipf's law. ``log_weights`` replaces them, in the order of ``names``.
    """

    def __init__(self, model: bytes, log_weights: np.ndarray | None = None):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(vocabulary.get_piece_size())
        plain = [i for i in every if not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_byte(i) or vocabulary.is_unused(i))]
        scores = np.array([vocabulary.get_score(i) for i in plain])
        if np.all(scores == np.round(scores)):
            scores = -np.log(-scores - (-scores).min() + 2.7)
        self.names = [vocabulary.id_to_piece(i) for i in plain] + [f"<0x{b:02X}>" for b in range(256)]
        weights = np.concatenate((scores, np.full(256, scores.min())))
        self.log_weights = weights - np.logaddexp.reduce(weights) if log_weights is None else log_weights
        self.pieces = len(plain)
        self.longest = max(len(n) for n in self.names[: self.pieces])
        self.single = {n: i for i, n in enumerate(self.names[: self.pieces]) if len(n) == 1}
        keys = np.array([self._hash(n) for n in self.names[: self.pieces]], np.uint64)
        order = np.argsort(keys)
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ids = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        todo, ids = keys[order], order.astype(np.int32)
        slot = (todo >> self.shift).astype(np.int64)
        while len(todo):
            free = self.ids[slot] < 0
            self.keys[slot[free]], self.ids[slot[free]] = todo[free], ids[free]
            on = self.keys[slot] != todo
            todo, ids, slot = todo[on], ids[on], (slot[on] + 1) & self.mask

    @staticmethod
    def _hash(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(ord(c) + 1)
        return int(mix(h)[0])

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        keys = mix(hashes.ravel())
        out = np.full(len(keys), -1, np.int32)
        todo = np.arange(len(keys))
        slot = (keys >> self.shift).astype(np.int64)
        while len(todo):
            found = self.ids[slot]
            hit = (found >= 0) & (self.keys[slot] == keys[todo])
            out[todo[hit]] = found[hit]
            on = ~hit & (found >= 0)
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out.reshape(hashes.shape)

    def _bytes(self, character: str) -> np.ndarray:
        return self.pieces + np.frombuffer(character.encode("utf-8", "replace"), np.uint8).astype(np.int64)

    def _edges(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Lengths, and for each piece length the pieces and log weights that start at each place."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        codes = np.zeros((len(words), width), np.uint64)
        codes[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        ids, logs = [], []
        h = np.zeros((len(words), width), np.uint64)
        for size in range(1, min(self.longest, width) + 1):
            h = h[:, : width - size + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[:, size - 1 :]
            found = self.lookup(h)
            found[np.arange(width - size + 1) + size > lengths[:, None]] = -1
            ids.append(found)
            logs.append(np.where(found >= 0, self.log_weights[np.maximum(found, 0)], LOG_ZERO))
        spelled = (ids[0] < 0) & (np.arange(width) < lengths[:, None])
        for r, c in zip(*np.nonzero(spelled)):
            logs[0][r, c] = self.log_weights[self._bytes(words[r][c])].sum()
        return lengths, ids, logs, spelled

    def forward(self, words: list[str]) -> np.ndarray:
        """The log of the summed weight of all segmentations of each word."""
        lengths, _, logs, _ = self._edges(words)
        return self._forward(lengths, logs)[np.arange(len(words)), lengths]

    def _forward(self, lengths: np.ndarray, logs: list[np.ndarray]) -> np.ndarray:
        width = logs[0].shape[1]
        alpha = np.full((len(lengths), width + 1), LOG_ZERO)
        alpha[:, 0] = 0.0
        for at in range(1, width + 1):
            ways = np.stack([alpha[:, at - s] + logs[s - 1][:, at - s] for s in range(1, min(len(logs), at) + 1)])
            top = ways.max(axis=0)
            alpha[:, at] = top + np.log(np.exp(ways - top).sum(axis=0))
        return alpha

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in words that occur ``counts`` times, over all segmentations."""
        lengths, ids, logs, spelled = self._edges(words)
        width = logs[0].shape[1]
        alpha, rows = self._forward(lengths, logs), np.arange(len(words))
        beta = np.full((len(words), width + 1), LOG_ZERO)
        beta[rows, lengths] = 0.0
        for at in range(width - 1, -1, -1):
            ways = np.stack([beta[:, at + s] + logs[s - 1][:, at] for s in range(1, min(len(logs), width - at) + 1)] + [beta[:, at]])
            top = ways.max(axis=0)
            beta[:, at] = top + np.log(np.exp(ways - top).sum(axis=0))
        total = alpha[rows, lengths]
        out = np.zeros(len(self.names))
        for s, (found, log) in enumerate(zip(ids, logs), 1):
            share = np.exp(np.minimum(alpha[:, : width - s + 1] + log + beta[:, s:] - total[:, None], 0.0)) * counts[:, None]
            there = found >= 0
            out += np.bincount(found[there], weights=share[there], minlength=len(self.names))
            if s == 1:
                for r, c in zip(*np.nonzero(spelled)):
                    np.add.at(out, self._bytes(words[r][c]), share[r, c])
        return out

    def groups(self, words: list[str]) -> Iterator[list[int]]:
        """Indices of words of similar length, so that the matrices stay small."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        start = 0
        while start < len(order):
            most = max(1, (1 << 18) // max(len(words[order[start]]), 1))
            stop = start + 1
            while stop < len(order) and stop - start < most and len(words[order[stop]]) <= max(12, 2 * len(words[order[start]])):
                stop += 1
            yield order[start:stop]
            start = stop

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """log10 of each word's marginal weight."""
        marked = [MARK + w.decode("utf-8", "replace") for w in words]
        out = np.empty(len(words))
        for group in self.groups(marked):
            out[group] = self.forward([marked[i] for i in group]) / math.log(10)
        return out


_LOADED: dict[str, Lattice] = {}


def load(model: bytes, log_weights: bytes = b"") -> Lattice:
    key = sha(model + log_weights)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Lattice(model, np.frombuffer(log_weights) if log_weights else None)
    return _LOADED[key]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (binary, A-Z lowered) and ``n`` over all rows; the empty word counts the texts' ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                counts.update(words_of(text.as_py()))
                counts[b""] += 1
                if len(counts) > REMEMBERED:
                    yield rows()
        if counts:
            yield rows()

    return texts(docs).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train_pieces(counts: DataFrame, model: bytes, prior: float = 1000.0) -> tuple[bytes, float]:
    """Log weights of the pieces and of a text's end, from the words' counts.

    The vocabulary's own scores weight all segmentations of every counted word; the expected counts of its pieces,
    with ``prior`` counts spread by those scores, give the weights. What reaches the driver is a row for each piece.
    """
    data = counts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(data.value)
        total = np.zeros(len(lattice.names))
        for batch in batches:
            words = [MARK + w.as_py().decode("utf-8", "replace") for w in batch.column("word")]
            n = batch.column("n").to_numpy().astype(np.float64)
            for group in lattice.groups(words):
                total += lattice.expected([words[i] for i in group], n[group])
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["piece", "n"])

    rows = counts.where(F.octet_length("word") > 0).mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lattice = Lattice(model)
    weights = np.exp(lattice.log_weights) * prior
    for r in rows.collect():
        weights[r.piece] += r.n
    whole = weights.sum() + ends + 1
    return (np.log(weights) - math.log(whole)).tobytes(), math.log10((ends + 1) / whole)


def score_texts(docs: DataFrame, train: DataFrame, path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Scores of each row of ``docs`` under a model of the rows of ``train``.

    Returns ``doc_id``, ``n_tokens`` (words and one end), ``n_known``, ``train_tokens``, ``base_score`` (add-one
    unigram words) and ``score``, the log10 probability of the text as the sum over all its segmentations into pieces.

    Pieces do not cross words, so a text's sum is the product of its words' sums. Counts and sums of up to ``frequent`` of the
    most frequent words go to every task; the rest of the words, none of which is frequent, are joined with the table of
    counts in the order of words, where equal words meet and are worked out once. A null or empty text is its end alone;
    repeated rows and ids give a row each; an empty ``train`` leaves the vocabulary's scores.
    """
    spark = docs.sparkSession
    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    counts = materialize(count_words(train), "lattice-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log_weights, log_end = train_pieces(counts, model)
    short = counts.where(F.octet_length("word").between(1, REMEMBERED_LENGTH))
    weights = spark.sparkContext.broadcast((model, log_weights))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(*weights.value)
        for batch in batches:
            yield batch.append_column("score", pa.array(lattice.word_scores(batch.column("word").to_pylist()), pa.float64()))

    top = most_frequent(short, frequent).select("word", "n").mapInArrow(scored, "word binary, n long, score double").collect()
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = {bytes(r.word): i for i, r in enumerate(top)}, np.array([r.n for r in top], np.int64), np.array([r.score for r in top], np.float64)
    shared = spark.sparkContext.broadcast(often)
    log_space = math.log10(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        places, n, scores = shared.value
        logs, place = np.log10(n + 1.0), TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, stop in chunks(batch.column("text"), 4 << 20):
                part = batch.slice(start, stop - start)
                out: dict[str, list] = {k: [] for k in ("row", "n_tokens", "n_known", "base", "score", "rare", "times")}
                for text in part.column("text"):
                    t = words_of(text.as_py())
                    usual = [places[w] for w in t if w in places]
                    rare = Counter([w for w in t if w not in places]) if len(usual) < len(t) else {}
                    out["row"].append(place)
                    place += 1
                    out["n_tokens"].append(len(t) + 1)
                    out["n_known"].append(len(usual) + (ends > 0))
                    out["base"].append((float(logs[usual].sum()) if usual else 0.0) + math.log10(ends + 1))
                    out["score"].append((float(scores[usual].sum()) if usual else 0.0) + log_end)
                    out["rare"].append(list(rare))
                    out["times"].append(list(rare.values()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                arrays = [pa.array(x, kind) for x, kind in zip(out.values(), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], ["doc_id", *out])

    sums = "doc_id long, row long, n_tokens long, n_known long, base double, score double"
    rows = texts(docs).mapInArrow(run, f"{sums}, rare array<binary>, times array<long>")
    own = ["doc_id", "n_tokens", "n_known", "base", "score"]
    pairs = rows.select("row", *own, F.posexplode_outer(F.arrays_zip("rare", "times")).alias("pos", "x"))
    # the first of a text's rare words carries the text's own sums, the others none
    first = F.coalesce("pos", F.lit(0)) == 0
    # a text without rare words has a key of its own, which no word with its line end can be, so such texts do not meet in one task
    alone = F.concat(F.lit("\n"), F.col("row").cast("string")).cast("binary")
    pairs = pairs.select("row", *(F.when(first, F.col(c)).alias(c) for c in own), F.coalesce("x.rare", alone).alias("word"), F.col("x.times").alias("times"))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(*weights.value)
        for batch in batches:
            number = lambda c: batch.column(c).fill_null(0).to_numpy()
            times, n = number("times"), number("n")
            words = batch.column("word").dictionary_encode()
            at = words.indices.to_numpy()
            here = np.unique(at[times > 0])
            scores = np.zeros(len(words.dictionary))
            if len(here):
                scores[here] = lattice.word_scores(words.dictionary.take(pa.array(here)).to_pylist())
            arrays = [number("n_known") + times * (n > 0), number("base") + times * np.log10(n + 1.0), number("score") + times * scores[at]]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "row", "n_tokens")] + [pa.array(x) for x in arrays], ["doc_id", "row", *own[1:]])

    # merged by sorting, so equal words follow each other
    joined = pairs.join(counts.where(F.octet_length("word") > 0).hint("merge"), "word", "left").mapInArrow(added, sums)
    summed = joined.groupBy("row").agg(*(F.max(c).alias(c) for c in own[:2]), *(F.sum(c).alias(c) for c in own[2:]))
    return summed.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(log_space)).alias("base_score"),
        "score",
    )


@query("op6_lattice_lm")
def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    scored = score_texts(docs, docs.where(fold("doc_id", 7) != 2))
    return scored.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
