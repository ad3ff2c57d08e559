"""Quality by attention-based multiple-instance learning: a document is a bag of passages, only the bag has a label."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import BLANKS, chunks, flat_bytes, fold, query, table, texts, word_hashes

#: Words of a passage; dimensions of the random projection of its words.
PASSAGE, PROJECTED = 64, 12
CLASSES = (
    b"#*$%&|<>",
    b"!?",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:",
    bytes(range(128, 256)),
    b"\n",
)
WIDTH = 6 + len(CLASSES) + PROJECTED


def encode_passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A feature vector for each passage of each text, and the offsets of the texts' passages.

    A text without a word has one passage of zeros. The last passage of a text may be shorter.
    """
    flat, offsets = flat_bytes(column)
    hashes, at = word_hashes(flat, offsets)
    counts = np.diff(at)
    passages = np.maximum(-(-counts // PASSAGE), 1)
    bags = np.concatenate(([0], np.cumsum(passages)))
    n = int(bags[-1])
    out = np.zeros((n, WIDTH), np.float32)
    if not len(hashes):
        return out, bags
    row = np.repeat(np.arange(len(counts)), counts)
    passage = bags[row] + (np.arange(len(hashes)) - at[row]) // PASSAGE
    words = np.bincount(passage, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    solid_at = np.cumsum(~np.isin(flat, list(BLANKS.encode())))
    solid_start = np.concatenate(([0], solid_at))
    first = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    which = passage[first]
    starts = _word_starts(flat, offsets)
    left = starts[first]
    last_of_row = offsets[1:][np.searchsorted(bags, which, side="right") - 1]
    right = np.minimum(np.append(left[1:], len(flat)), last_of_row)
    chars = np.maximum(solid_start[right] - solid_start[left], 1)
    columns = [np.log1p(words) / 4]
    mean = np.zeros(n)
    mean[which] = chars / some[which] / 8
    columns.append(mean)
    keys = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    columns.append(_distinct(keys, n) / some)
    runs = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    lengths = np.diff(np.append(runs, len(keys)))
    most = np.zeros(n)
    np.maximum.at(most, (keys[runs] >> np.uint64(40)).astype(np.int64), lengths)
    columns.append(most / some)
    same = (passage[1:] == passage[:-1]) & (hashes[1:] == hashes[:-1])
    columns.append(np.bincount(passage[1:][same], minlength=n) / some)
    inside = passage[1:] == passage[:-1]
    pairs = (hashes[1:] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[:-1])[inside]
    keys = np.sort((passage[1:][inside].astype(np.uint64) << np.uint64(40)) | (pairs >> np.uint64(24)))
    columns.append((np.bincount(passage[1:][inside], minlength=n) - _distinct(keys, n)) / some)
    for kind in CLASSES:
        member = np.zeros(256, bool)
        member[list(kind)] = True
        total = np.concatenate(([0], np.cumsum(member[flat])))
        share = np.zeros(n)
        share[which] = (total[right] - total[left]) / chars
        columns.append(share)
    for bit in range(PROJECTED):
        sign = ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.float64) * 2 - 1
        columns.append(np.bincount(passage, weights=sign, minlength=n) / some)
    out[:] = np.stack(columns, axis=1)
    return out, bags


def _distinct(keys: np.ndarray, n: int) -> np.ndarray:
    if not len(keys):
        return np.zeros(n)
    fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
    return np.bincount((keys[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)


def _word_starts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    blank = np.isin(flat, list(BLANKS.encode()))
    before = np.concatenate(([True], blank[:-1]))
    edges = offsets[:-1][offsets[:-1] < len(flat)]
    before[edges] = True
    return np.flatnonzero(~blank & before)


@dataclass
class Attention:
    """Encoder, gated attention and classifier; ``p`` holds the parameters by name."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, passages: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        p, starts, sizes = self.p, bags[:-1], np.diff(bags)
        x = np.clip((passages - self.mean) / self.scale, -8, 8)
        e = np.tanh(x @ p["encode"] + p["encode_bias"])
        t, s = np.tanh(e @ p["attend"]), 1 / (1 + np.exp(-(e @ p["gate"])))
        a = (t * s) @ p["weigh"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * e, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["out"] + p["out_bias"], -30, 30)))
        return {"x": x, "e": e, "t": t, "s": s, "a": a, "z": z, "y": y}

    def score(self, passages: np.ndarray, bags: np.ndarray) -> np.ndarray:
        return self.forward(passages, bags)["y"] if len(bags) > 1 else np.empty(0)

    def gradient(self, passages: np.ndarray, bags: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, f, sizes = self.p, self.forward(passages, bags), np.diff(bags)
        do = (f["y"] - labels) / len(labels)
        dz = np.repeat(np.outer(do, p["out"]), sizes, axis=0)
        da = (f["e"] * dz).sum(axis=1)
        da = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, bags[:-1]), sizes))
        gated = np.outer(da, p["weigh"])
        dt, ds = gated * f["s"] * (1 - f["t"] ** 2), gated * f["t"] * f["s"] * (1 - f["s"])
        de = f["a"][:, None] * dz + dt @ p["attend"].T + ds @ p["gate"].T
        de *= 1 - f["e"] ** 2
        return {
            "out": f["z"].T @ do,
            "out_bias": do.sum(),
            "weigh": (f["t"] * f["s"]).T @ da,
            "attend": f["e"].T @ dt,
            "gate": f["e"].T @ ds,
            "encode": f["x"].T @ de,
            "encode_bias": de.sum(axis=0),
        }


def fit_attention(passages: np.ndarray, bags: np.ndarray, labels: np.ndarray, hidden: int = 16, steps: int = 400, rate: float = 0.02, decay: float = 1e-3, seed: int = 1) -> Attention:
    """Adam on the log loss of the bags; the same input gives the same model."""
    rng = np.random.default_rng(seed)
    p = {
        "encode": rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, hidden)),
        "encode_bias": np.zeros(hidden),
        "attend": rng.normal(0, 0.3, (hidden, hidden)),
        "gate": rng.normal(0, 0.3, (hidden, hidden)),
        "weigh": rng.normal(0, 0.3, hidden),
        "out": rng.normal(0, 0.3, hidden),
        "out_bias": np.zeros(()),
    }
    passages = passages.astype(np.float64)
    model = Attention(passages.mean(axis=0), passages.std(axis=0) + 1e-3, p)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    for step in range(1, steps + 1):
        for k, g in model.gradient(passages, bags, labels).items():
            g = g + decay * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        model.p = p
    return model


def train_quality(docs: DataFrame, labels: DataFrame, max_documents: int = 3000) -> Attention | None:
    """A model from labelled rows whose crc32(doc_id) modulo 4 is not 2; None without labels of both kinds.

    The fit takes a bounded sample: about ``max_documents`` documents by a hash of the id, half of them (if there are
    so many) of either label, with all their passages. Of several labels of a document the lowest counts; null ids and
    labels are left out. Labels, ids, languages and sources are no inputs.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").cast("int").alias("label")).where(fold("doc_id", 4) != 2)
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return None
    share = {k: int(1e6 * min(1.0, max_documents / 2 / n)) for k, n in totals.items()}
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.when(F.col("label") == 0, share[0]).otherwise(share[1]))
    prior = totals[1] / (totals[0] + totals[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in chunks(batch.column("text")):
                part = batch.slice(start, stop - start)
                vectors, bags = encode_passages(part.column("text"))
                rows = [vectors[bags[i] : bags[i + 1]].tobytes() for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "passages"])

    sample = texts(docs).join(F.broadcast(picked), "doc_id").mapInArrow(run, "doc_id long, label int, passages binary")
    rows = sorted(sample.collect(), key=lambda r: (r.doc_id, r.passages))
    parts = [np.frombuffer(r.passages, np.float32).reshape(-1, WIDTH) for r in rows]
    y = np.array([float(r.label) for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    bags = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
    model = fit_attention(np.concatenate(parts), bags, y)
    seen = y.mean()  # the sample is balanced, the documents are not
    model.p["out_bias"] = model.p["out_bias"] + np.log(prior / (1 - prior)) - np.log(seen / (1 - seen))
    return model


def score_quality(docs: DataFrame, model: Attention | None) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) for each row of ``docs``, from all passages.

    Null and empty texts are a bag of one empty passage. Without a model every score is 0.5. Repeated rows and ids give
    a row each; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in chunks(batch.column("text")):
                part = batch.slice(start, stop - start)
                if model is None:
                    scores = np.full(len(part), 0.5)
                else:
                    scores = model.score(*encode_passages(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


@query("op5_quality_mil")
def op5_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
