"""Benchmark decontamination: latent semantic retrieval finds passages near an item, the longest common subsequence
and the item's answer decide.

Passages become TF-IDF vectors over the benchmark's words; a randomised SVD of all passages, sketched in one distributed
pass, gives a latent space of fixed width; passages whose cosine to an item is high are compared with it word by word.
So is every place of a rare word that an item cannot do without: what the thresholds prove is found whatever its cosine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import chunks, flat_bytes, query, table, texts, word_hashes
from keyscore.storage import materialize

#: Words of a passage and of the steps between passages in the search; words of a part of an item that is searched for.
PASSAGE, STEP, PART = 64, 16, 48
#: Latent dimensions, and more of them that the sketch has.
RANK, OVERSAMPLING = 96, 16
#: Benchmark items that are searched for in one run over the documents.
ITEMS_AT_ONCE = 20_000
#: Words of the sketch that are added up together, about.
SKETCHED = 400_000
#: Words of the texts that are searched together.
TOGETHER = 65_536
#: Terms of a block of the sketch.
TERMS = 64
#: Words of the answer of an item without a shorter last sentence.
ANSWER = 8
SENTENCE_END = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Thresholds:
    """cosine: of a candidate. copy: share of the item's words in order that proves a copy. paraphrase: share that does
    with the answer, of which the share ``answer`` must be there in order."""

    cosine: float = 0.45
    copy: float = 0.75
    paraphrase: float = 0.5
    answer: float = 0.75


def hashes_of(values: list[str]) -> list[np.ndarray]:
    flat, offsets = flat_bytes(pa.array(values, pa.string()))
    words, at = word_hashes(flat, offsets)
    return [words[a:b] for a, b in zip(at[:-1], at[1:])]


class Items:
    """Items of the benchmark as ids into their own sorted vocabulary."""

    def __init__(self, rows: list[tuple[int, str]]):
        rows = [(i, t) for i, t in rows if t and t.strip(" \t\n\x0b\x0c\r")]
        words = hashes_of([t for _, t in rows])
        self.item = [i for i, _ in rows]
        self.vocabulary = np.unique(np.concatenate(words)) if rows else np.empty(0, np.uint64)
        self.ids = [np.searchsorted(self.vocabulary, w).astype(np.int32) for w in words]
        self.words = [dict(zip(*(x.tolist() for x in np.unique(w, return_counts=True)))) for w in self.ids]
        self.answer = []
        for (_, t), ids in zip(rows, self.ids):
            last = hashes_of([SENTENCE_END.split(t.strip(" \t\n\x0b\x0c\r"))[-1]])[0]
            self.answer.append(ids[-min(max(len(last), 3), ANSWER) :])
        self.part_item, self.part_ids = [], []
        for k, ids in enumerate(self.ids):
            n = max(1, -(-len(ids) // PART))
            for piece in np.array_split(ids, n):
                self.part_item.append(k)
                self.part_ids.append(piece)

    def find(self, words: np.ndarray) -> np.ndarray:
        """The id of each hash, -1 for words of no item."""
        if not len(self.vocabulary):
            return np.full(len(words), -1, np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1).astype(np.int32)


def key_words(items: Items, df: np.ndarray, limits: Thresholds) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the items that it is a key of: the items, and the offsets of the words' items.

    A text with c of an item's m words in order has one at least of any m - c + 1 of them. A copy therefore has one of
    the item's rarest, and a paraphrase one of the answer's rarest, the fewest that the thresholds allow.
    """
    pairs: list[tuple[int, int]] = []
    for k, (ids, answer) in enumerate(zip(items.ids, items.answer)):
        needs = [(ids, limits.copy if len(ids) >= 8 else 1.0)]
        if len(ids) >= 8 and limits.paraphrase < limits.copy:
            needs.append((answer, limits.answer))
        for words, share in needs:
            least = max(1, int(np.ceil(share * len(words) - 1e-9)))
            rarest = words[np.argsort(df[words], kind="stable")][: max(len(words) - least + 1, 1)]
            pairs.extend((w, k) for w in rarest.tolist())
    every = np.array(sorted(set(pairs)), np.int64).reshape(-1, 2)
    return every[:, 1], np.searchsorted(every[:, 0], np.arange(len(items.vocabulary) + 1))


def key_places(ids: np.ndarray, items: Items, keys: tuple[np.ndarray, np.ndarray], limits: Thresholds) -> dict[int, list[int]]:
    """The places of each item's key words that have enough of the item's words around them."""
    of, at = keys
    known = np.flatnonzero(ids >= 0)
    counts = at[ids[known] + 1] - at[ids[known]]
    total = int(counts.sum())
    if not total:
        return {}
    place = np.repeat(known, counts)
    item = of[np.repeat(at[ids[known]] - np.cumsum(counts) + counts, counts) + np.arange(total)]
    order = np.argsort(item, kind="stable")
    item, place = item[order], place[order]
    heads = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
    out: dict[int, list[int]] = {}
    for a, b in zip(heads, np.append(heads[1:], total)):
        k, near = int(item[a]), place[a:b]
        own = items.ids[k]
        inside = np.zeros(len(items.vocabulary) + 1, bool)
        inside[own] = True  # the last is for words of no item
        before = np.concatenate(([0], np.cumsum(inside[ids])))
        around = before[np.minimum(near + len(own), len(ids))] - before[np.maximum(near - len(own) + 1, 0)]
        near = near[around >= min(limits.paraphrase, limits.copy) * len(own) - 1e-9]
        if len(near):
            out[k] = near.tolist()
    return out


def common_words(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, one bit for each word of ``item``."""
    full = (1 << len(item)) - 1
    places: dict[int, int] = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << k
    row = full
    for w in text:
        hit = row & places.get(w, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def tokenize(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``ids``, the 32-bit places of the text's words in ``vocabulary`` (-1: none)."""
    items = Items([])
    items.vocabulary = vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in chunks(batch.column("text")):
                part = batch.slice(start, stop - start)
                words, at = word_hashes(*flat_bytes(part.column("text")))
                ids = items.find(words)
                blobs = [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "ids"])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, ids binary")


def passages_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a batch, the passage of each, and the offsets of the rows' ids and passages."""
    flat, offsets = flat_bytes(column)
    ids = np.frombuffer(flat.tobytes(), np.int32)
    at = offsets // 4
    counts = np.diff(at)
    bags = np.concatenate(([0], np.cumsum(-(-counts // width))))
    row = np.repeat(np.arange(len(counts)), counts)
    return ids, bags[row] + (np.arange(len(ids)) - at[row]) // width, at, bags


def passage_counts(tokens: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The number of passages, and of those with each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            ids, _, at, bags = passages_of(batch.column("ids"), PASSAGE)
            total[size] += bags[-1]
            # a row for each passage, its words in order: the first of equal ones counts
            rows = np.full(int(bags[-1]) * PASSAGE, -1, np.int32)
            rows[np.arange(len(ids)) + np.repeat(bags[:-1] * PASSAGE - at[:-1], np.diff(at))] = ids
            rows = np.sort(rows.reshape(-1, PASSAGE), axis=1)
            first = rows >= 0
            first[:, 1:] &= rows[:, 1:] != rows[:, :-1]
            total[:size] += np.bincount(rows[first], minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["term", "n"])

    counts = np.zeros(size + 1, np.int64)
    for r in tokens.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[r.term] = r.n
    return int(counts[size]), counts[:size]


def term_weights(items: Items, n: int, df: np.ndarray) -> np.ndarray:
    """Inverse passage frequencies. Terms of over a twentieth of the passages (and of over 20) weigh nothing, unless an
    item would be left with fewer than five words that weigh."""
    weights = np.log1p(n / np.maximum(df, 1))
    frequent = df > max(20, n // 20)
    light = weights * ~frequent
    for part in items.part_ids:
        if np.count_nonzero(light[part]) < 5:
            light[part] = weights[part]
    return light.astype(np.float32)


def sums_by(keys: np.ndarray, rows: np.ndarray, table: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` keys the sum of its ``rows`` of ``table``; ``keys`` are in order.

    The first rows of all keys are added, then the second ones and so on; keys with more rows stand first.
    """
    counts = np.bincount(keys, minlength=n)
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    sums = np.zeros((n, table.shape[1]), np.float32)
    for k, some in enumerate(n - np.cumsum(np.bincount(counts))[:-1]):
        sums[:some] += table[rows[first[:some] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def projection(size: int, width: int) -> np.ndarray:
    return np.random.default_rng(7).normal(size=(size, width)).astype(np.float32)


def latent_space(tokens: DataFrame, items: Items, weights: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors of the TF-IDF matrix A of all passages, a row for each term.

    One pass sketches Y = A'A O for a random O: each task adds up its passages, Spark sums the tasks' blocks of terms.
    The Nystrom form gives the vectors from Y and O'Y alone. The items' own passages are rows of A too, weighted so that
    they count as much as the documents, so the space holds what tells items apart.
    """
    size = len(weights)
    width = min(rank + OVERSAMPLING, size)

    def add(ids: np.ndarray, passage: np.ndarray, total: np.ndarray, weighted: np.ndarray) -> None:
        """Add what the passages give to ``total``, the rows of which are still to be weighted."""
        heavy = np.flatnonzero((ids >= 0) & (weights[np.maximum(ids, 0)] > 0))
        own, terms = passage[heavy], ids[heavy]
        start = 0
        while start < len(own):
            # whole passages, of PASSAGE words at most
            stop = len(own) if len(own) - start <= SKETCHED else int(np.searchsorted(own, own[start + SKETCHED]))
            these, some = own[start:stop] - own[start], terms[start:stop]
            z = sums_by(these, some, weighted, int(these[-1]) + 1)
            order = np.argsort(some, kind="stable")
            words = np.unique(some)
            for word, group in zip(words.tolist(), np.split(these[order], np.searchsorted(some[order], words[1:]))):
                total[word] += z[group].sum(axis=0)
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted, total = projection(size, width) * weights[:, None], np.zeros((size, width), np.float32)
        for batch in batches:
            ids, passage, _, _ = passages_of(batch.column("ids"), PASSAGE)
            add(ids, passage, total, weighted)
        total *= weights[:, None]
        blocks = range(0, size, TERMS)
        yield pa.RecordBatch.from_arrays([pa.array([b // TERMS for b in blocks]), pa.array([total[b : b + TERMS].tobytes() for b in blocks])], ["block", "y"])

    def merge(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(y.as_py(), np.float32).astype(np.float64) for y in group["y"])
        return pa.table({"block": group["block"][:1], "y": pa.array([total.tobytes()], pa.binary())})

    parts = tokens.select("ids").mapInArrow(run, "block long, y binary").groupBy("block").applyInArrow(merge, "block long, y binary").collect()
    omega, y = projection(size, width).astype(np.float64), np.zeros((size, width))
    for r in parts:
        y[r.block * TERMS : (r.block + 1) * TERMS] = np.frombuffer(r.y).reshape(-1, width)
    own = np.zeros((size, width), np.float32)
    add(np.concatenate(items.part_ids), np.repeat(np.arange(len(items.part_ids)), [len(p) for p in items.part_ids]), own, omega.astype(np.float32) * weights[:, None])
    own *= weights[:, None]
    y += own * max(1.0, np.abs(y).sum() / max(np.abs(own).sum(), 1e-9))
    shift = 1e-6 * np.linalg.norm(y) + 1e-12
    y += shift * omega
    c = omega.T @ y
    values, vectors = np.linalg.eigh((c + c.T) / 2)
    keep = values > values.max() * 1e-9
    b = y @ (vectors[:, keep] / np.sqrt(values[keep]))
    return np.linalg.svd(b, full_matrices=False)[0][:, :rank].astype(np.float32)


def near_passages(
    texts: list[np.ndarray], items: Items, weighted: np.ndarray, weights: np.ndarray, queries: np.ndarray, least: float, limits: Thresholds
) -> list[dict[int, list[int]]]:
    """For each text the starts of the passages whose cosine to a part of an item is high, by the item's place.

    The texts are laid out one after the other, each from the start of a block and with a passage of nothing behind it,
    so one pass over all their blocks serves them all; no passage reaches from one text into the next.
    """
    found: list[dict[int, list[int]]] = [{} for _ in texts]
    wide = PASSAGE // STEP
    own = np.array([-(-len(t) // STEP) for t in texts])
    first = np.cumsum(own + wide) - own - wide
    blocks = int((own + wide).sum())
    ids = np.full(blocks * STEP, -1, np.int32)
    for text, start in zip(texts, (first * STEP).tolist()):
        ids[start : start + len(text)] = text
    heavy = np.flatnonzero((ids >= 0) & (weights[np.maximum(ids, 0)] > 0))
    if not len(heavy):
        return found
    mass = np.bincount(heavy // STEP, weights=weights[ids[heavy]], minlength=blocks)
    windows = np.maximum(1, own - wide + 1)
    starts = np.arange(windows.sum()) + np.repeat(first - np.cumsum(windows) + windows, windows)
    cumulated = np.concatenate(([0.0], np.cumsum(mass)))
    picked = starts[cumulated[starts + wide] - cumulated[starts] >= least]
    if not len(picked):
        return found
    needed = np.zeros(blocks, bool)
    for k in range(wide):
        needed[picked + k] = True
    heavy = heavy[needed[heavy // STEP]]
    terms = ids[heavy]
    vectors = sums_by(heavy // STEP, terms, weighted, blocks)
    for start in range(0, len(picked), 4096):
        some = picked[start : start + 4096]
        x = sum(vectors[some + k] for k in range(wide))
        x /= np.linalg.norm(x, axis=1)[:, None] + 1e-12
        w, q = np.nonzero(x @ queries.T >= limits.cosine)
        at = some[w]
        text = np.searchsorted(first, at, side="right") - 1
        for t, place, part in zip(text.tolist(), ((at - first[text]) * STEP).tolist(), q.tolist()):
            found[t].setdefault(items.part_item[part], []).append(place)
    return found


def search(ids: np.ndarray, near: dict[int, list[int]], items: Items, limits: Thresholds, keys: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, float]]:
    """Items (by place) that the words ``ids`` of one document hold, with the share of their words found in order."""
    n = len(ids)
    spans = {k: [(a, a + PASSAGE) for a in at] for k, at in near.items()}
    for k, at in key_places(ids, items, keys, limits).items():
        spans.setdefault(k, []).extend((a, a + 1) for a in at)
    out = []
    for k, at in spans.items():
        item = items.ids[k].tolist()
        reach, best = len(item), 0.0
        groups: list[list[int]] = []
        for a, b in sorted(set(at)):
            if groups and a <= groups[-1][1]:
                groups[-1][1] = max(groups[-1][1], b)
            else:
                groups.append([a, b])
        for a, b in groups:
            low, high = max(0, a - reach), min(n, b + reach)
            last = max(high - 2 * reach, low)
            for s in [*range(low, last, reach), last]:  # any stretch as long as the item lies in one of these
                text = ids[s : s + 2 * reach].tolist()
                # no subsequence is longer than the item's words that are there at all
                if sum(map(items.words[k].__getitem__, items.words[k].keys() & text)) < limits.paraphrase * len(item):
                    continue
                share = common_words(item, text) / len(item)
                if share < limits.copy and share >= limits.paraphrase and len(item) >= 8:
                    answer = items.answer[k].tolist()
                    share = share if common_words(answer, text) >= limits.answer * len(answer) else 0.0
                elif share < limits.copy or (len(item) < 8 and share < 1):
                    share = 0.0
                best = max(best, share)
        if best > 0:
            out.append((k, best))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, limits: Thresholds = Thresholds(), at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``leaks``, an array of (item_id, share) by item_id, for each row of ``docs``.

    A null or empty text leaks nothing; a null or empty item is in no document; repeated rows and ids give a row each;
    an item that is listed twice is found twice (once in several blocks). Other columns are not read. Texts are searched whole. The benchmark is
    taken in blocks of about ``at_once`` items, each of which is one run over the documents, so what a task gets
    of it has a bound. An item under eight words must be there word for word.
    """
    total = benchmark.count()
    blocks = max(1, -(-total // at_once))
    docs = texts(docs)
    keyed = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"))
    found = []
    for block in range(blocks):
        rows = sorted((r.item_id, r.text) for r in keyed.where(F.col("block") == block).collect() if r.text is not None and r.item_id is not None)
        found.append(find_block(docs, Items(rows), limits))
    if blocks == 1:
        return found[0].select("doc_id", "text_hash", F.array_sort("leaks").alias("leaks"))
    key = ["doc_id", "text_hash"]
    every = reduce(DataFrame.unionByName, found).distinct().groupBy(*key).agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    return rows.alias("a").join(every.alias("b"), same).select("a.doc_id", "a.text_hash", "b.leaks")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark``, with all their columns."""
    leaked = find_leaks(docs, benchmark, limits).where(F.size("leaks") > 0).select("doc_id", "text_hash").distinct()
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), key.alias("hash"))
    return rows.join(leaked, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left_anti").select("row.*")


def find_block(docs: DataFrame, items: Items, limits: Thresholds) -> DataFrame:
    kind = "doc_id long, text_hash long, leaks array<struct<item_id:long,share:double>>"
    if not items.ids:
        return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.array().cast("array<struct<item_id:long,share:double>>").alias("leaks"))
    tokens = materialize(tokenize(docs, items.vocabulary), "leaks-tokens")
    n, df = passage_counts(tokens, len(items.vocabulary))
    weights = term_weights(items, n, df)
    weighted = latent_space(tokens, items, weights) * weights[:, None]
    queries = np.stack([weighted[p].sum(axis=0) for p in items.part_ids])
    queries /= np.linalg.norm(queries, axis=1)[:, None] + 1e-12
    least = 0.5 * limits.paraphrase * float(min(weights[p].sum() for p in items.part_ids))
    shared = docs.sparkSession.sparkContext.broadcast((items, weighted, weights, queries, key_words(items, df, limits)))
    leak = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weighted, weights, queries, keys = shared.value
        for batch in batches:
            flat, offsets = flat_bytes(batch.column("ids"))
            ids = np.frombuffer(flat.tobytes(), np.int32)
            at = (offsets // 4).tolist()
            own = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
            found = []
            while len(found) < len(own):
                # texts of about so many words together, one at least
                stop = int(np.searchsorted(offsets, offsets[len(found)] + 4 * TOGETHER, side="right")) - 1
                some = own[len(found) : max(stop, len(found) + 1)]
                near = near_passages(some, items, weighted, weights, queries, least, limits)
                found += [search(x, y, items, limits, keys) for x, y in zip(some, near)]
            rows = [[{"item_id": items.item[k], "share": s} for k, s in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(rows, leak)], ["doc_id", "text_hash", "leaks"])

    return tokens.mapInArrow(run, kind)


@query("op10_benchmark_leaks")
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.array_join(F.transform("leaks", lambda x: x["item_id"].cast("string")), ",").alias("items"),
        F.coalesce(F.round(F.array_max(F.transform("leaks", lambda x: x["share"])), 6), F.lit(0.0)).alias("share"),
    )
