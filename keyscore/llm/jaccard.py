"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, found by T-occurrence search.

Candidates come from shared shingles in prefixes: two sets that overlap enough share one of the rarest shingles of each.
Their sets meet in small inverted indexes, where DivideSkip (Li, Lu, Lu, 2008) finds all indexed sets that occur at least
T times in a query's lists. Equal sets are one node throughout, and no group of similar documents is expanded into its
pairs: first every node is tried against one candidate, then only nodes that links have not yet brought together.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyscore.llm.common import chunks, flat_bytes, most_frequent, query, shingles, table, word_hashes
from keyscore.llm.graph import components
from keyscore.llm.substrings import pack, unpack
from keyscore.storage import materialize

#: Similarity as a fraction, words of a shingle.
SIMILAR, WORDS = (3, 4), 5
#: Shingles that a task sees in so many documents may be frequent; how many of the most frequent ones all tasks know.
SEEN, FREQUENT = 2, 200_000
#: Bytes of text for each bucket of shingles, queries for each inverted index, bits by which texts are picked.
BUCKET_BYTES, QUERIES, PICK_BITS = 32 << 20, 500, 20
#: Queries with one index entry that a task takes.
SALTED = 1000
#: Nodes ask again as long as more than one of so many that asked was linked.
AGAIN = 4
NO_ID = -(1 << 63)
#: Columns of 64 bits in which a set is summed up.
SKETCH = [f"s{i}" for i in range(8)]
BLOB = "kind int, bucket long, data binary"


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def needed(a: int, b: int) -> int:
    """The overlap from which on sets of ``a`` and ``b`` elements are similar: overlap / union >= p / q."""
    p, q = SIMILAR
    return -(-p * (a + b) // (p + q))


def prefix_length(n: int) -> int:
    """A set shares at least ceil(n p / q) elements with a similar one, so one of its first n - that + 1."""
    p, q = SIMILAR
    return n + (-p * n // q) + 1


def common_prefix() -> Column:
    """How many shingles the prefixes of similar sets of ``n_a`` and ``n_b`` elements share at least.

    Of two prefixes one ends first in the common order. What the sets share up to there is in both prefixes; the rest is
    among that set's elements behind its prefix, n - prefix_length(n) of them.
    """
    p, q = SIMILAR
    total = F.ceil(F.lit(p) * (F.col("n_a") + F.col("n_b")) / (p + q))
    behind = lambda n: F.ceil(F.lit(p) * F.col(n) / q) - 1
    return F.greatest(total - F.greatest(behind("n_a"), behind("n_b")), F.lit(1))


def sketch(own: np.ndarray) -> np.ndarray:
    """A bit for each range of hashes: whether the set has an odd number there. Two sets differ in as many elements as bits
    at least, since an element that only one of them has flips one bit."""
    odd = np.bincount((own >> np.uint64(55)).astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_link() -> Column:
    """Whether sets of ``n_a`` and ``n_b`` elements do not differ by more than similar ones can, as far as their sketches tell."""
    p, q = SIMILAR
    total = F.col("n_a") + F.col("n_b")
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    return differ <= total - 2 * F.ceil(F.lit(p) * total / (p + q))


def may_begin() -> Column:
    """Whether a shingle at ``place_a`` and ``place_b`` of sets of ``n_a`` and ``n_b`` elements may be the first that similar sets share.

    All sets have one order, rare to frequent: what they share follows the first shared shingle in both, so as many
    elements as they must share, that one included, are left from there on. A version with many shingles of its own, which
    are its rarest, has none left to begin with.
    """
    p, q = SIMILAR
    total = F.ceil(F.lit(p) * (F.col("n_a") + F.col("n_b")) / (p + q))
    return F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= total


def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, distinct shingles, hash of the set) of each row; a set without elements has the hash 0."""
    column = batch.column("text")
    for start, stop in chunks(column):
        words, at = word_hashes(*flat_bytes(column.slice(start, stop - start)))
        for i in range(stop - start):
            own = shingles(words[at[i] : at[i + 1]], WORDS)
            yield start + i, own, signed(xxhash.xxh3_64_intdigest(own.tobytes()) or 1) if len(own) else 0


def describe(docs: DataFrame) -> DataFrame:
    """Rows of kind 0 (``doc``, ``hash``, ``node`` the name of its set, ``n`` its elements, its sketch) for each row of ``docs``,
    and of kind 1 (``node`` a shingle that several documents of a task have, ``n`` of how many)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        load = 0

        def often() -> pa.RecordBatch:
            every = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
            head = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.empty(0, np.int64)
            count = np.diff(np.append(head, len(every)))
            many = count >= SEEN
            held.clear()
            found = every[head[many]].view(np.int64)
            none = np.zeros(len(found), np.int64)
            return frame(1, none, none, found, count[many], np.zeros((len(found), len(SKETCH)), np.int64))

        def frame(kind: int, doc: np.ndarray, text: np.ndarray, node: np.ndarray, n: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(np.full(len(doc), kind), pa.int32()), *(pa.array(np.ascontiguousarray(x), pa.int64()) for x in (doc, text, node, n, *bits.T))]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "doc", "hash", "node", "n", *SKETCH])

        for batch in batches:
            ids = batch.column("doc").to_pylist()
            texts_in = batch.column("hash").to_pylist()
            doc, text, node, n, bits = [], [], [], [], []
            for i, own, name in sets_of(batch):
                doc.append(ids[i])
                text.append(texts_in[i])
                node.append(name)
                n.append(len(own))
                bits.append(sketch(own))
                if name and name not in seen:
                    seen.add(name)
                    held.append(own)
                    load += len(own)
            yield frame(0, *(np.array(x, np.int64) for x in (doc, text, node, n)), np.array(bits, np.int64).reshape(-1, len(SKETCH)))
            if load > 8_000_000:
                yield often()
                load = 0
        yield often()

    return docs.withColumn("hash", F.xxhash64("text")).mapInArrow(run, ", ".join(["kind int, doc long, hash long, node long, n long", *(f"{c} long" for c in SKETCH)]))


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Prefix shingles with their sets, packed by bucket of the shingle; the order is rare to frequent, then by hash."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = shared.value
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        load = 0

        def out() -> Iterator[pa.RecordBatch]:
            every = np.concatenate([x for x, _, _ in held])
            owner = np.repeat(np.arange(len(held)), [len(x) for x, _, _ in held])
            place = np.concatenate([np.arange(len(x), dtype=np.int32) for x, _, _ in held])
            names, sizes = np.array([x for _, x, _ in held], np.int64), np.array([x for _, _, x in held], np.int64)
            held.clear()
            to = (every % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((every, to))
            heads = np.flatnonzero(np.concatenate(([True], np.diff(to[order]) != 0)))
            for a, b in zip(heads, np.append(heads[1:], len(order))):
                own = order[a:b]
                some, at = np.unique(owner[own], return_inverse=True)
                data = pack({"shingle": every[own], "at": at.astype(np.int32), "place": place[own], "node": names[some], "n": sizes[some]})
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([to[own[0]]], pa.int64()), pa.array([data], pa.binary())], ["kind", "bucket", "data"])

        for batch in batches:
            for _, own, name in sets_of(batch):
                if not name or name in seen:
                    continue
                seen.add(name)
                n = len(own)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                    rank = np.where(hashes[at] == own, ranks[at], 0)
                    if rank.any():
                        own = own[np.argsort(rank, kind="stable")]
                held.append((own[: prefix_length(n)].copy(), name, n))
                load += len(held[-1][0])
                if load > 2_000_000:
                    yield from out()
                    load = 0
        if held:
            yield from out()

    return docs.mapInArrow(run, BLOB)


def lists_in(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(list, node, n, weight, place) of one bucket's inverted lists of two nodes and more. Lists of the same nodes are one
    list, whose weight is the number of its shingles; place is the first place that one of them has in the node's set."""
    parts = [unpack(b) for b in blobs]
    every = {k: np.concatenate([p[k] for p in parts]) for k in ("shingle", "place")} | {k: np.concatenate([p[k][p["at"]] for p in parts]) for k in ("node", "n")}
    order = np.lexsort((every["node"], every["shingle"]))
    e = {k: v[order] for k, v in every.items()}
    keep = np.concatenate(([True], (e["shingle"][1:] != e["shingle"][:-1]) | (e["node"][1:] != e["node"][:-1])))
    e = {k: v[keep] for k, v in e.items()}
    head = np.flatnonzero(np.concatenate(([True], e["shingle"][1:] != e["shingle"][:-1])))
    count = np.diff(np.append(head, len(e["node"])))
    several = np.repeat(count > 1, count)
    e = {k: v[several] for k, v in e.items()}
    if not len(e["node"]):
        return
    count = count[count > 1]
    head = np.cumsum(count) - count
    with np.errstate(over="ignore"):
        mixed = (e["node"].view(np.uint64) ^ (e["node"].view(np.uint64) >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        name = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), head) * np.uint64(0x94D049BB133111EB) + count.astype(np.uint64)
    every = np.repeat(name, count)
    order = np.lexsort((e["place"], e["node"], every))
    every, e = every[order], {k: v[order] for k, v in e.items()}
    first = np.flatnonzero(np.concatenate(([True], (every[1:] != every[:-1]) | (e["node"][1:] != e["node"][:-1]))))
    weight = np.diff(np.append(first, len(every)))
    yield every[first].view(np.int64), e["node"][first], e["n"][first], weight, e["place"][first].astype(np.int64)


def t_occurrence(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """(id, how often) of all ids that occur in at least ``least`` of the sorted lists.

    DivideSkip: the longest lists are set aside, the short ones are merged by a heap that leaps over ids that cannot
    reach what the short lists must give, and what remains is probed for in the long ones by binary search.
    """
    lists = sorted(lists, key=len)
    if not lists or least > len(lists):
        return []
    aside = min(least - 1, int(least / (0.0085 * math.log2(len(lists[-1]) + 1) + 1)), len(lists) - 1)
    # of lists of one length any may be set aside; where all are short a merge of all is as cheap
    aside = min(aside, sum(len(x) > 8 for x in lists))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    want = least - aside
    heap = [(x[0], k) for k, x in enumerate(short)]
    heapq.heapify(heap)
    at = [0] * len(short)
    out = []
    while len(heap) >= want:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= want:
            n = len(popped)
            for k, x in enumerate(long):
                if n + len(long) - k < least:
                    break
                place = bisect_left(x, top)
                n += place < len(x) and x[place] == top
            if n >= least:
                out.append((top, n))
            to = top + 1
        else:
            while heap and len(popped) < want - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            to = heap[0][0]
        for k in popped:
            x = short[k]
            at[k] = bisect_left(x, to, at[k])
            if at[k] < len(x):
                heapq.heappush(heap, (x[at[k]], k))
    return out


def search(index: list[tuple[int, np.ndarray]], queries: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Similar (indexed, query) pairs by name; an indexed set is not similar to itself."""
    index = sorted(index, key=lambda x: len(x[1]))  # so that ids of similar sizes are neighbours
    inverted: dict[int, list[int]] = {}
    for i, (_, own) in enumerate(index):
        for s in own.tolist():
            inverted.setdefault(s, []).append(i)
    p, q = SIMILAR
    for name, own in queries:
        n = len(own)
        found = [x for x in map(inverted.get, own.tolist()) if x is not None]
        least = max(1, -(-p * n // q))
        if len(found) < least:
            continue
        for i, count in t_occurrence(found, least):
            other, its = index[i]
            if other != name and count >= needed(n, len(its)):
                yield other, name


def stars(links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the links connect, as one link for each name to the first of its group: fewer than there are names."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        if p != q:
            up[max(p, q)] = min(p, q)
    return [(root(x), x) for x in list(up) if root(x) != x]


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that connect what similar pairs connect, of the candidate ``pairs`` and of others that the search
    meets on its way.

    ``a`` is indexed and ``b`` asks. An index holds the ``a`` of about QUERIES queries; one that is asked more than
    SALTED times is indexed again for each further part of its queries. The sets are made again from the texts of the
    wanted nodes only, picked before the shuffle by bits of a hash of the id, of which there are 2**PICK_BITS at most.
    """
    total = pairs.count()
    if not total:
        return pairs.select("a", "b")
    indexes = max(1, total // QUERIES)
    asked = pairs.groupBy("a").agg(F.count("*").alias("asked")).withColumn("salts", F.ceil(F.col("asked") / SALTED).cast("int"))
    place = F.pmod(F.xxhash64("a"), F.lit(indexes)).alias("index")
    salted = pairs.join(asked, "a").select(place, F.pmod(F.xxhash64("b", F.lit(5)), "salts").cast("int").alias("salt"), F.lit(True).alias("asks"), F.col("b").alias("node"))
    held = asked.select(place, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("asks"), F.col("a").alias("node"))
    roles = materialize(salted.unionByName(held).distinct(), "jaccard-roles")
    wanted = roles.select("node").distinct().join(nodes, "node").select("doc")
    pick = lambda: F.shiftrightunsigned(F.xxhash64("doc"), 64 - PICK_BITS).alias("pick")
    picked = docs.select("doc", "text", pick()).join(F.broadcast(wanted.select(pick()).distinct()), "pick", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(name, own.tobytes()) for _, own, name in sets_of(batch) if name]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*found)) or ([], []), (pa.int64(), pa.binary()))], ["node", "elements"])

    made = picked.select("text").mapInArrow(run, "node long, elements binary")

    def meet(group: pa.Table) -> pa.Table:
        index, queries = {}, {}
        for asks, node, elements in zip(group["asks"].to_pylist(), group["node"].to_pylist(), group["elements"]):
            (queries if asks else index)[node] = np.frombuffer(elements.as_py(), np.uint64)
        found = stars(search(list(index.items()), list(queries.items())))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return roles.join(made, "node").groupBy("index", "salt").applyInArrow(meet, "a long, b long")


def asking(lists: DataFrame, salt: int) -> DataFrame:
    """(a, b): ``b`` asks for the pivot ``a`` that it shares most of the ``lists`` with, of those that may be similar.

    A list has a pivot for each range of sizes: a node of the largest ``part`` there, the first in an order that ``salt``
    changes (0: the smallest node). All nodes of other parts may ask for it.
    """
    p, q = SIMILAR
    order = F.xxhash64("node", F.lit(salt)) if salt else F.col("node")
    sized = lists.withColumn("range", F.floor(F.log(F.col("n")) / math.log(q / p)))
    by_part = sized.groupBy("list", "range", "part").agg(F.count("*").alias("size"), F.min(F.struct(order.alias("order"), "node", "n")).alias("p"))
    pivots = by_part.groupBy("list", "range").agg(F.min(F.struct((-F.col("size")).alias("size"), "part", "p")).alias("x"), F.count("*").alias("parts")).where("parts > 1")
    star = sized.join(pivots.select("list", "range", F.col("x.part").alias("main"), "x.p"), ["list", "range"]).where("part <> main")
    star = star.groupBy(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("p.node").alias("a"), F.col("p.n").alias("n_a")).agg(F.sum("weight").alias("shared"))
    star = star.where(F.col("shared") >= common_prefix())  # not all they share: what is left out here is tried later
    best = star.groupBy("b").agg(F.max(F.struct("shared", (-F.col("a")).alias("a"))).alias("x"))
    return best.select((-F.col("x.a")).alias("a"), "b")


def meetings(apart: DataFrame) -> DataFrame:
    """(list, a, b) for each two nodes of one list in different parts whose sizes, places and sketches allow a link."""
    p, q = SIMILAR
    side = lambda s: apart.select("list", F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "part", "place", *SKETCH)))
    fits = (q * F.least("n_a", "n_b") >= p * F.greatest("n_a", "n_b")) & (F.col("part_a") < F.col("part_b"))
    return side("a").join(side("b"), "list").where(fits & may_begin() & may_link()).select("list", "a", "b")


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``node``, ``part`` and ``text_hash`` for each row of ``docs``.

    Words are lower-cased (A-Z) and split at blanks; a document's set holds its distinct shingles of five words, or all
    its words as one if there are fewer. Rows link when 100 * overlap >= 75 * union of their sets; component_id is the
    smallest doc_id that links reach. node names the set: equal sets (similar, of course) have one name; 0 is the set of
    a text without words, null included, that links with nothing: its component is its own doc_id. part is the smallest
    node that links reach (null for 0), so it tells components apart where ids are null or repeated. Repeated rows and ids give a row each; a null id is left out of the smallest, and is null where there is no other. Shingles and sets
    are told apart by 64-bit hashes. Other columns are not read.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    described = materialize(describe(docs), "jaccard-described")
    sets = described.where("kind = 0").select("doc", "hash", "node", "n")
    often = most_frequent(described.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n")), FREQUENT).collect()
    hashes, counts = np.array([r.node for r in often], np.int64).view(np.uint64), np.array([r.n for r in often], np.int64)
    order = np.argsort(hashes)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(8, -(-total // BUCKET_BYTES))

    def listed(group: pa.Table) -> pa.Table:
        found = list(lists_in([b.as_py() for b in group["data"]]))
        columns = found[0] if found else (np.empty(0, np.int64),) * 5
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("list", "node", "n", "weight", "place"), columns)})

    packed = prefixes(docs, (hashes[order], counts[order]), buckets).groupBy("bucket").applyInArrow(listed, "list long, node long, n long, weight long, place long")
    lists = materialize(packed.groupBy("list", "node", "n").agg(F.sum("weight").alias("weight"), F.min("place").alias("place")), "jaccard-lists")
    nodes = sets.where("node <> 0").groupBy("node").agg(F.min("doc").alias("doc"))

    # Each node asks for the pivot that it shares most lists with. Where many of those that asked were linked, the others ask
    # again for another pivot: of a large group whose members are similar to most others, not to all, few nodes stay apart.
    links = tried = None
    apart = lists.withColumn("part", F.col("node"))
    while True:
        best = materialize(asking(apart, 0 if tried is None else tried.count()), "jaccard-best")
        tried = best if tried is None else tried.unionByName(best)
        found = materialize(verified(best, nodes, docs), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        parts = lists.join(components(links), lists["node"] == F.col("id"), "left").select("list", "node", "n", "weight", "place", F.coalesce("component", "node").alias("part"))
        parts = materialize(parts, "jaccard-parts")
        mixed = parts.groupBy("list").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("list")
        apart = parts.join(mixed, "list")
        if AGAIN * found.count() <= best.count():
            break

    # What is left: nodes of one list that are still apart and may link.
    sketches = described.where("kind = 0 and node <> 0").groupBy("node").agg(*(F.min(c).alias(c) for c in SKETCH))
    apart = materialize(apart.join(sketches, "node"), "jaccard-apart")
    rest = meetings(apart).select("a", "b").distinct()
    tried = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"), "jaccard-rest")
    every = links.unionByName(verified(rest, nodes, docs))

    found = nodes.join(components(every), nodes["node"] == F.col("id"), "left").select("node", "doc", F.coalesce("component", "node").alias("part"))
    found = materialize(found, "jaccard-found")
    real = F.when(F.col("doc") != NO_ID, F.col("doc"))
    names = found.join(sets.where("node <> 0").groupBy("node").agg(F.min(real).alias("real")), "node")
    names = names.select("node", "part", "real")
    least = names.groupBy("part").agg(F.min("real").alias("component_id"))
    named = names.join(least, "part").select("node", "part", "component_id")
    out = sets.join(named, "node", "left")
    return out.select(
        real.alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("node") == 0, real).otherwise(F.col("component_id")).alias("component_id"), "node", "part", F.col("hash").alias("text_hash")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (a null one is the largest), then of the
    smallest hash of the text, and one of rows that are equal in both. Texts without words all stay."""
    found = similar_documents(docs)
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.col("text_hash").alias("hash"))
    least = found.where("node <> 0").groupBy("part").agg(F.min(place).alias("least")).select(F.col("least.doc").alias("_doc"), F.col("least.hash").alias("_hash")).withColumn("_some", F.lit(True))
    empty = found.where("node = 0").select(place.alias("p")).select(F.col("p.doc").alias("_doc"), F.col("p.hash").alias("_hash")).distinct().withColumn("_some", F.lit(False))
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")]
    rows_in = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *key).join(least.unionByName(empty), ["_doc", "_hash"])
    first = F.row_number().over(Window.partitionBy("_doc", "_hash").orderBy("_doc"))
    return rows_in.withColumn("_number", first).where("not _some or _number = 1").select("_row.*")


#: The same by comparing all sets that share a shingle.
OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
elements AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM elements a JOIN elements b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, s.n AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id
FROM sizes s LEFT JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""


@query("op2_ngram_jaccard", OP2_SQL)
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
