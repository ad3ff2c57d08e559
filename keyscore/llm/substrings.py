"""Removal of long byte strings that an earlier document holds too, by suffix arrays of small groups.

Two equal strings of ``size`` bytes have the same least hash among their short grams, at the same place. So each text is
cut into stretches of windows with the same least gram (their anchor), overlapping by what a window needs. Only stretches
with one anchor can share a window: Spark groups them by it. Stretches that equal an earlier document's go as a whole;
where stretches of an anchor differ, a suffix array of them shows which windows they share.

Stretches travel as packed columns in binary rows, one row for each bucket that a task has something for, and a bucket's
size is bounded, for the number of buckets follows the bytes of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import chunks, flat_bytes, mix, query, table, texts
from keyscore.llm.suffixes import ragged, suffix_arrays
from keyscore.storage import materialize

#: Bytes of text for each bucket, and stretches that a task holds before it passes them on.
BUCKET_BYTES, HELD = 16 << 20, 1_000_000
#: Different stretches of an anchor from which on its windows are spread over several groups; see ``spread``.
MANY = 256
#: Bytes of suffix-array input that are worked on together.
BATCH = 1 << 20
NO_ID = -(1 << 63)
Arrays = dict[str, np.ndarray]


def pack(arrays: Arrays) -> bytes:
    """Columns as one binary: byte planes, compressed."""
    press, out = zstandard.ZstdCompressor(level=1), []
    for name, a in arrays.items():
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
        data = press.compress(planes)
        head = f"{name} {a.dtype.str} {len(a)} {len(data)}\n".encode()
        out += [head, data]
    return b"".join(out)


def unpack(data: bytes) -> Arrays:
    press, out, at = zstandard.ZstdDecompressor(), {}, 0
    while at < len(data):
        stop = data.index(b"\n", at)
        name, kind, n, size = data[at:stop].decode().split(" ")
        at = stop + 1 + int(size)
        kind = np.dtype(kind)
        planes = press.decompress(data[stop + 1 : at], max_output_size=max(int(n) * kind.itemsize, 1)) if int(n) else b""
        out[name] = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, int(n)).T).view(kind).reshape(-1) if int(n) else np.empty(0, kind)
    return out


def rows(keys: np.ndarray, arrays: Arrays, kind: int = 0, flat: tuple[str, str] | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(kind, key, packed columns) for each key. ``flat`` names a column of counts and one with so many values a row."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else []
    offsets = np.cumsum(arrays[flat[0]]) - arrays[flat[0]] if flat else None
    for a, b in zip(first, np.append(first[1:], len(ordered)) if len(first) else []):
        own = order[a:b]
        part = {k: v[own] for k, v in arrays.items() if not flat or k != flat[1]}
        if flat:
            part[flat[1]] = arrays[flat[1]][ragged(offsets[own], part[flat[0]].astype(np.int64))]
        yield kind, int(ordered[a]), pack(part)


def gather(blobs: list[bytes]) -> Arrays:
    parts = [unpack(b) for b in blobs]
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes, put together from runs of powers of two."""
    have, width = data.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    left = gram
    while left:
        if left & 1:
            if out is None:
                out, done = have, width
            else:
                n = len(data) - (done + width) + 1
                if n <= 0:
                    return np.empty(0, np.uint64)
                out = mix(out[:n] * np.uint64(0x9E3779B97F4A7C15) + have[done : done + n])
                done += width
        left >>= 1
        if left:
            n = len(data) - 2 * width + 1
            if n <= 0:
                return np.empty(0, np.uint64)
            have = mix(have[:n] * np.uint64(0xC2B2AE3D27D4EB4F) + have[width : width + n])
            width *= 2
    return out[: max(len(data) - gram + 1, 0)]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def stretches(data: np.ndarray, offsets: np.ndarray, size: int) -> Arrays:
    """Of each text: anchor, place, length, offset of the anchor's gram and a hash of the bytes, for its stretches."""
    gram = size * 2 // 5
    width = size - gram + 1
    row = np.flatnonzero(np.diff(offsets) >= size)
    empty = {"row": (), "pos": (), "len": (), "off": (), "anchor": (), "hash": ()}
    if not len(row):
        return {k: np.empty(0, np.uint64 if k in ("anchor", "hash") else np.int64) for k in empty}
    hashes = gram_hashes(data, gram)
    least = sliding_min(hashes, width)
    whole = gram_hashes(data, size)
    starts = ragged(offsets[row], offsets[row + 1] - offsets[row] - size + 1)
    new = np.ones(len(starts), bool)
    before = starts[1:] - 1
    new[1:] = (np.diff(starts) != 1) | (least[starts[1:]] != least[before]) | (hashes[before] == least[before])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    anchor = least[begin]
    off, todo = np.zeros(len(begin), np.int64), np.arange(len(begin))
    for k in range(width):
        todo = todo[hashes[begin[todo] + k] != anchor[todo]]
        if not len(todo):
            break
        off[todo] = k + 1
    of = np.searchsorted(offsets, begin, side="right") - 1
    text = mix(whole[begin] * np.uint64(0x9E3779B97F4A7C15) + whole[begin + count - 1] + count.astype(np.uint64))
    return {"row": of, "pos": begin - offsets[of], "len": count + size - 1, "off": off, "anchor": anchor, "hash": text}




def row_key(doc_id: int, text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text, doc_id & (1 << 64) - 1)


def cut(batches: Iterator[pa.RecordBatch], size: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """First step: stretches by bucket of their anchor (kind 0), and spans by bucket of their row (kind 1).

    Of equal stretches in a task only those of the smallest document go on; the others are spans at once.
    """
    held: list[Arrays] = []
    count = 0

    def flush() -> Iterator[tuple[int, int, bytes]]:
        every = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        order = np.argsort(every["hash"])  # equal stretches have equal anchors too
        every = {k: v[order] for k, v in every.items()}
        new = np.concatenate(([True], (every["hash"][1:] != every["hash"][:-1]) | (every["anchor"][1:] != every["anchor"][:-1])))
        head = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(every["doc"], head), np.diff(np.append(head, len(new))))
        owner = every["doc"] == least
        go = {k: v[owner] for k, v in every.items()}
        yield from rows((go["anchor"] % np.uint64(buckets)).astype(np.int64), narrow(go))
        gone = {k: every[k][~owner] for k in ("key", "pos", "len")}
        yield from rows((gone["key"] % np.uint64(buckets)).astype(np.int64), narrow(gone), 1)
        held.clear()

    for batch in batches:
        for start, stop in chunks(batch.column("text"), 1 << 20):
            part = batch.slice(start, stop - start)
            data, offsets = flat_bytes(part.column("text"))
            ids = np.array([NO_ID if i is None else i for i in part.column("doc_id").to_pylist()], np.int64)
            keys = np.array([row_key(int(i), data[a:b].tobytes()) for i, a, b in zip(ids, offsets[:-1], offsets[1:])], np.uint64)
            found = stretches(data, offsets, size)
            of = found.pop("row")
            held.append(found | {"doc": ids[of], "key": keys[of]})
            count += len(of)
            if count >= HELD:
                yield from flush()
                count = 0
    if count:
        yield from flush()


def narrow(arrays: Arrays) -> Arrays:
    small = {"pos": np.int32, "len": np.int32, "off": np.uint8}
    return {k: v.astype(small[k]) if k in small and (k != "pos" or not len(v) or v.max() < 1 << 31) else v for k, v in arrays.items()}


def compare(every: Arrays, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Second step, for all stretches of a bucket: spans (kind 1), and requests for bytes (kind 2) by bucket of the row.

    A request stands for one stretch of which an anchor has several, in its smallest document, with all places there.
    """
    order = np.lexsort((every["doc"], every["hash"], every["anchor"]))
    e = {k: v[order] for k, v in every.items()}
    fresh = np.concatenate(([True], e["anchor"][1:] != e["anchor"][:-1]))
    new = fresh | np.concatenate(([True], e["hash"][1:] != e["hash"][:-1]))
    group, kind = np.cumsum(fresh) - 1, np.cumsum(new) - 1
    groups = np.flatnonzero(fresh)
    several = np.minimum.reduceat(e["doc"], groups) != np.maximum.reduceat(e["doc"], groups)
    kinds = np.bincount(group[new])
    owner = e["doc"] == e["doc"][np.flatnonzero(new)][kind]
    gone = {k: e[k][~owner] for k in ("key", "pos", "len")}
    yield from rows((gone["key"] % np.uint64(buckets)).astype(np.int64), narrow(gone), 1)
    asked = owner & several[group] & (kinds[group] > 1)
    if not asked.any():
        return
    a = {k: v[asked] for k, v in e.items()} | {"many": (kinds[group[asked]] > MANY), "kind": kind[asked]}
    order = np.lexsort((a["pos"], a["key"], a["kind"]))
    a = {k: v[order] for k, v in a.items()}
    head = np.flatnonzero(np.concatenate(([True], (a["kind"][1:] != a["kind"][:-1]) | (a["key"][1:] != a["key"][:-1]))))
    request = {k: a[k][head] for k in ("anchor", "doc", "key", "len", "off", "many")}
    request["places"] = np.diff(np.append(head, len(a["kind"]))).astype(np.int32)
    request["pos"] = a["pos"]
    yield from rows((request["key"] % np.uint64(buckets)).astype(np.int64), request, 2, ("places", "pos"))


def spread(content: bytes, off: int, gram: int, rest: int) -> Iterator[tuple[int, bytes, bytes]]:
    """A stretch as five of fewer windows each, with what all of a part's windows hold beside the anchor.

    An anchor at the edge of a passage that many documents share has as many stretches as documents. Windows with eight
    bytes or more on either side of the anchor can only be equal if those are; the others are told apart by the
    three bytes or more on their short side and the many on their long one; of the last the short side has two bytes.
    """
    end = off + gram
    for left, right in ((rest - 8, rest - 8), (7, rest - 3), (2, rest), (rest - 3, 7), (rest, 2)):
        a, b = max(0, off - left), min(len(content), end + right)
        if b - a >= gram + rest:
            low, high = rest - right, rest - left
            yield a, content[a:b], b"%d|%s|%s" % (left, content[off - low : off], content[end : end + high])


def fetch(documents: dict[int, bytes], requests: Arrays, size: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Third step: the bytes that requests ask for, by group of stretches, for all rows of a bucket."""
    gram = size * 2 // 5
    first = np.cumsum(requests["places"]) - requests["places"]
    names = ("group", "doc", "key", "shift", "size", "places")
    out: dict[str, list] = {k: [] for k in names}
    texts_out, positions = [], []
    for i in range(len(first)):
        places = requests["pos"][first[i] : first[i] + requests["places"][i]].astype(np.int64)
        content = documents[int(requests["key"][i])][places[0] : places[0] + requests["len"][i]]
        anchor = int(requests["anchor"][i])
        if requests["many"][i]:
            parts = [(a, x, xxhash.xxh3_64_intdigest(key, anchor)) for a, x, key in spread(content, int(requests["off"][i]), gram, size - gram)]
        else:
            parts = [(0, content, anchor)]
        for a, x, group in parts:
            for name, value in zip(names, (group, requests["doc"][i], requests["key"][i], a, len(x), len(places))):
                out[name].append(value)
            texts_out.append(x)
            positions.append(places)
    if not texts_out:
        return
    kinds = (np.uint64, np.int64, np.uint64, np.int32, np.int32, np.int32)
    arrays = {k: np.array(out[k], kind) for k, kind in zip(names, kinds)}
    to = (arrays["group"] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], np.diff(to[order]) != 0)))
    for a, b in zip(heads, np.append(heads[1:], len(order))):
        own = order[a:b]
        part = {k: v[own] for k, v in arrays.items()}
        part["pos"] = np.concatenate([positions[i] for i in own])
        part["bytes"] = np.frombuffer(b"".join([texts_out[i] for i in own]), np.uint8)
        yield 0, int(to[own[0]]), pack(part)


def shared_windows(codes: np.ndarray, begin: np.ndarray, length: np.ndarray, group: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, smallest document that has the window) for each window of strings sorted by group.

    Each group's strings make one text, with a code between them that no byte has; in its suffix array equal windows
    are neighbours.
    """
    n = len(begin)
    head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    to = np.cumsum(length + 1) - (length + 1)
    total = int(length.sum()) + n
    text, string = np.zeros(total, np.int64), np.repeat(np.arange(n), length + 1)
    text[ragged(to, length)] = codes[ragged(begin, length)].astype(np.int64) + 1
    sa = suffix_arrays(text, np.append(to[head], total))
    left = (to + length)[string[sa]] - sa
    sa = sa[left >= size]
    which = string[sa]
    same = np.zeros(len(sa), bool)
    if len(sa):
        same[1:] = group[which[1:]] == group[which[:-1]]
        for k in range(size):
            todo = np.flatnonzero(same)
            same[todo] = text[sa[todo] + k] == text[sa[todo - 1] + k]
        runs = np.flatnonzero(~same)
        least = np.repeat(np.minimum.reduceat(doc[which], runs), np.diff(np.append(runs, len(sa))))
    else:
        least = np.empty(0, np.int64)
    return which, sa - to[which], least


def resolve(every: Arrays, size: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Fourth step, for all strings of a bucket's groups: the spans (kind 1) that earlier documents have too."""
    first = np.cumsum(every["size"].astype(np.int64)) - every["size"]
    place = np.cumsum(every["places"].astype(np.int64)) - every["places"]
    data = every["bytes"].tobytes()
    content = np.array([xxhash.xxh3_64_intdigest(data[a : a + n]) for a, n in zip(first, every["size"])], np.uint64)
    order = np.lexsort((every["doc"], content, every["group"]))
    group, doc = every["group"][order], every["doc"][order]
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (content[order][1:] != content[order][:-1])))
    distinct = np.flatnonzero(new)  # the smallest document of each different string
    member = np.cumsum(new) - 1
    groups = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    several = np.repeat(np.minimum.reduceat(doc, groups) != np.maximum.reduceat(doc, groups), np.diff(np.append(groups, len(group))))
    useful = distinct[several[distinct]]
    sizes = every["size"][order][useful].astype(np.int64)
    spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    limits = np.flatnonzero(np.concatenate(([True], group[useful][1:] != group[useful][:-1]))) if len(useful) else []
    # Groups of similar size go together: the steps of a batch are those of its largest group.
    weight = np.add.reduceat(sizes, limits) if len(useful) else np.empty(0, np.int64)
    by_size = np.argsort(weight, kind="stable")
    ends = np.append(limits[1:], len(useful)) if len(useful) else []
    at = 0
    while at < len(by_size):
        stop, load = at, 0
        while stop < len(by_size) and (stop == at or load + weight[by_size[stop]] <= BATCH and weight[by_size[stop]] <= 4 * weight[by_size[at]] + 256):
            load += weight[by_size[stop]]
            stop += 1
        own = np.concatenate([np.arange(limits[g], ends[g]) for g in by_size[at:stop]])
        at = stop
        chosen = useful[own]
        which, offset, least = shared_windows(np.frombuffer(data, np.uint8), first[order][chosen], sizes[own], group[chosen], doc[chosen], size)
        # every member of a string has its windows
        by = np.argsort(which, kind="stable")
        which, offset, least = which[by], offset[by], least[by]
        windows = np.bincount(which, minlength=len(chosen))
        start = np.cumsum(windows) - windows
        low = np.searchsorted(member, member[chosen])
        copies = np.searchsorted(member, member[chosen], side="right") - low
        members = ragged(low, copies)
        string = np.repeat(np.arange(len(chosen)), copies)
        w = ragged(start[string], windows[string])
        m = np.repeat(members, windows[string])
        hit = least[w] < doc[m]
        m, o = m[hit], offset[w[hit]]
        if len(m):
            by = np.argsort(m, kind="stable")
            m, o = m[by], o[by]
            head = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
            spans.append((order[m[head]], np.minimum.reduceat(o, head), np.maximum.reduceat(o, head)))
    if not spans:
        return
    of, low, high = (np.concatenate(x) for x in zip(*spans))
    count = every["places"][of].astype(np.int64)
    expand = np.repeat(np.arange(len(of)), count)
    gone = {
        "key": every["key"][of][expand],
        "pos": every["pos"][ragged(place[of], count)] + every["shift"][of][expand] + low[expand],
        "len": (high - low + size)[expand],
    }
    yield from rows((gone["key"] % np.uint64(buckets)).astype(np.int64), narrow(gone), 1)


SCHEMA = "kind int, bucket long, data binary"


def batch_of(found: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for kind, bucket, data in found:
        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int64()), pa.array([data], pa.binary())], ["kind", "bucket", "data"])


def table_of(found: Iterator[tuple[int, int, bytes]]) -> pa.Table:
    kinds, buckets, data = [], [], []
    for k, b, d in found:
        kinds.append(k)
        buckets.append(b)
        data.append(d)
    return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(buckets, pa.int64()), "data": pa.array(data, pa.binary())})


def documents_by_bucket(docs: DataFrame, buckets: int) -> DataFrame:
    """Texts packed by bucket of their row's key: about 1 MB of them, or one text, in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(bucket: int) -> tuple[int, int, bytes]:
            rows_in = held.pop(bucket)
            ids, null = np.array([i or 0 for i, _, _ in rows_in], np.int64), np.array([i is None for i, _, _ in rows_in])
            arrays = {"doc": ids, "null": null, "key": np.array([k for _, k, _ in rows_in], np.uint64), "size": np.array([len(t) for _, _, t in rows_in], np.int64)}
            return 0, bucket, pack(arrays | {"bytes": np.frombuffer(b"".join([t for _, _, t in rows_in]), np.uint8)})

        def every() -> Iterator[tuple[int, int, bytes]]:
            load: dict[int, int] = {}
            for batch in batches:
                for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    text = t.as_py().encode()
                    key = row_key(NO_ID if i is None else i, text)
                    bucket = key % buckets
                    held.setdefault(bucket, []).append((i, key, text))
                    load[bucket] = load.get(bucket, 0) + len(text)
                    if load[bucket] >= 1 << 20:
                        load[bucket] = 0
                        yield out(bucket)
            for bucket in list(held):
                yield out(bucket)

        yield from batch_of(every())

    return docs.mapInArrow(run, SCHEMA)


def documents_in(blobs: pa.ChunkedArray) -> Iterator[tuple[int | None, int, bytes]]:
    for blob in blobs:
        a = unpack(blob.as_py())
        data, ends = a["bytes"].tobytes(), np.cumsum(a["size"])
        for i, null, key, start, end in zip(a["doc"].tolist(), a["null"].tolist(), a["key"].tolist(), (ends - a["size"]).tolist(), ends.tolist()):
            yield None if null else i, key, data[start:end]


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """``doc_id``, ``removed`` (array of (start, end), the maximal removed runs of bytes) and ``kept`` (binary).

    Removed is each byte under a string of ``size`` bytes that also starts in a document with a smaller doc_id; overlaps
    count, and all is judged on the input. Strings do not cross documents. A null text is empty. A null id is smaller
    than all others. Rows that share an id are one document in this: none is smaller than the other; each gives a row
    of its own. Other columns are not read.
    """
    if size < 40:
        raise ValueError("strings under 40 bytes leave too short a gram")
    docs = texts(docs)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(8, -(-total // BUCKET_BYTES))

    def by_bucket(source: DataFrame, step: Callable[[Arrays], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
        def run(group: pa.Table) -> pa.Table:
            return table_of(step(gather([b.as_py() for b in group["data"]])))

        return source.groupBy("bucket").applyInArrow(run, SCHEMA)

    first = docs.mapInArrow(lambda batches: batch_of(cut(batches, size, buckets)), SCHEMA)

    def second(group: pa.Table) -> pa.Table:
        kinds = group["kind"].to_pylist()
        blobs = [b.as_py() for b in group["data"]]
        found = [(1, group["bucket"][0].as_py(), b) for k, b in zip(kinds, blobs) if k == 1]
        mine = gather([b for k, b in zip(kinds, blobs) if k == 0])
        return table_of(iter([*found, *(compare(mine, buckets) if mine else ())]))

    judged = materialize(first.groupBy("bucket").applyInArrow(second, SCHEMA), "substrings-judged")

    def third(texts_in: pa.Table, asked: pa.Table) -> pa.Table:
        documents = {k: t for _, k, t in documents_in(texts_in["data"])}
        return table_of(fetch(documents, gather([b.as_py() for b in asked["data"]]), size, buckets) if len(asked) else iter(()))

    packed_docs = documents_by_bucket(docs, buckets)
    strings = packed_docs.groupBy("bucket").cogroup(judged.where("kind = 2").groupBy("bucket")).applyInArrow(third, SCHEMA)
    resolved = by_bucket(strings, lambda every: resolve(every, size, buckets))
    spans = judged.where("kind = 1").unionByName(resolved)

    def last(texts_in: pa.Table, gone: pa.Table) -> pa.Table:
        every = gather([b.as_py() for b in gone["data"]]) if len(gone) else {}
        own: dict[int, tuple[int, int]] = {}
        if every:
            order = np.lexsort((every["pos"], every["key"]))
            keys, pos = every["key"][order], every["pos"][order].astype(np.int64)
            ends = pos + every["len"][order]
            head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            own = {int(keys[a]): (a, b) for a, b in zip(head, np.append(head[1:], len(keys)))}
        ids, kept, removed = [], [], []
        for i, key, text in documents_in(texts_in["data"]):
            runs: list[tuple[int, int]] = []
            if key in own:
                a, b = own[key]
                reach = np.maximum.accumulate(ends[a:b])
                start = np.concatenate(([True], pos[a + 1 : b] > reach[:-1]))
                runs = list(zip(pos[a:b][start].tolist(), reach[np.append(np.flatnonzero(start)[1:] - 1, b - a - 1)].tolist()))
            parts, done = [], 0
            for x, y in runs:
                parts.append(text[done:x])
                done = y
            ids.append(i)
            kept.append(b"".join([*parts, text[done:]]))
            removed.append([{"start": x, "end": y} for x, y in runs])
        run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "removed": pa.array(removed, run), "kept": pa.array(kept, pa.binary())})

    return packed_docs.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(last, "doc_id long, removed array<struct<start:long,end:long>>, kept binary")


#: The same by grouping all windows of 50 bytes.
OP4_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS i FROM docs WHERE length(h) >= 100)),
least_doc AS (SELECT w, min(doc_id) AS d FROM windows GROUP BY w),
found AS (SELECT doc_id, i FROM windows JOIN least_doc USING (w) WHERE d < doc_id),
edges AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS fresh FROM found),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM
  (SELECT doc_id, i, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges) GROUP BY doc_id, run),
ends AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS done FROM runs),
pieces AS (SELECT e.doc_id, a, substr(h, 2 * done + 1, 2 * (a - done)) AS piece FROM ends e JOIN docs USING (doc_id)),
kept AS (
  SELECT d.doc_id, coalesce(p.head, '') || substr(h, 2 * coalesce(r.b, 0) + 1) AS k, coalesce(r.removed, 0) AS removed, coalesce(r.n, 0) AS n, length(h) // 2 AS size
  FROM docs d LEFT JOIN (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS head FROM pieces GROUP BY doc_id) p ON p.doc_id = d.doc_id
  LEFT JOIN (SELECT doc_id, max(b) AS b, sum(b - a) AS removed, count(*) AS n FROM runs GROUP BY doc_id) r ON r.doc_id = d.doc_id)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM kept
"""


@query("op4_repeated_substrings", OP4_SQL)
def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return out.select(
        "doc_id",
        (F.octet_length("kept") + n_removed).cast("long").alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
