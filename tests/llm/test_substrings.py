import hashlib
import random

import numpy as np
import pytest

from keyscore.llm import substrings, suffixes


def test_suffix_arrays_against_sorting():
    rng = random.Random(1)
    for _ in range(300):
        texts = [bytes(rng.choice(rng.choice([b"ab", b"abc", b"a", b"the cat", b"\xff\x00"])) for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(1, 6))]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        got = suffixes.suffix_arrays(np.frombuffer(b"".join(texts), np.uint8), offsets)
        for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
            assert (got[a:b] - a).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_lyndon_prefixes():
    rng = random.Random(2)
    for n in range(1, 40):
        t = bytes(rng.choice(b"ab ") for _ in range(n))
        _, length = suffixes.lyndon_groups(np.frombuffer(t, np.uint8).astype(np.int64), np.array([0, n]))
        assert length.tolist() == [next((j - i for j in range(i + 1, n + 1) if t[j:] < t[i:]), n - i) for i in range(n)]


def brute(docs, size=50):
    """(n_bytes, n_removed, n_spans, kept) of each (doc_id, text) in the given order."""
    least = {}
    data = [(substrings.NO_ID if d is None else d, (t or "").encode()) for d, t in docs]
    for d, t in data:
        for i in range(len(t) - size + 1):
            w = t[i : i + size]
            least[w] = min(least.get(w, d), d)
    out = []
    for d, t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - size + 1):
            if least[t[i : i + size]] < d:
                gone[i : i + size] = True
        starts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((len(t), int(gone.sum()), starts, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def check(spark, docs):
    got = substrings.remove_repeats(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, removed int")).collect()
    mine = sorted((r.doc_id if r.doc_id is not None else substrings.NO_ID, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept)) for r in got)
    want = sorted((d if d is not None else substrings.NO_ID, *w[1:]) for (d, _), w in zip(docs, brute(docs)))
    assert mine == want


def made(rng, n, alphabet="abcdefghij é漢"):
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(30, 200))) for _ in range(12)]
    docs = []
    for d in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            text = rng.choice(passages)
            if rng.random() < 0.5:
                k = rng.randrange(len(text))
                text = text[:k] + rng.choice(alphabet) + text[k + 1 :]
            parts += [text[rng.randint(0, 20) :], "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))]
        docs.append((d, "".join(parts)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("many", [256, 1])
def test_same_as_all_windows(spark, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    rng = random.Random(many)
    docs = made(rng, 60) + [(d, "The " * rng.randint(5, 60)) for d in range(60, 70)] + [(d, "a" * rng.randint(40, 90)) for d in range(70, 80)]
    if many == 1:  # workers import their own module
        data = [(d, t.encode()) for d, t in docs]
        for size in (50,):
            blobs = run_locally(data, size)
            want = {d: w[1] for (d, _), w in zip(docs, brute(docs))}
            assert blobs == want
    else:
        check(spark, docs)


def run_locally(data, size, buckets=3):
    """The steps without Spark; bytes removed by document."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in data], pa.int64()), pa.array([t.decode() for _, t in data])], ["doc_id", "text"])
    keys = {substrings.row_key(d, t): (d, t) for d, t in data}
    found = list(substrings.cut(iter([batch]), size, buckets))
    spans = [b for k, _, b in found if k == 1]
    for bucket in range(buckets):
        mine = substrings.gather([b for k, x, b in found if k == 0 and x == bucket])
        judged = list(substrings.compare(mine, buckets)) if mine else []
        spans += [b for k, _, b in judged if k == 1]
        for k, _, b in judged:
            if k == 2:
                for _, _, strings in substrings.fetch({k: t for k, (_, t) in keys.items()}, substrings.unpack(b), size, 1):
                    pending.append(strings)
    spans += [b for _, _, b in substrings.resolve(substrings.gather(pending), size, 1)] if pending else []
    pending.clear()
    out = {d: np.zeros(len(t), bool) for d, t in data}
    for blob in spans:
        a = substrings.unpack(blob)
        for key, pos, n in zip(a["key"].tolist(), a["pos"].tolist(), a["len"].tolist()):
            out[keys[key][0]][pos : pos + n] = True
    return {d: int(g.sum()) for d, g in out.items()}


pending: list = []


def test_edge_rows(spark):
    text = "0123456789" * 6
    check(spark, [(1, text), (1, text), (1, text + "x"), (2, text), (None, text[5:]), (3, None), (4, ""), (5, "short"), (6, "é" * 30)])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(empty).count() == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {d: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for (d, _), (n, gone, spans, kept) in zip(docs, brute(docs))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.op4_repeated_substrings(spark, sf_dir).collect()}
    assert got == want
