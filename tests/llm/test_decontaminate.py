import random

import numpy as np
import pytest

from keyscore.llm import decontaminate as dec

LEAKS = "doc_id long, text string, leaks int"
ITEMS = "item_id long, text string, share double"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_words_against_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 30))] for _ in range(2))
        assert dec.common_words(a, b) == plain_lcs(a, b)


def words(rng, n):
    return ["w%d" % int(rng.expovariate(1 / 200)) for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    items = {i: words(rng, rng.randint(12, 90)) for i in range(60)}
    docs, want = [], {}
    for d in range(400):
        text = words(rng, rng.randint(0, 500))
        if d % 4 == 0:
            i = rng.randrange(60)
            part = list(items[i])
            if d % 8 == 0:  # a paraphrase: some words replaced, but not the answer's
                for k in rng.sample(range(max(len(part) - 8, 1)), len(part) // 5):
                    part[k] = "other%d" % rng.randint(0, 999)
            at = rng.randint(0, len(text))
            text[at:at] = part
            want[d] = i
        docs.append((d, " ".join(text), 0))
    return items, docs, want


@pytest.mark.parametrize("at_once", [1000, 25])
def test_finds_copies_and_paraphrases(spark, planted, at_once):
    items, docs, want = planted
    benchmark = spark.createDataFrame([(i, " ".join(w), 0.0) for i, w in items.items()], ITEMS)
    rows = dec.find_leaks(spark.createDataFrame(docs, LEAKS), benchmark, at_once=at_once).collect()
    got = {(r.doc_id, x.item_id) for r in rows for x in r.leaks}
    assert len(rows) == len(docs)
    recall = np.mean([(d, i) in got for d, i in want.items()])
    assert recall >= 0.95
    assert all((d, i) in got for d, i in want.items() if d % 8)  # copies
    texts = {d: t.split() for d, t, _ in docs}
    for d, i in got:
        assert plain_lcs(items[i], texts[d]) >= 0.5 * len(items[i])
    assert len(got - set(want.items())) <= 2


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", 0), (1, "one two three four five six", 0), (None, None, 0), (2, "", 0), (3, "one two five", 0)], LEAKS)
    benchmark = spark.createDataFrame([(7, "three FOUR five", 0.0), (8, None, 0.0), (9, " ", 0.0), (None, "one", 0.0), (7, "three FOUR five", 0.0)], ITEMS)
    got = sorted((r.doc_id or -1, [x.item_id for x in r.leaks]) for r in dec.find_leaks(docs, benchmark).collect())
    assert got == [(-1, []), (1, [7, 7]), (1, [7, 7]), (2, []), (3, [])]
    assert dec.find_leaks(docs.limit(0), benchmark).count() == 0
    assert [r.leaks for r in dec.find_leaks(docs, benchmark.limit(0)).collect()] == [[]] * 5


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text.lower().encode().split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text.lower().encode().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    rows = dec.op10_benchmark_leaks(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    got = {(r.doc_id, int(i)) for r in rows for i in r["items"].split(",") if i}
    held = {(d, i) for d, w in docs.items() for i, item in items.items() if any(w[k : k + len(item)] == item for k in range(len(w)))}
    assert held and held <= got
    assert all(r.contaminated == bool(r["items"]) for r in rows)
    for d, i in got - held:
        assert plain_lcs(items[i], docs[d]) >= 0.5 * len(items[i])


def test_short_items_among_benchmark_words(spark):
    rng = random.Random(6)
    some = lambda n: ["w%d" % rng.randrange(150) for _ in range(n)]
    items = {i: some(5 + i % 11) for i in range(80)}
    docs, held = [], set()
    for d in range(160):
        text, part = some(rng.randint(0, 160)), list(items[d % 80])
        if d >= 80 and len(part) >= 8:  # still three quarters in order
            part[0] = "other"
        at = rng.randint(0, len(text))
        docs.append((d, " ".join(text[:at] + part + text[at:]), 0))
    benchmark = spark.createDataFrame([(i, " ".join(w), 0.0) for i, w in items.items()], ITEMS)
    got = {(r.doc_id, x.item_id) for r in dec.find_leaks(spark.createDataFrame(docs, LEAKS), benchmark).collect() for x in r.leaks}
    for d, text, _ in docs:
        w = text.split()
        for i, item in items.items():
            m = len(item)
            for s in range(max(len(w) - m + 1, 1)):
                part = w[s : s + m]
                if len(set(part) & set(item)) >= m / 4 and (share := plain_lcs(item, part) / m) >= 0.5:
                    last = item[-min(m, dec.ANSWER) :]
                    if share == 1 or m >= 8 and (share >= 0.75 or plain_lcs(last, part) >= 0.75 * len(last)):
                        held.add((d, i))
                        break
    assert len(held) >= 150 and held <= got


def test_latent_space_is_fitted_to_all_passages(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join("w%d" % k for k in range(6 * i, 6 * i + 6))) for i in range(4)]
    docs = [(d, " ".join("w%d" % rng.choice((rng.randrange(24), rng.randrange(60))) for _ in range(rng.randint(0, 200))), 0) for d in range(1500)]
    count, fit, seen = dec.passage_counts, dec.latent_space, []

    def counted(tokens, size):  # as of a table a thousand times as large
        n, df = count(tokens, size)
        return 1000 * n, 1000 * df

    def fitted(tokens, items, weights, *more):
        seen.append((items, weights, fit(tokens, items, weights, *more)))
        return seen[0][2]

    monkeypatch.setattr(dec, "passage_counts", counted)
    monkeypatch.setattr(dec, "latent_space", fitted)
    dec.find_leaks(spark.createDataFrame(docs, LEAKS), spark.createDataFrame([(i, t, 0.0) for i, t in items], ITEMS))
    its, weights, space = seen[0]

    def gram(texts):
        total = np.zeros((len(weights), len(weights)))
        for ids in texts:
            for at in range(0, len(ids), dec.PASSAGE):
                part = ids[at : at + dec.PASSAGE]
                row = np.bincount(part[part >= 0], minlength=len(weights)) * weights
                total += np.outer(row, row)
        return total

    omega = dec.projection(len(weights), len(weights)).astype(float)
    whole = gram([its.find(w) for w in dec.hashes_of([t for _, t, _ in docs])])
    own = gram(its.part_ids)
    whole += own * max(1.0, np.abs(whole @ omega).sum() / np.abs(own @ omega).sum())
    want = np.linalg.eigh(whole)[1][:, ::-1]
    assert space.shape == want.shape
    assert (np.abs((space[:, :3] * want[:, :3]).sum(axis=0)) > 0.9999).all()
    # the variance along the fitted vectors is that of all passages
    assert np.allclose(np.sort(np.diag(space.T @ whole @ space))[-3:], np.linalg.eigvalsh(whole)[-3:], rtol=1e-4)


def test_passage_counts(spark):
    rng = random.Random(9)
    texts = [np.array([rng.randrange(-1, 9) for _ in range(rng.choice((0, 1, 63, 64, 65, 200)))], np.int32) for _ in range(50)]
    tokens = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "ids binary")
    passages = [set(t[at : at + dec.PASSAGE].tolist()) - {-1} for t in texts for at in range(0, len(t), dec.PASSAGE)]
    n, df = dec.passage_counts(tokens, 9)
    assert n == len(passages) and df.tolist() == [sum(k in p for p in passages) for k in range(9)]
