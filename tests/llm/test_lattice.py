import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from keyscore.llm import lattice


@pytest.fixture(scope="module")
def model():
    return open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def brute(net, word):
    """Sum over all segmentations by plain recursion, and the expected pieces."""
    weight = dict(zip(net.names[: net.pieces], np.exp(net.log_weights)))

    def ways(rest):
        if not rest:
            return [(1.0, ())]
        out = []
        heads = [rest[:k] for k in range(1, len(rest) + 1) if rest[:k] in weight]
        for head in heads:
            out += [(weight[head] * p, (head, *s)) for p, s in ways(rest[len(head) :])]
        if rest[0] not in weight:
            names = [f"<0x{b:02X}>" for b in rest[0].encode()]
            p0 = math.prod(math.exp(net.log_weights[net.names.index(n)]) for n in names)
            out += [(p0 * p, (*names, *s)) for p, s in ways(rest[1:])]
        return out

    return ways(word)


def test_sums_and_expectations_over_all_segmentations(model):
    net = lattice.Lattice(model)
    words = ["the", "ation", "é", "漢字x", "straße", "a", "🙂🙂", "xqzj", "#1%"]
    marked = [lattice.MARK + w for w in words]
    got = net.word_scores([w.encode() for w in words])
    for m, score in zip(marked, got):
        assert np.isclose(score, math.log10(sum(p for p, _ in brute(net, m))))
    counts = np.arange(1.0, len(words) + 1)
    want: Counter = Counter()
    for m, n in zip(marked, counts):
        segmentations = brute(net, m)
        total = sum(p for p, _ in segmentations)
        for p, s in segmentations:
            for piece in s:
                want[piece] += n * p / total
    found = net.expected(marked, counts)
    assert np.allclose(found, [want[x] for x in net.names], atol=1e-9)
    assert np.isclose(np.exp(net.log_weights).sum(), 1)


def test_long_word(model):
    net = lattice.Lattice(model)
    assert net.word_scores([b"ab" * 3000, b"x"])[0] < -1000


def reference(rows, train):
    counts: Counter = Counter()
    for t in train:
        counts.update(lattice.words_of(t or ""))
        counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for t in rows:
        tokens = [*lattice.words_of(t or ""), b""]
        out.append((len(tokens), sum(counts[w] > 0 for w in tokens), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    return n, out


def test_edge_rows_and_joined_counts(spark):
    data = [(1, "The the cat", 1), (1, "The the cat", 1), (None, None, 2), (3, "", 3), (4, "dog\x1cx É é", 4)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n long")
    for frequent in (0, 1, 100):
        got = lattice.score_texts(docs, docs, frequent=frequent).collect()
        n, want = reference([t for _, t, _ in data], [t for _, t, _ in data])
        assert all(r.train_tokens == n for r in got)
        assert sorted((r.n_tokens, r.n_known, round(r.base_score, 9)) for r in got) == sorted((a, b, round(c, 9)) for a, b, c in want)
        assert all(r.score <= 0 for r in got)
    assert lattice.score_texts(docs.limit(0), docs).count() == 0
    assert lattice.score_texts(docs, docs.limit(0)).count() == 5


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    n, want = reference([t for _, t in docs], [t for d, t in docs if not held[d]])
    want = {d: w for (d, _), w in zip(docs, want)}
    rows = lattice.op6_lattice_lm(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == held[r.doc_id] and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2]
        assert np.isclose(r.base_score, want[r.doc_id][2], rtol=1e-9)
    # Learned weights suit texts that were held out better than the vocabulary's own.
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = {r.doc_id: r.score for r in lattice.score_texts(table, table.limit(0)).collect()}
    assert sum(r.score for r in rows if r.held_out) > sum(plain[r.doc_id] for r in rows if r.held_out)


def test_equal_rare_words_are_scored_where_they_meet(spark, model):
    texts = ["the cat and the zyzzyva", "a zyzzyva zyzzyva", "", None, "qoph é 漢字x", "cat"]
    docs = spark.createDataFrame([(d, t) for d, t in enumerate(texts * 5)], "doc_id long, text string").repartition(7)
    train = docs.where("doc_id % 6 <> 4")
    log_weights, log_end = lattice.train_pieces(lattice.count_words(train), model)
    net = lattice.Lattice(model, np.frombuffer(log_weights))
    want = [log_end + sum(net.word_scores([w])[0] for w in lattice.words_of(t or "")) for t in texts]
    for frequent in (0, 2, 100):
        scored = lattice.score_texts(docs, train, frequent=frequent)
        got = {r.doc_id: r.score for r in scored.collect()}
        assert np.allclose([got[d] for d in range(30)], want * 5, rtol=1e-9)
    # the sums over segmentations are taken behind the join, not once more for each text or task
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("SortMergeJoin") < plan.rindex("MapInArrow")
