import random
from collections import Counter

import numpy as np

from keyscore.llm import jaccard


def brute(rows):
    """(doc_id, n, component) of each (doc_id, text) by comparing all sets with all."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        count = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in count.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def check(spark, rows):
    out = jaccard.similar_documents(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str) == brute(rows)


def test_t_occurrence_against_counting():
    rng = random.Random(1)
    for _ in range(500):
        lists = [sorted(rng.sample(range(30), rng.randint(1, 30))) for _ in range(rng.randint(1, 14))]
        least = rng.randint(1, 12)
        count = Counter(i for x in lists for i in x)
        assert sorted(jaccard.t_occurrence(lists, least)) == sorted((i, n) for i, n in count.items() if n >= least)


def test_prefix_and_overlap_bounds():
    for a in range(1, 60):
        assert jaccard.prefix_length(a) == a - -(-3 * a // 4) + 1
        for b in range(1, 60):
            need = jaccard.needed(a, b)
            assert 100 * need >= 75 * (a + b - need) and 100 * (need - 1) < 75 * (a + b - need + 1)


def test_same_as_all_pairs(spark):
    rng = random.Random(2)
    vocabulary = ["w%d" % i for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 120))] for _ in range(12)]
    rows = []
    for d in range(260):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(words)))
    rng.shuffle(rows)
    check(spark, rows)


def test_chain_and_edge_rows(spark):
    words = ["v%d" % i for i in range(300)]
    chain = [(100 + k, " ".join(words[6 * k : 6 * k + 100])) for k in range(30)]  # neighbours alone are similar
    rows = [*chain, (1, "a b"), (2, "A  b"), (2, "A  b"), (3, ""), (4, None), (None, "a b"), (None, "x y z"), (5, "a b c d e"), (6, "a b c d e f"), (7, "\x1c")]
    check(spark, rows)
    assert jaccard.similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = jaccard.op2_ngram_jaccard(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute(docs)


def test_keep_one_with_null_and_repeated_ids(spark):
    words = ["k%d" % i for i in range(120)]
    a, b, c = " ".join(words[:40]), " ".join(words[40:80]), " ".join(words[80:])
    near = [c, c + " more", "less " + c]
    rows = [(5, a), (5, b), (6, b + " end"), *((None, t) for t in near)]
    got = sorted(r.text for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert len(got) == 3 and {a, b} <= set(got) and len(set(near) & set(got)) == 1


def test_sketch_never_hides_a_link():
    rng = np.random.default_rng(1)
    for n in (3, 40, 300, 3000):
        a = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        b = np.concatenate([a[n // 8 :], rng.integers(0, 1 << 64, n // 9, dtype=np.uint64)])
        bits = int(np.bitwise_count((jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint64)).sum())
        assert bits <= n // 8 + n // 9 and (n > 1000 or bits >= 0.5 * (n // 8))


def test_few_pairs_of_a_large_group_and_of_unlike_texts_with_one_passage(spark, monkeypatch):
    """Versions that are similar to most others, and unlike short texts that share a passage, are not joined in pairs."""
    tables = {}
    write = jaccard.materialize

    def counted(df, name):
        tables[name] = written = write(df, name)
        return written

    monkeypatch.setattr(jaccard, "materialize", counted)
    rng = random.Random(8)
    base = ["b%d" % i for i in range(150)]
    versions = []
    for _ in range(200):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(len(words))] = "x%d" % rng.randrange(10**9)
        versions.append(" ".join(words))
    passage = " ".join("p%d" % i for i in range(8))
    unlike = [" ".join([passage, *("u%d" % rng.randrange(10**9) for _ in range(6))]) for _ in range(150)]
    rows = list(enumerate(versions + unlike))
    check(spark, rows)
    assert tables["jaccard-rest"].count() < 4000


def test_versions_with_many_shingles_of_their_own_do_not_meet(spark, monkeypatch):
    """Unlike versions share many lists; they meet only in those that may hold the first shingle that similar sets share."""
    tables = {}
    write = jaccard.materialize

    def counted(df, name):
        tables[name] = written = write(df, name)
        return written

    monkeypatch.setattr(jaccard, "materialize", counted)
    rng = random.Random(6)
    base = ["b%d" % i for i in range(900)]
    versions = []
    for _ in range(50):
        words = list(base)
        for i in rng.sample(range(30), 28):
            words[30 * i + rng.randrange(30)] = "x%d" % rng.randrange(10**9)
        versions.append(words)
    near = [[*versions[k][: 20 * k], "near%d" % k, *versions[k][20 * k :]] for k in (3, 9, 30)]
    check(spark, [(d, " ".join(w)) for d, w in enumerate(versions + near)])
    apart = tables["jaccard-apart"]
    without = jaccard.meetings(apart.withColumn("place", jaccard.F.lit(0))).count()
    assert without > 10_000 and jaccard.meetings(apart).count() < without / 10
