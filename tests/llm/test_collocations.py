import random
import re
from collections import Counter, defaultdict

import numpy as np

from keyscore.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, phrase string, n int"
UPPER = {o: o + 32 for o in range(65, 91)}


def brute(rows, least, longest=5, best=2000):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    kept = {k: a for k, a in f.items() if a >= least and len(k[1]) >= 2}
    contained = set()
    for (lang, w), a in kept.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                part = (lang, w[i : i + m])
                if 100 * a >= 100 * f[part]:
                    contained.add(part)
    by_lang = defaultdict(list)
    for (lang, w), a in kept.items():
        if (lang, w) in contained:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        by_lang[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    out = []
    for lang, found in by_lang.items():
        for rank, (s, a, w, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, w.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(spark, rows, **more):
    df = c.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    return sorted(tuple(r)[:8] for r in df.collect())


def texts(rng, count, words):
    return [" ".join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(count)]


def test_same_as_brute_force(spark):
    rng = random.Random(2)
    words = ["the", "The", "of", "a", "a", "é", "Ä", "x.", ", y", "new\tyork", "san\nfran", "b c", "end!"]
    rows = [(i, t, rng.choice(["en", "fr", None, ""]), "p", 1) for i, t in enumerate(texts(rng, 300, words))]
    for more in ({"shard_words": 50}, {"shard_words": 500, "best": 7}, {}):
        assert found(spark, rows, least=12, **more) == brute(rows, 12, best=more.get("best", 2000))


def test_phrase_inside_an_equal_one_is_left_out(spark):
    rows = [(i, "red green blue. red green blue; green sky", "en", None, None) for i in range(5)]
    got = {r[2]: r for r in found(spark, rows, least=5)}
    assert set(got) == {"red green blue", "green sky"} and got["red green blue"][3] == 10
    assert found(spark, rows, least=5) == brute(rows, 5)


def test_overlapping_occurrences(spark):
    rows = [(1, "a a a a a a", "en", "", 0)] * 4
    assert found(spark, rows, least=4) == brute(rows, 4)


def test_null_empty_and_long_texts(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "", 1), (2, " .,;\t\n", "en", "", 1)]
    assert found(spark, rows, least=2) == []
    assert found(spark, [], least=2) == []
    long = [(3, "one two three four five six " * 100_000 + "x" * 2_000_000, None, "", 1)]
    assert found(spark, long, least=100, shard_words=1000) == brute(long, 100)


def test_counts_pass_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a", 2), ("en", "b", 3), ("en", "a b", 10**15)], "lang string, phrase string, a long")
    totals = spark.createDataFrame([("en", 10**17)], "lang string, n long")
    # l and r are small only to make the quotient large: 1000 * 10**15 * 10**17 / 6 is past 64 bits, so scale the parts too
    phrases = phrases.replace({2: 2 * 10**15, 3: 3 * 10**15}, subset="a")
    (row,) = c._scored(phrases, totals, 5, 10, 100).collect()
    assert row.score == 1000 * 10**15 * 10**17 // (6 * 10**30)


def test_index_counts_every_phrase_from_either_side():
    rng = np.random.default_rng(3)
    ids = np.where(rng.random(400) < 0.2, 0, rng.integers(1, 6, 400))
    ids[0] = ids[-1] = 0
    for sides in ((0, 0, 0, 0), (1, 1, 1, 1), (0, 1, 0, 1), (1, 0, 0, 1)):
        index = c.ShardIndex(ids, 5)
        for length, side in enumerate(sides, 2):
            index.extend(side)
            want = Counter(tuple(ids[i : i + length].tolist()) for i in range(len(ids) - length + 1))
            want = {g: n for g, n in want.items() if 0 not in g}
            assert dict(zip(map(tuple, index.grams.tolist()), index.size.tolist())) == want


def test_filter_lets_all_pass_that_it_must(spark):
    rng = np.random.default_rng(4)
    hashes = rng.integers(-(1 << 63), 1 << 63, 5000)
    made = c.filter_of(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h")
    assert made(hashes.view(np.uint64)).all()
    assert made(rng.integers(0, 1 << 63, 5000).astype(np.uint64)).mean() < 0.2
