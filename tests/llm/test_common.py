import random
import tracemalloc

import numpy as np

from keyscore.llm import common


def rows_of(rng, letters="ab \n\tAZ", most=400):
    return ["".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 3, 50, most)))) for _ in range(rng.randrange(0, 12))]


def flat_of(rows):
    data = [r.encode() for r in rows]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)


def test_slices_do_not_change_the_hashes(monkeypatch):
    rng = random.Random(1)
    for _ in range(100):
        rows = rows_of(rng)
        flat, offsets = flat_of(rows)
        monkeypatch.setattr(common, "SLICE", 1 << 20)
        whole, at = common.word_hashes(flat, offsets)
        monkeypatch.setattr(common, "SLICE", rng.choice((1, 5, 50)))
        sliced, also_at = common.word_hashes(flat, offsets)
        assert whole.tolist() == sliced.tolist() and at.tolist() == also_at.tolist()
        words = [w for r in rows for w in r.lower().split()]
        assert len(words) == len(whole) and len(set(words)) == len(set(whole.tolist()))


def test_memory_of_a_long_text():
    text = np.frombuffer(b"hello World of some words " * (16 << 20 >> 5), np.uint8)
    common.word_hashes(text[:100], np.array([0, 100]))
    tracemalloc.start()
    words, _ = common.word_hashes(text, np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # what comes out is 24 bytes a word, twice while the slices are joined; beside it a slice's arrays
    assert peak < 60 * len(words) + (100 << 20)
    assert all(len(x) <= 2 * common.SLICE for x in common._POWERS.values())


def test_most_frequent(spark):
    rows = [(i, n) for i, n in enumerate([1] * 50 + [7] * 20 + [100, 100, 1000])]
    df = spark.createDataFrame(rows, "w int, n long")
    for limit, size in ((0, 0), (1, 1), (2, 1), (3, 3), (22, 3), (23, 23), (1000, 73)):
        assert common.most_frequent(df, limit).count() == size
    assert common.most_frequent(df.limit(0), 5).count() == 0
