import zlib

import numpy as np
import pyarrow as pa

from keyscore.llm import quality


def test_passages_by_hand():
    text = " ".join(["a"] * 64 + ["b", "C"])
    vectors, bags = quality.encode_passages(pa.array([text, "", " \n", None, "x y"]))
    assert bags.tolist() == [0, 2, 3, 4, 5, 6]
    assert np.allclose(vectors[0, 2:5], [1 / 64, 1, 63 / 64])
    assert np.allclose(vectors[1, 2:4], [1, 0.5])
    assert np.isclose(vectors[1, 6 + 2], 0.5)
    assert not vectors[2].any()
    assert np.allclose(vectors[5, 2:4], [1, 0.5])


def test_batches_do_not_matter():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "bb", "Cc!", "é", "##"], rng.integers(0, 300))) for _ in range(50)]
    together, bags = quality.encode_passages(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.allclose(together[bags[i] : bags[i + 1]], quality.encode_passages(pa.array([text]))[0])


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    x, bags, y = rng.normal(size=(9, quality.WIDTH)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = quality.fit_attention(x, bags, y, hidden=4, steps=3)
    grads = model.gradient(x, bags, y)

    def loss():
        out = model.score(x, bags)
        return -np.mean(y * np.log(out) + (1 - y) * np.log(1 - out))

    for name, value in model.p.items():
        flat = np.atleast_1d(value).reshape(-1)
        for i in range(0, flat.size, 3):
            old = value.copy()
            moved = np.atleast_1d(value.astype(float)).copy()
            moved.reshape(-1)[i] += 1e-5
            model.p[name] = moved.reshape(value.shape)
            up = loss()
            moved.reshape(-1)[i] -= 2e-5
            model.p[name] = moved.reshape(value.shape)
            down = loss()
            model.p[name] = old
            assert np.isclose((up - down) / 2e-5, np.atleast_1d(grads[name]).reshape(-1)[i], atol=1e-6)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "a", 0.1), (1, "a", 0.1), (None, None, 0.2), (4, "", 0.3)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality.train_quality(docs, labels) is None
    assert [r.score for r in quality.score_quality(docs, None).collect()] == [0.5] * 4
    assert quality.score_quality(docs.limit(0), None).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = quality.op5_quality_mil(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95
