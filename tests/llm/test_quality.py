import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import quality
from tidewatch.llm.common import id_fold

from .helpers import ODD, documents


def test_held_out_labels(spark):
    base = "/root/testdata/sf0.01/"
    docs, labels = spark.read.parquet(base + "documents.parquet"), spark.read.parquet(base + "labels.parquet")
    held_out = id_fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, labels.where(~held_out))
    rows = quality.score(docs, model).join(labels.where(held_out), "doc_id").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert len(good) > 30 and len(bad) > 5
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    x, counts, y = rng.normal(size=(7, 5)), np.array([3, 1, 2, 1]), np.array([1.0, 0.0, 0.0, 1.0])
    shape = {"W": (5, 4), "b": (4,), "V": (4, 3), "U": (4, 3), "w": (3,), "u": (4,), "c": (1,)}
    model = quality.AttentionModel(np.zeros(5), np.ones(5), {k: rng.normal(size=s) for k, s in shape.items()})

    def loss():
        s = model.forward(x, counts)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
    grads = model.gradients(x, model.forward(x, counts), y)
    for name, p in model.p.items():
        for i in np.ndindex(p.shape):
            p[i] += 1e-6
            up = loss()
            p[i] -= 2e-6
            down = loss()
            p[i] += 1e-6
            assert abs((up - down) / 2e-6 - np.asarray(grads[name])[i]) < 1e-6


def test_attention_weights_passages():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 6, 300)
    x = rng.normal(size=(counts.sum(), 6)).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    y = (np.arange(300) % 2).astype(np.float32)
    x[first + rng.integers(0, 100, 300) % counts, 0] += 6 * y  # one passage tells
    model = quality.train(x, counts, y, epochs=40)
    f = model.forward(model.scaled(x), counts)
    assert ((f["score"] >= 0.5) == (y == 1)).mean() > 0.9
    assert np.allclose(np.add.reduceat(f["a"], first), 1)


def test_passages_cover_the_whole_text():
    features, counts = quality.encode_passages([b"", b"a" * 1024, b"a" * 1025, b"x" * 5000])
    assert counts.tolist() == [1, 1, 2, 5] and len(features) == 9 and np.isfinite(features).all()
    # a text's features do not depend on its neighbours
    alone, _ = quality.encode_passages([b"x" * 5000])
    assert np.allclose(features[4:], alone)


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, ODD, extra=True)
    found = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1] == by_id[2]
    none = labels.where("false")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.score(documents(spark, []), quality.fit(docs, labels)).collect() == []
