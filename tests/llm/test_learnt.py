"""Learnt scores: held-out accuracy, exact neighbours and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaystat.llm import common, quality, toxicity
from quaystat.llm.labelled import labelled_sample

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return common.table(spark, SF, "documents").cache(), common.table(spark, SF, "labels").cache()


def held_out(found, labels, column):
    return found.join(labels, "doc_id").where("held_out").select("score", "predicted", F.col(column).alias("y")).toPandas()


def auc(score, y):
    rank = score.rank().to_numpy()
    n = int((y == 1).sum())
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_quality_on_held_out_rows(spark, tables):
    found = quality.op3_quality(spark, SF).cache()
    assert found.count() == tables[0].count() and found.where("not (score between 0 and 1)").count() == 0
    rows = held_out(found, tables[1], "quality")
    assert auc(rows["score"], rows["y"]) > 0.97 and (rows["predicted"] == rows["y"]).mean() > 0.93


def test_toxicity_on_held_out_rows(spark, tables):
    found = toxicity.op9_toxicity(spark, SF).cache()
    assert found.count() == tables[0].count() and found.where("not (score between 0 and 1)").count() == 0
    rows = held_out(found, tables[1], "toxic")
    assert auc(rows["score"], rows["y"]) > 0.75 and (rows["predicted"] == rows["y"]).mean() > 0.9
    assert rows[rows["y"] == 0]["predicted"].mean() < 0.05


def test_learning_never_sees_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    sample, counts = labelled_sample(docs, labels, "quality", 20)
    ids = [r["doc_id"] for r in sample.collect()]
    import zlib

    assert len(ids) == 40 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert sum(counts.values()) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(200))


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_odd_rows_and_missing_labels(spark, label):
    schema = "doc_id long, text string, score double, terms string, y int"
    docs = spark.createDataFrame([(1, None, 1.0, "t", 1), (2, "", 1.0, "t", 1), (None, "a b", 1.0, "t", 0), (3, "w " * 5000, 0.0, "t", 1), (3, "w " * 5000, 0.0, "t", 1), (4, "é日😀", 0.0, "t", 1)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    if label == "quality":
        ranker = quality.learn(docs, none)
        rows = quality.score(docs.drop("score"), ranker, ["doc_id", "terms"]).collect()
        assert quality.score(docs.drop("score").limit(0), ranker, ["doc_id"]).count() == 0
        assert all(r["score"] >= quality.THRESHOLD for r in rows)
    else:
        rows = toxicity.score(docs, none).collect()
        assert all(r["score"] == 0 for r in rows)
    assert len(rows) == 6


def test_ranker_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] - 2 * x[:, 3] > 0).astype(int)
    r = quality.fit(x, y, np.ones(400))
    assert ((r.score(x) >= quality.THRESHOLD) == y).mean() > 0.97


def test_nearest_is_exact():
    rng = np.random.default_rng(4)
    idf = rng.uniform(1, 8, 60)
    vectors = [sorted(rng.choice(60, rng.integers(0, 9), replace=False).tolist()) for _ in range(500)]
    index = toxicity.BlockMaxIndex(vectors, idf)
    dense = np.zeros((500, 60))
    for i, v in enumerate(vectors):
        dense[i, v] = idf[v]
    norms = np.maximum(np.linalg.norm(dense, axis=1), 1e-12)
    for q in range(0, 500, 7):
        if not vectors[q]:
            continue
        cosine = np.round(dense @ dense[q] / norms / norms[q], 5)
        order = [i for i in np.lexsort((np.arange(500), -cosine)).tolist() if i != q and cosine[i] > 0][:10]
        best, got = index.nearest(vectors[q], 10, skip=q)
        assert np.allclose(got, cosine[order], atol=2e-5)
        assert set(best[got > got[-1] + 1e-4].tolist()) == {i for i in order if cosine[i] > got[-1] + 1e-4}


def test_quality_learns_from_every_row(spark, monkeypatch):
    """Rows beyond any sample count: the model is the minimum over all pairs, whatever the blocks."""
    import zlib

    monkeypatch.setattr(quality, "BLOCK_ROWS", 10**6)
    words = ["plain words of a text", "x9 ## 77 $$ zz", "short", "a a a a", "Some, other. Text!"]
    rows = [(i, " ".join(words[(i * k) % 5] for k in range(1, 2 + i % 7)) + "!" * (i % 3)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, int((i * 7) % 5 > 1 or i % 11 == 0)) for i, _ in rows]
    whole = quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = [(t, y) for (i, t), (_, y) in zip(rows, labels, strict=True) if zlib.crc32(str(i).encode()) % 5]
    x, y = np.array([quality.features(t.encode()) for t, _ in kept]).astype("f4").astype(float), np.array([y for _, y in kept])
    here = quality.fit(x, y, np.ones(len(y)))
    assert np.allclose(whole.mean, x.mean(axis=0)) and np.allclose(whole.weights, here.weights, atol=1e-4)
    s = whole.raw(x)

    def balanced(cut):
        return (s[y == 0] <= cut).mean() - (s[y == 1] <= cut).mean()

    assert balanced(whole.cut) >= max(balanced(c) for c in s) - 1e-9
    # More copies of one row move the model: it is counted each time.
    more = docs.unionAll(spark.createDataFrame([rows[1]] * 50, "doc_id long, text string"))
    assert not np.allclose(quality.learn(more, spark.createDataFrame(labels, "doc_id long, quality int")).mean, whole.mean)


def test_a_rare_label_meets_every_block(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_ROWS", 8)
    rows = [(i, "word " * (i % 40 + 3) + str(i)) for i in range(200)] + [(1000, "?! ?! ?!"), (1001, "?? !!"), (1002, "!!"), (1003, "??")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, quality int")
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.learn(docs, labels), ["doc_id"]).collect()}
    assert max(found[i] for i in range(1000, 1004)) < quality.THRESHOLD <= min(found[i] for i in range(200))
