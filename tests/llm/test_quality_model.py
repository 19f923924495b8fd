import zlib

import numpy as np
from pyspark.sql import functions as F

from assetlens.llm import quality_model as qm

SF = "/root/testdata/sf0.01"


def test_features_of_a_cut_text_are_those_of_the_whole(monkeypatch):
    text = "Some Words, 12 of THEM!!\n*** é | " * 50
    whole = qm.features(text)
    monkeypatch.setattr(qm, "CHUNK", 37)
    assert np.allclose(whole, qm.features(text))
    assert not qm.features(None).any() and not qm.features("").any()


def test_prior_and_risk_on_known_mixtures():
    rnd = np.random.default_rng(0)
    for prior in (0.3, 0.6, 0.9):
        p = rnd.normal(2, 1, (4000, 3))
        n = int(4000 * prior)
        u = np.concatenate([rnd.normal(2, 1, (n, 3)), rnd.normal(-2, 1, (4000 - n, 3))])
        model = qm.fit(p, u)
        assert abs(model.prior - prior) < 0.08
        assert ((model.score(u) >= 0.5) == (np.arange(4000) < n)).mean() > 0.97


def test_no_samples():
    none = np.zeros((0, qm.N_FEATURES))
    assert (qm.fit(none, none).score(np.ones((2, qm.N_FEATURES))) < 0.01).all()
    assert np.isfinite(qm.fit(np.ones((3, qm.N_FEATURES)), none).score(np.ones((2, qm.N_FEATURES)))).all()


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = qm.classify(docs, qm.train(docs, labels)).join(labels, F.col("doc_id") == F.col("id")).where("held_out").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([g >= 0.3 for g in good]) > 0.98 and np.mean([b < 0.3 for b in bad]) > 0.8



def test_labels_of_the_held_out_fold_and_other_columns_do_not_matter(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a = qm.train(docs, labels)
    flipped = labels.withColumn("quality", F.when(qm.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    b = qm.train(docs.drop("lang", "source"), flipped)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (5, 1), (None, 1), (6, None)], "doc_id long, quality int")
    model = qm.train(edge_docs, labels)
    rows = qm.classify(edge_docs, model).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    assert qm.classify(no_docs, model).count() == 0
    assert qm.classify(edge_docs, qm.train(no_docs, labels.limit(0))).where("predicted = 1").count() == 0


def test_repeated_id_gives_the_driver_one_row(spark, monkeypatch):
    """An id that a third of all rows share, labelled good or not."""
    sizes, real = [], qm.fit
    monkeypatch.setattr(qm, "fit", lambda p, u, **kw: sizes.append((len(p), len(u))) or real(p, u, steps=2, **kw))
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"text number {i}") for i in ids] + [(ids[0], f"again {n}") for n in range(len(ids) // 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(ids[0], 1), (ids[1], 1)], "doc_id long, quality int")
    qm.train(docs, labels, sample=10**6)
    assert sizes == [(2, len(ids))]
