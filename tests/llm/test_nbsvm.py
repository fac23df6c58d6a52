import zlib

import numpy as np
import pandas as pd

from carelattice.llm import nbsvm, queries
from tests.llm.helpers import documents


def test_features_ignore_steps_and_kind_of_digit(monkeypatch):
    text = "Some Text 123, äöü\n" * 30
    whole = nbsvm.features(text)
    monkeypatch.setattr(nbsvm, "_STEP", 23)
    assert (whole == nbsvm.features(text)).all()
    assert (nbsvm.features("a1") == nbsvm.features("a9")).all()
    assert len(nbsvm.features(None)) == len(nbsvm.features("")) == 0


def test_descent_reaches_the_hinge_optimum():
    """The dual solution has no better neighbour along any coordinate."""
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(50, 8, replace=False)), rng.normal(size=8)) for _ in range(60)]
    signs = np.where(rng.random(60) < 0.5, -1.0, 1.0)
    weight, bias = nbsvm._descend(rows, signs, 1.0, 400)

    def loss(w, b):
        margins = np.array([w[at] @ v + b for at, v in rows])
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * margins).sum()

    best = loss(weight, bias)
    for _ in range(200):
        step = rng.normal(size=nbsvm.BUCKETS) * np.isin(np.arange(nbsvm.BUCKETS), np.arange(50)) * 1e-2
        assert loss(weight + step, bias + rng.normal() * 1e-2) >= best - 1e-3


def test_one_class_no_rows_and_odd_labels(spark):
    docs = documents(spark, ["a", "b", None, ""])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = nbsvm.score(docs, nbsvm.train(docs, none)).collect()
    assert [r["score"] for r in got] == [0.5] * 4
    odd = spark.createDataFrame([(i, q) for i in range(4) for q in (1, None, 7)] + [(None, 0)], "doc_id bigint, quality int")
    scores = {r["score"] for r in nbsvm.score(docs, nbsvm.train(docs, odd)).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1
    assert nbsvm.score(docs.limit(0), nbsvm.train(docs.limit(0), odd)).collect() == []


def test_rank_of_held_out_rows_and_contract(spark):
    got = queries.op4_quality(spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    rank, good = both.score.rank(), both.quality == 1
    n = good.sum()
    auc = (rank[good].sum() - n * (n + 1) / 2) / (n * (len(both) - n))
    assert auc > 0.98 and (both.predicted == both.quality).mean() > 0.95


def test_sample_is_a_bound(spark):
    docs = documents(spark, [f"text {i} {'good' if i % 2 else 'bad'}" for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, quality int")
    model = nbsvm.train(docs, labels, sample=100)
    got = {r["doc_id"]: r["score"] for r in nbsvm.score(docs, model).collect()}
    assert np.mean([(got[i] > 0.5) == i % 2 for i in got]) > 0.95
