"""Quality and toxicity: gradients, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from revrank.llm import quality, queries, toxicity

SMALL = "/root/testdata/sf0.01"


def auc(score, label):
    score, label = np.array(score), np.array(label)
    more = (score[label == 1][:, None] > score[label == 0]).mean()
    return more + (score[label == 1][:, None] == score[label == 0]).mean() / 2


@pytest.fixture(scope="module")
def truth(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}


def test_gradients_of_the_attention_model():
    random = np.random.default_rng(1)
    bags = [random.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2, 5)]
    y = np.array([0.0, 1.0, 1.0, 0.0])
    model = quality.train(bags, y, epochs=1)
    x, first = np.concatenate(bags), np.array([0, 1, 4, 6, 11])

    def loss():
        p = model.forward(x, first)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, gradient in model.gradients(x, first, y).items():
        value = getattr(model, name)
        for at in list(np.ndindex(value.shape))[:6]:
            kept = value[at]
            value[at] = kept + 1e-5
            up = loss()
            value[at] = kept - 1e-5
            down = loss()
            value[at] = kept
            assert abs((up - down) / 2e-5 - gradient[at]) < 1e-5


def test_attention_finds_the_passage_that_decides():
    random = np.random.default_rng(2)
    y = random.integers(0, 2, 400).astype(float)
    bags = []
    for label in y:
        bag = random.normal(size=(8, quality.FEATURES)) * 0.3
        bag[random.integers(8), 0] += 3 if label else -3
        bags.append(bag)
    model = quality.train(bags[:300], y[:300])
    test = bags[300:]
    out = model.forward(np.concatenate(test), np.arange(0, 8 * len(test) + 1, 8))
    assert auc(out["score"], y[300:]) > 0.95
    strange = quality.train(bags[:300], random.permutation(y[:300]))
    assert auc(strange.forward(np.concatenate(test), np.arange(0, 8 * len(test) + 1, 8))["score"], y[300:]) < 0.8


def test_quality_on_held_out_documents(spark, truth):
    rows = queries.op5_quality(spark, SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    test = [(r.score, truth[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(*zip(*test)) > 0.95
    assert not any(s < 0.3 for s, y in test if y == 1)


def test_toxicity_of_labelled_documents(spark, truth):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    chain = toxicity.fit(docs, labels.filter("doc_id % 3 <> 0"))
    rows = docs.filter("doc_id % 3 = 0").select("doc_id", toxicity.probabilities(docs.text, chain).alias("p")).select("doc_id", "p.*").collect()
    test = [(r.p_toxic, truth[r.doc_id].toxic) for r in rows if r.doc_id in truth]
    assert auc(*zip(*test)) > 0.95
    assert len(queries.op10_toxicity(spark, SMALL).collect()) == 1000


def test_later_models_of_the_chain_use_the_earlier_ones():
    random = np.random.default_rng(3)
    dense = random.normal(size=(600, 2))
    first = (dense[:, 0] + random.normal(size=600) * 0.1 > 0).astype(float)
    second = first * (dense[:, 1] > -0.5)
    nothing = np.zeros(0, dtype=np.int64)
    x = toxicity.Sparse(nothing, nothing, nothing.astype(float), dense, 0)
    chain = toxicity.train(np.zeros(0, dtype=np.uint64), x, np.stack([first, second], axis=1), np.arange(600) % 5)
    assert chain.weights[1][2] > 0.5 and chain.probabilities(x).shape == (600, 2)
    assert auc(chain.probabilities(x)[:, 1], second) > 0.9  # a linear model cannot have it all: second is a conjunction


def test_odd_rows_and_tables(odd, none, labels):
    for module, columns in ((quality, 4), (toxicity, 5)):
        rows = module.classify(odd, labels).collect()
        assert len(rows) == odd.count() and all(len(r) == columns for r in rows)
        for r in rows:
            assert all(0 <= v <= 1 for v in tuple(r)[1:])
        assert module.classify(none, labels).count() == 0
        assert module.classify(odd, labels.limit(0)).count() == odd.count()
        assert module.classify(odd, labels.filter("doc_id = 1")).count() == odd.count()
    by = {}
    for r in quality.classify(odd, labels).collect():
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[3] == by[4] and len(by[1]) == 1
