import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtables.llm import boosting, quality, toxicity
from logtables.llm.common import remainder


def test_boosted_trees_and_calibration():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = boosting.BoostedTrees(x[:2000], y[:2000], trees=80)
    assert ((trees.margin(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95
    flipped = np.where(rng.random(1000) < 0.2, 1 - y[2000:], y[2000:])
    scores = boosting.Isotonic(trees.margin(x[2000:]), flipped).score(np.sort(trees.margin(x)))
    low, high = np.quantile(scores, [0.2, 0.8])
    assert (np.diff(scores) >= 0).all() and 0.1 < low < 0.3 and 0.7 < high < 0.9


@pytest.mark.parametrize("y", [np.zeros(0), np.zeros(4), np.ones(4)])
def test_one_class_or_none(y):
    trees = boosting.BoostedTrees(np.ones((len(y), 3)), y)
    score = boosting.Isotonic(trees.margin(np.ones((len(y), 3))), y).score(trees.margin(np.zeros((2, 3))))
    assert ((0 <= score) & (score <= 1)).all()


def corpus(rng, bad):
    rows = []
    for i in range(500):
        words = [rng.choice(["haus", "baum", "the", "wind", "over", "sol"]) for _ in range(rng.randrange(1, 300))]
        label = i % 4 == 0
        rows.append((i, " ".join(bad(rng, words) if label else words), int(label)))
    return rows


def insults(rng, words):
    for _ in range(1 + len(words) // 40):
        words[rng.randrange(len(words))] = rng.choice(["idiot", "moron!", "wuzzel" + rng.choice(["a", "en", "ung"])])
    return words


def noise(rng, words):
    return [w.upper() + "!!" if rng.random() < 0.9 else w for w in words]


ODD = [(900, None), (901, ""), (902, " \n"), (None, "wind"), (903, "x" * 200_000), (904, "the wind " * 20_000)]


def test_toxicity(spark, docs):
    rows = corpus(random.Random(3), insults)
    table = docs([(i, t) for i, t, _ in rows] + ODD)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (900, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(table, labels, remainder("doc_id", 5) != 0)
    assert any(s.startswith("wuzz") for s in model.learned)
    scored = toxicity.score_toxicity(table, model).withColumn("held", remainder("doc_id", 5) == 0)
    found = scored.join(labels, "doc_id").where("held and toxic is not null").collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in found]) > 0.95
    everything = scored.collect()
    assert len(everything) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in everything)
    kept = toxicity.drop_toxic(table, model)
    assert kept.schema == table.schema and {900, 901, 902, None, 903, 904} <= {r.doc_id for r in kept.collect()}
    assert toxicity.drop_toxic(docs([]), model).count() == 0
    none = toxicity.fit_toxicity(table, labels.where("false"), F.lit(True))
    assert toxicity.score_toxicity(table, none).count() == len(rows) + len(ODD)


def test_disguised_words():
    plain = dict(zip(toxicity.NAMES, toxicity.features("you absolute m0r0n and l.o.s.e.r and st00pid i d i o t", {})))
    assert plain["disguised_hits"] >= 3 and plain["hits"] == 0
    near = dict(zip(toxicity.NAMES, toxicity.features("you are an IDIOT!", {})))
    assert near["hits"] == 1 and near["near_second_person"] > 0


def test_quality(spark, docs):
    rows = [(i, t, 1 - y) for i, t, y in corpus(random.Random(4), noise)]
    table = docs([(i, t) for i, t, _ in rows] + ODD)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1)], "doc_id bigint, quality int")
    model = quality.fit_quality(table, labels, remainder("doc_id", 4) != 2)
    scored = quality.score_quality(table, model).withColumn("held", remainder("doc_id", 4) == 2)
    found = scored.join(labels, "doc_id").where("held").collect()
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in found]) > 0.95
    everything = scored.collect()
    assert len(everything) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in everything)
    kept = quality.keep_quality(table, model)
    assert kept.schema == table.schema and 904 in {r.doc_id for r in kept.collect()}
    assert quality.score_quality(docs([]), model).count() == 0
    assert quality.score_quality(table, quality.fit_quality(table, labels.where("false"), F.lit(True))).count() == len(everything)


def test_slopes_equal_differences():
    rng = np.random.default_rng(1)
    model = quality.AttentionMIL(6, codes=4, gates=3)
    model.mean, model.spread = rng.normal(size=6), rng.uniform(0.5, 2, 6)
    sizes = np.array([1, 3, 2, 5])
    x, y, starts, bag = rng.normal(size=(11, 6)), np.array([1.0, 0, 0, 1]), np.cumsum(sizes) - sizes, np.repeat(np.arange(4), sizes)

    def loss():
        *_, p = model.forward(x, starts, bag)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, slope in model.slopes(x, starts, bag, y).items():
        weights = model.w[name]
        for at in np.ndindex(np.shape(weights)):
            ends = []
            for step in (1e-5, -1e-5):
                moved = np.array(weights)
                moved[at] += step
                model.w[name] = moved
                ends.append(loss())
            model.w[name] = weights
            assert np.isclose((ends[0] - ends[1]) / 2e-5, np.asarray(slope)[at], atol=1e-8), (name, at)


def test_quality_learns_from_whole_texts_within_its_bound(spark, docs, monkeypatch):
    learned = []
    monkeypatch.setattr(quality.AttentionMIL, "fit", lambda self, bags, y: learned.append(sorted(map(len, bags))))
    table = docs([(1, "a " * 1000), (2, "b " * 70_000), (3, "c"), (4, None), (5, "c")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id bigint, quality int")
    quality.fit_quality(table, labels, F.lit(True))
    quality.fit_quality(table, labels, F.lit(True), most=100)
    quality.fit_quality(table, labels, F.lit(True), most=0)
    assert learned == [[1, 1, 10, 700], [1, 1, 10], []]


def test_attention_weights_passages():
    model = quality.AttentionMIL(quality.WIDTH)
    bags = [quality.passages("good words " * 400), quality.passages("BAD!! " * 400)]
    model.fit(bags * 10, np.array([1.0, 0.0] * 10))
    sizes = np.array([len(b) for b in bags])
    *_, a, z, p = model.forward(np.concatenate(bags), np.cumsum(sizes) - sizes, np.repeat([0, 1], sizes))
    assert np.allclose(np.add.reduceat(a, np.cumsum(sizes) - sizes), 1) and p[0] > 0.9 > 0.1 > p[1]
