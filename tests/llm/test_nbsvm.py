import math
import zlib

import numpy as np
import pytest
import xxhash

from tollhouse.llm import nbsvm
from tollhouse.llm.queries import op9_quality_classifier


def test_shape():
    assert [nbsvm.shape(w) for w in ("été", "Été***", "AB!!", "x1y22", "|", "")] == ["a", "Aa*", "A!", "a9a9", "|", ""]


def test_features_of_a_long_text_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000)) + "\nx\nx"
    whole = nbsvm.Features().of(text)
    monkeypatch.setattr(nbsvm, "BLOCK", 64)
    assert nbsvm.Features(cached=3).of(text).tolist() == whole.tolist()
    assert nbsvm.Features().of("").tolist() == [0]


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(60)]
    signs = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    values = rng.normal(size=nbsvm.DIMENSIONS)
    w = nbsvm.dual_descent(rows, signs, values, epochs=2000)[:12]
    x = np.zeros((60, 12))
    for i, p in enumerate(rows):
        x[i, p] = values[p] / math.sqrt(len(p))

    def loss(w):
        return w @ w / 2 + nbsvm.COST * np.maximum(1 - signs * (x @ w), 0).sum()

    best, v = np.inf, np.zeros(12)
    for t in range(1, 40_001):  # subgradient steps on the primal
        v -= (v - nbsvm.COST * (x * (signs * (signs * (x @ v) < 1))[:, None]).sum(axis=0)) / t
        best = min(best, loss(v))
    assert loss(w) <= best * (1 + 1e-3)


def test_scores_against_brute_force(spark, documents, corpus):
    """Counts, log ratios, the fitted weights and the scores, with dicts over the indicators."""
    texts = [f"{'good' if i % 2 else 'bad'} word{i % 7} {corpus[i % 40][:60]}" for i in range(80)]
    labels = [(i, i % 2) for i in range(80) if zlib.crc32(str(i).encode()) % 5]
    model = nbsvm.trained(documents(list(enumerate(texts))), spark.createDataFrame(labels, "doc_id long, quality int"), "quality")
    places = {i: set(nbsvm.Features().of(texts[i]).tolist()) for i, _ in labels}
    order = sorted(labels, key=lambda r: xxhash.xxh64_intdigest(str(r[0])))
    held = {i for y in (0, 1) for i in [i for i, q in order if q == y][nbsvm.CALIBRATION - 1 :: nbsvm.CALIBRATION]}
    counts = [dict.fromkeys(range(nbsvm.DIMENSIONS), nbsvm.SMOOTHING) for _ in range(2)]
    for i, y in labels:
        for p in places[i] - (places[i] if i in held else set()):
            counts[y][p] += 1
    totals = [sum(c.values()) for c in counts]
    seen = sorted(set().union(*(places[i] for i, _ in labels if i not in held)))
    ratio = {p: math.log(counts[1][p] / totals[1]) - math.log(counts[0][p] / totals[0]) for p in seen}
    assert all(model.weights[p] == 0 for p in set(range(5000)) - set(seen))
    # the weights are of the span of the rows, scaled by the ratios twice
    scaled = {p: model.weights[p] / ratio[p] for p in seen if abs(ratio[p]) > 1e-9}
    rows = [{p: ratio[p] / math.sqrt(len(places[i])) for p in places[i]} for i, _ in labels if i not in held]
    matrix = np.array([[r.get(p, 0.0) for p in scaled] for r in rows])
    signs = np.array([2 * y - 1 for i, y in labels if i not in held])
    w = np.array(list(scaled.values()))
    alpha, *_ = np.linalg.lstsq(matrix.T, w, rcond=None)
    assert np.abs(matrix.T @ alpha - w).max() < 1e-4 and (alpha * signs > -1e-2).all() and (alpha * signs < nbsvm.COST + 1e-2).all()
    for r in nbsvm.scored(documents(list(enumerate(texts))), model).collect():
        p = set(nbsvm.Features().of(texts[r["doc_id"]]).tolist())
        margin = sum(model.weights[k] for k in p) / math.sqrt(len(p))
        assert abs(r["score"] - 1 / (1 + math.exp(-(model.slope * margin + model.shift)))) < 1e-6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scores = op9_quality_classifier(spark, sf).toPandas()
    assert len(scores) == 1000 and scores["score"].between(0, 1).all()
    assert (scores["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scores["doc_id"]]).all()
    assert (scores["predicted"] == (scores["score"] >= 0.3)).all()
    both = scores[scores["held_out"]].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.95


def test_labels_ids_and_the_held_out_fold_are_not_seen(spark, documents, corpus):
    rows = list(enumerate(corpus))
    labels = [(i, i % 2, 0) for i, _ in rows]
    docs = documents(rows)
    table = lambda data: spark.createDataFrame(data, "doc_id long, quality int, toxic int")
    model = nbsvm.trained(docs, table(labels), "quality")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1) for i, q, _ in labels]
    other = nbsvm.trained(docs, table([*flipped, (None, 1, 0), (3, None, 1), (2, 0, 0)]), "quality")
    assert np.array_equal(model.weights, other.weights) and (model.slope, model.shift) == (other.slope, other.shift)


def test_nulls_repeats_and_no_labels(spark, documents, corpus):
    rows = [*enumerate(corpus[:5]), (1, corpus[1]), (7, None), (8, ""), (None, "null id")]
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = nbsvm.quality_scores(documents(rows), none).collect()
    assert len(got) == len(rows) and {r["score"] for r in got} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    assert all(0.5 < r["score"] < 1 for r in nbsvm.quality_scores(documents(rows), one).collect())
    assert nbsvm.quality_scores(documents([]), one).collect() == []


def test_sample_is_bounded(spark, documents, corpus):
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(corpus))], "doc_id long, quality int")
    model = nbsvm.trained(documents(list(enumerate(corpus))), labels, "quality", rows=10)
    assert np.isfinite(model.weights).all()


@pytest.mark.parametrize("margins", [np.array([-2.0, -1.0, 1.0, 2.0] * 20), np.array([5.0] * 40 + [6.0] * 40)])
def test_calibration_is_finite(margins):
    labels = np.array([0.0, 0.0, 1.0, 1.0] * 20)
    assert all(map(math.isfinite, nbsvm.calibrated(margins, labels)))
