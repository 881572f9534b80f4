"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams over a text's words and over the words' shapes (runs of small letters, capitals, digits
and single marks, and whether a word or line repeats). Each indicator is scaled by the log ratio of its smoothed counts in
the two classes, and a linear model with hinge loss is fitted to them by dual coordinate descent. A part of the
sample that the fit does not see turns margins into probabilities.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import text_or_empty

#: Labelled rows that the model is fitted on at most: those whose ids have the smallest hashes.
TRAIN_ROWS = 4000
#: Indicators are hashed to this many places.
DIMENSIONS = 1 << 18
EPOCHS, COST, SMOOTHING = 20, 1.0, 1.0
#: One of so many sample rows is for turning margins into probabilities.
CALIBRATION = 5
#: Words that one task remembers.
CACHED_WORDS = 300_000
#: Words looked at at a time, so that a very long text takes little memory.
BLOCK = 1 << 16

_SMALL, _LARGE, _DIGITS = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shape(word: str) -> str:
    """``a`` for a run of small letters, ``A`` for capitals, ``9`` for digits; other marks as they are, runs as one."""
    word = _DIGITS.sub("9", _LARGE.sub("A", _SMALL.sub("a", word)))
    return re.sub(r"(.)\1+", r"\1", word)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(33))


class Features:
    """Places of a text's indicators."""

    def __init__(self, cached: int = CACHED_WORDS):
        self.cached, self.known = cached, {}

    def _hashes(self, word: str) -> tuple[int, int]:
        found = xxhash.xxh3_64_intdigest(word), xxhash.xxh3_64_intdigest(shape(word))
        if len(self.known) < self.cached:
            self.known[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """Sorted places, each once; the first place stands for every text."""
        words, out, known = text.split(), [np.zeros(1, np.int64)], self.known
        for at in range(0, len(words), BLOCK):
            # two words more on the left, so that n-grams over the edge count too
            some = words[max(at - 2, 0) : at + BLOCK]
            pairs = np.array([known.get(w) or self._hashes(w) for w in some], np.uint64).reshape(-1, 2)
            word, form = pairs[:, 0], pairs[:, 1].copy()
            form[1:] += (word[1:] == word[:-1]).astype(np.uint64) * np.uint64(7)  # a word that repeats the one before
            two = _mixed(form[:-1] * np.uint64(3) + form[1:])
            three = _mixed(two[:-1] * np.uint64(5) + form[2:])
            found = np.concatenate((_mixed(word + np.uint64(11)), _mixed(form), two, three, _mixed(word[:-1] * np.uint64(13) + word[1:])))
            out.append(np.unique((found >> np.uint64(20)).astype(np.int64) % (DIMENSIONS - 2)) + 2)
        lines = text.split("\n")
        if len(set(lines)) < len(lines):
            out.append(np.ones(1, np.int64))
        return np.unique(np.concatenate(out))


@dataclass(frozen=True)
class Model:
    """``weights`` hold the log count ratios already; a margin becomes a score by ``slope`` and ``shift``."""

    weights: np.ndarray
    slope: float
    shift: float

    def score(self, places: np.ndarray) -> float:
        margin = float(self.weights[places].sum()) / math.sqrt(len(places))
        return 1.0 / (1.0 + math.exp(-max(min(self.slope * margin + self.shift, 500.0), -500.0)))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log of each indicator's share of the smoothed counts in class 1 over that in class 0."""
    counts = np.full((2, DIMENSIONS), SMOOTHING)
    for places, y in zip(rows, labels):
        counts[int(y), places] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[np.ndarray], signs: np.ndarray, values: np.ndarray, epochs: int = EPOCHS, cost: float = COST) -> np.ndarray:
    """Weights of the L2-regularised hinge loss, one dual variable, from 0 to ``cost``, at a time in a random order."""
    rng, weights, alpha = np.random.default_rng(9), np.zeros(DIMENSIONS), np.zeros(len(rows))
    x = [values[p] / math.sqrt(len(p)) for p in rows]
    own = np.maximum([float(v @ v) for v in x], 1e-12)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * float(weights[rows[i]] @ x[i]) - 1
            if alpha[i] == 0 and gradient >= 0 or alpha[i] == cost and gradient <= 0:
                continue
            new = min(max(alpha[i] - gradient / own[i], 0.0), cost)
            weights[rows[i]] += (new - alpha[i]) * signs[i] * x[i]
            alpha[i], most = new, max(most, abs(gradient))
        if most < 1e-3:
            break
    return weights


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, by Newton steps on smoothed labels."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g, w = p - target, np.maximum(p * (1 - p), 1e-6)
        ga, gb = float(g @ margins) + 1e-3 * (a - 1), float(g.sum())
        haa, hab, hbb = float(w @ margins**2) + 1e-3, float(w @ margins), float(w.sum()) + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5.0 / max(abs(da), abs(db), 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model from indicators and 0/1 labels. Without rows of both classes every score is that of the labels' mean."""
    if len(set(labels.tolist())) < 2:
        mean = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(DIMENSIONS), 1.0, math.log(mean / (1 - mean)))
    held = np.zeros(len(rows), bool)
    for y in (0, 1):  # of each class, in the order given
        held[np.flatnonzero(labels == y)[CALIBRATION - 1 :: CALIBRATION]] = True
    if len(set(labels[held].tolist())) < 2:
        held[:] = False
    part = np.flatnonzero(~held)
    own = [rows[i] for i in part]
    ratios = log_ratios(own, labels[part])
    weights = dual_descent(own, 2.0 * labels[part] - 1, ratios) * ratios
    rest = np.flatnonzero(held) if held.any() else part
    margins = np.array([weights[rows[i]].sum() / math.sqrt(len(rows[i])) for i in rest])
    return Model(weights, *calibrated(margins, labels[rest].astype(float)))


def in_fold(id_col: str, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text is divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents outside the held-out fold. The sample is joined to the documents
    and turned into indicators where they lie; one task fits the model, and only that comes to the driver."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~in_fold(id_col))
    one = usable.groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"), F.min(label_col).cast("int").alias("_least")).where("_label = _least")
    sample = one.orderBy(F.xxhash64(F.col(id_col).cast("long")), id_col).limit(rows).select(F.col(id_col).cast("long").alias("_sample_id"), "_label")
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), text_or_empty(text_col).alias("_text"))
    chosen = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_sample_id")).select("_doc", "_label", "_text")

    def indicators(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for pdf in batches:
            yield pd.DataFrame({"_doc": pdf["_doc"], "_label": pdf["_label"], "places": [features.of(t).astype(np.int32) for t in pdf["_text"]]})

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_doc", kind="stable").drop_duplicates("_doc").reset_index(drop=True)
        order = np.argsort([xxhash.xxh64_intdigest(str(x)) for x in pdf["_doc"]], kind="stable")
        model = fit([np.asarray(pdf["places"][i], np.int64) for i in order], pdf["_label"].to_numpy()[order])
        return pd.DataFrame({"weights": [model.weights.astype("<f4").tobytes()], "slope": [model.slope], "shift": [model.shift]})

    found = chosen.mapInPandas(indicators, "_doc long, _label int, places array<int>").groupBy().applyInPandas(fitted, "weights binary, slope double, shift double").first()
    if found is None:
        return fit([], np.zeros(0))
    return Model(np.frombuffer(bytes(found["weights"]), "<f4").astype(float), found["slope"], found["shift"])


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: the id, score double (0 to 1), predicted int (1 from the threshold on).

    Only the text counts. Null and empty texts get the score of a text without words; repeated rows stay repeated, no
    rows give no rows, other columns are not read.
    """
    weights = model.weights.astype(np.float32)
    slope, shift = model.slope, model.shift

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, own = Features(), Model(weights.astype(float), slope, shift)
        for texts in batches:
            yield pd.Series([own.score(features.of(t)) for t in texts], dtype=float)

    rows = docs.select(F.col(id_col), score(text_or_empty(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, held_out boolean, score, predicted; see ``trained`` and ``scored``. Labels that
    are null, or that contradict one another for one id, are not learned from; an empty table of labels gives 0.5."""
    return scored(docs, trained(docs, labels, label_col, id_col, text_col), id_col, text_col).withColumn("held_out", in_fold(id_col))
