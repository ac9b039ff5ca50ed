"""Toxicity: non-negative positive-unlabelled learning with a numpy classifier over hashed words.

Confirmed toxic texts are the positives; a sample of all texts, whose labels are not looked at, is the unlabelled
set. With the class prior ``p`` the risk is ``p * R(positive, 1) + max(0, R(unlabelled, 0) - p * R(positive, 0))``;
when the second part turns negative the step goes the other way, which keeps the classifier from fitting the
unlabelled positives. No negative label is needed: the prior is the smallest share of the unlabelled texts among texts
that look toxic, relative to the same share of the positives (no region can hold more positives than texts).

Defined results: a null text counts as empty; an empty text has the score of a text without any known
feature; repeated rows get equal scores; of an id that repeats one text is learned from; an empty table gives no rows;
without positives every score is 0. The model depends on the rows, not on how they lie in files.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_ids, map_rows, sigmoid, text_bytes
from .features import Adam, HashedText, Sparse
from .quality_rules import first_texts, hashed, labelled_features

# Texts used at most: confirmed positives, and texts for the unlabelled set, both chosen by a hash of the id.
POSITIVE_ROWS, UNLABELLED_ROWS = 2500, 5000
FEATURES = HashedText(bits=18, words=True, prefixes=(4, 5, 6), lower=True, letters_only=True)
# A feature must stand out: its share of the positives is at least LIFT times its share of the negatives, and lies this
# many standard errors above that of the unlabelled texts. All others would only add noise, text length by text length.
LIFT, ERRORS = 3.0, 4.0
PRIORS = (1e-3, 0.9)  # smallest and largest class prior
# The prior is read off regions that hold at least this share of the positives.
REGION = 0.2
THRESHOLD = 0.3


@dataclass
class ToxicityModel:
    features: HashedText
    weights: np.ndarray
    bias: float

    def probability(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return sigmoid(self.features.presence_scores(data, offsets, self.weights) + self.bias)


def fit(positive: Sparse, unlabelled: Sparse, prior: float, size: int, steps: int = 300, rate: float = 0.05,
        ridge: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by full-batch steps."""
    params = np.zeros(size + 1)
    params[-1] = np.log(prior / (1 - prior))
    adam = Adam(rate)
    for _ in range(steps):
        p, u = sigmoid(positive.dot(params[:-1]) + params[-1]), sigmoid(unlabelled.dot(params[:-1]) + params[-1])
        by_u, by_p = u / len(u), -prior * p / len(p)
        if risk(p, u, prior)[1] < 0:
            by_u, by_p = -by_u, -by_p
        else:
            by_p = by_p - prior * (1 - p) / len(p)
        gradient = np.append(positive.back(by_p, size) + unlabelled.back(by_u, size) + ridge * params[:-1],
                             by_p.sum() + by_u.sum())
        params = adam.update(params, gradient)
        params[:-1] = np.maximum(params[:-1], 0)  # a word can speak for toxicity, none against it
    return params[:-1], float(params[-1])


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Of probabilities of the positives and the unlabelled texts: the positives' part and the negatives' part of the risk."""
    surely = 1e-12
    return (-prior * float(np.log(positive + surely).mean()),
            float(prior * np.log(1 - positive + surely).mean() - np.log(1 - unlabelled + surely).mean()))


def shares(x: Sparse, size: int) -> np.ndarray:
    return np.bincount(x.slots, minlength=size) / len(x)


def standing_out(positive: Sparse, unlabelled: Sparse, size: int, prior: float) -> np.ndarray:
    """Slots that positives hold clearly more often than negatives, whose share follows from the prior."""
    p, u = shares(positive, size), shares(unlabelled, size)
    negative = np.maximum(u - prior * p, 0) / (1 - prior)
    error = np.sqrt(np.maximum(u, 1 / len(unlabelled)) / len(positive))
    return np.flatnonzero((p >= LIFT * negative) & (p - u >= ERRORS * error))


def estimate_prior(positive: Sparse, unlabelled: Sparse, size: int) -> float:
    """Ratio of unlabelled texts to positives in the region of texts that look toxic where it is surely smallest, one standard error up.

    A region is the texts with at least so many of the slots that speak most for toxicity, those of at least half the best
    surely known ratio of shares; it has to hold ``REGION`` of the positives.
    """
    error = lambda share, n: 2 * np.sqrt(np.maximum(share * (1 - share), 1 / n) / n)
    p, u = shares(positive, size), shares(unlabelled, size)
    ratio = (p - error(p, len(positive))) / (u + error(u, len(unlabelled)))
    telling = ratio >= max(ratio.max() / 2, 1)
    held, seen = (np.sort(x.dot(telling.astype(float))) for x in (positive, unlabelled))
    cuts = np.unique(held)
    above = lambda x: (len(x) - np.searchsorted(x, cuts)) / len(x)
    region, found = above(held), above(seen)
    surely = np.where(region >= REGION, (found + error(found, len(seen))) / (region - error(region, len(held))), np.inf)
    best = int(surely.argmin())
    return float(np.clip((found + error(found, len(seen)) / 2)[best] / region[best], *PRIORS))


def narrow(x: Sparse, number: np.ndarray) -> Sparse:
    """Only slots that have a number, renumbered by it."""
    slot = number[x.slots]
    used = slot >= 0
    running = np.concatenate([[0], np.cumsum(used)])
    return Sparse(slot[used], x.values[used], running[x.bounds])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", positives: int = POSITIVE_ROWS, unlabelled: int = UNLABELLED_ROWS,
          prior: float | None = None, pool: DataFrame | None = None) -> ToxicityModel:
    """Fit on at most ``positives`` confirmed texts and ``unlabelled`` texts of ``pool`` (default: ``docs``).

    Only labels of 1 are read. ``prior``, the share of toxic texts in the pool, is estimated unless it is given.
    """
    pool = docs if pool is None else pool
    read = lambda found: Sparse.of([(r["slots"], r["values"]) for r in found])
    p = read(labelled_features(docs, labels.filter(F.col(label_col) == 1), [label_col], FEATURES, positives, id_col, text_col, present=True))
    u = read(hashed(first_texts(pool, bounded_ids(pool, id_col, unlabelled), id_col, text_col), [], FEATURES, present=True)) if len(p) else p
    if not len(p) or not len(u):
        return ToxicityModel(FEATURES, np.zeros(FEATURES.slots, np.float32), -40.0)
    prior = estimate_prior(p, u, FEATURES.slots) if prior is None else min(max(prior, PRIORS[0]), PRIORS[1])
    chosen = standing_out(p, u, FEATURES.slots, prior)
    number = np.full(FEATURES.slots, -1, np.int64)
    number[chosen] = np.arange(len(chosen))
    fitted, bias = fit(narrow(p, number), narrow(u, number), prior, len(chosen))
    weights = np.zeros(FEATURES.slots, np.float32)
    weights[chosen] = fitted
    return ToxicityModel(FEATURES, weights, bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``score`` in 0 to 1 and ``predicted`` (1 from ``threshold`` on)."""
    def run(batch: pa.RecordBatch) -> dict:
        value = model.probability(*text_bytes(batch.column(text_col)))
        return {id_col: batch.column(id_col), "score": value, "predicted": pa.array((value >= threshold).astype(np.int32))}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, score double, predicted int", run)
