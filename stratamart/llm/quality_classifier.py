"""Quality classifier: ordinal cumulative-link regression over hashed text.

A text with score ``f`` has grade above ``k`` with probability ``sigmoid(f - threshold[k])``; all grades share
the weights and the thresholds ascend. The expected grade is the sum of these tail probabilities.

Grades are whole numbers from 0. Defined results: a null text counts as empty and gets the score of an empty
text; an empty table gives no rows; repeated rows get equal results; of an id that repeats one text is learned from. With fewer than two grades among the
labels every row gets that grade (or 0) and is kept. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import filter_rows, map_rows, sigmoid, text_bytes
from .features import Adam, HashedText, Sparse
from .quality_rules import SCALE, labelled_features

# Graded rows that the model is fitted on; more are sampled down by a hash of the id.
TRAIN_ROWS = 3000
FEATURES = HashedText(bits=16, sizes=(3,), echoes=True)
# A text is selected if it reaches at least this grade with at least this probability.
SELECT_GRADE, SELECT_AT = 1, 0.35


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Grades of the label table: 0 low quality, 1 good but marked toxic, 2 good.

    A null mark counts as not given; a row without a quality mark has no grade.
    """
    good, toxic = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    grade = F.when(good == 0, 0).when(toxic == 1, 1).when(good == 1, 2)
    return labels.select(id_col, grade.cast("int").alias("grade"))


@dataclass
class OrdinalModel:
    features: HashedText
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades
    lowest: int = 0

    def tails(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of a grade above each threshold, one row per text."""
        score = self.features.mean_scores(data, offsets, self.weights)
        return sigmoid(score[:, None] - self.thresholds[None, :])


def fit(x: Sparse, grade: np.ndarray, size: int, steps: int = 120, rate: float = 0.1,
        ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by maximum likelihood; each grade weighs as the root of its share."""
    count = np.bincount(grade)
    links = len(count) - 1
    share = (1 / np.sqrt(np.maximum(count, 1)))[grade]
    share /= share.sum()
    # Thresholds as a first value and log gaps, so that they stay in order whatever the step.
    params = np.zeros(size + links)
    adam = Adam(rate)
    for _ in range(steps):
        gaps = np.exp(np.clip(params[size + 1:], -8, 8))
        thresholds = params[size] + np.concatenate([[0], np.cumsum(gaps)])
        score = SCALE * x.dot(params[:size])
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        upper, lower = edges[grade + 1] - score, edges[grade] - score
        cut_u, cut_l = sigmoid(upper), sigmoid(lower)
        mass = np.maximum(cut_u - cut_l, 1e-9)
        slope_u, slope_l = cut_u * (1 - cut_u), cut_l * (1 - cut_l)
        by_score = share * (slope_u - slope_l) / mass
        by_threshold = np.array([
            -(share * slope_u / mass)[grade == k].sum() + (share * slope_l / mass)[grade == k + 1].sum()
            for k in range(links)])
        tail = by_threshold[::-1].cumsum()[::-1]  # a gap moves all thresholds from its own on
        gradient = np.concatenate([SCALE * x.back(by_score, size) + ridge * params[:size], tail[:1], tail[1:] * gaps])
        params = adam.update(params, gradient)
    gaps = np.exp(np.clip(params[size + 1:], -8, 8))
    return SCALE * params[:size], params[size] + np.concatenate([[0], np.cumsum(gaps)])


def train(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          grade_col: str = "grade", rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` graded documents."""
    found = labelled_features(docs, grades, [grade_col], FEATURES, rows, id_col, text_col)
    raw = np.array([int(r[0]) for r in found], np.int64)
    values = np.unique(raw)
    if len(values) < 2:
        return OrdinalModel(FEATURES, np.zeros(FEATURES.slots, np.float32), np.zeros(0), int(values[0]) if len(values) else 0)
    # Grades that no row has are left out while fitting; their threshold is that of the next grade up.
    grade = np.searchsorted(values, raw)
    weights, thresholds = fit(Sparse.of([(r[1], r[2]) for r in found]), grade, FEATURES.slots)
    spread = thresholds[np.searchsorted(values, np.arange(values[0] + 1, values[-1] + 1)) - 1]
    return OrdinalModel(FEATURES, weights.astype(np.float32), spread, int(values[0]))


def select_probability(model: OrdinalModel, tails: np.ndarray, grade: int) -> np.ndarray:
    """Probability of at least ``grade``."""
    link = grade - model.lowest - 1
    if link < 0 or not tails.shape[1]:
        return np.ones(len(tails))
    return tails[:, link] if link < tails.shape[1] else np.zeros(len(tails))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
          grade: int = SELECT_GRADE, at: float = SELECT_AT) -> DataFrame:
    """Per row: ``expected_grade``, ``tail_probability`` of at least ``grade``, and ``kept``."""
    def run(batch: pa.RecordBatch) -> dict:
        tails = model.tails(*text_bytes(batch.column(text_col)))
        tail = select_probability(model, tails, grade)
        return {id_col: batch.column(id_col), "expected_grade": model.lowest + tails.sum(1), "tail_probability": tail,
                "kept": tail >= at}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col],
                    f"{id_col} {kind}, expected_grade double, tail_probability double, kept boolean", run)


def select(docs: DataFrame, model: OrdinalModel, text_col: str = "text", grade: int = SELECT_GRADE,
           at: float = SELECT_AT) -> DataFrame:
    """The rows of ``docs``, all columns as they were, that the classifier selects. No shuffle."""
    return filter_rows(docs, text_col, lambda column: select_probability(
        model, model.tails(*text_bytes(column)), grade) >= at)
