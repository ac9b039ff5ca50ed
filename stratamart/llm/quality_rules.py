"""Quality rules: base counts, and a calibrated logistic regression over hashed word and character n-grams.

Defined results: a null or blank text has no words, so it fails the base rules and is not kept; ties and
repeated rows are judged row by row; an empty table gives no rows. Of an id that repeats the text with the smallest
hash is learned from. Without labels of both kinds the model is constant and the base rules decide alone. Columns other
than the id and the text are never read. The model depends on the rows, not on how they lie in files.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_labels, crc_mod, filter_rows, map_rows, one_label, sigmoid, text_bytes
from .features import Adam, HashedText, Sparse

# The base rules' symbols and bounds, and the probability from which a text is kept.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_AT = 0.35

# Labelled rows that the model is fitted on; more labels are sampled down by a hash of the id.
TRAIN_ROWS = 3000
FEATURES = HashedText(bits=16, sizes=(4,), characters=True)
SCALE = 30.0

_SYMBOL_BYTES = bytes(c for c in range(256) if chr(c) not in SYMBOLS)
_BLANK = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in repeated three-word windows."""
    words = text.split()  # on bytes: exactly space and \x09-\x0D
    n = len(words)
    continuation = len(text) - len(text.decode("utf-8", "replace")) if not text.isascii() else 0
    word_chars = sum(map(len, words)) - continuation
    symbols = len(text.translate(None, _SYMBOL_BYTES))
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in text.split(b"\n"):
        if line.strip(_BLANK):
            if line in seen:
                repeated_lines += 1
            else:
                seen.add(line)
    return n, word_chars, symbols, repeated_lines, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    window = ids[:-2]
    for following in (ids[1:-1], ids[2:]):
        # Numbered again after each word, so the code stays below the square of the number of windows.
        window = np.unique(window * len(number) + following, return_inverse=True)[1]
    twice = np.bincount(window)[window] >= 2
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


@dataclass
class QualityModel:
    """``slope * score + offset`` is the calibrated log-odds of good quality."""

    features: HashedText
    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.features.mean_scores(data, offsets, self.weights) + self.offset)


def first_texts(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``keys`` with the ``_text`` of each ``_key`` that a document has; of several the one with the smallest hash.

    ``keys`` is a bounded sample and is broadcast. Each task keeps one text a key before the shuffle, so an id that repeats
    without end gathers nowhere.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = rows.join(F.broadcast(keys), F.col("_id") == F.col("_key"))
    first = found.groupBy(*keys.columns).agg(F.min(F.struct(F.xxhash64("_text").alias("hash"), "_text")).alias("_first"))
    return first.select(*keys.columns, F.col("_first._text").alias("_text"))


def hashed(found: DataFrame, names: list[str], features: HashedText, present: bool = False) -> list:
    """Per row of ``_key``, ``_text`` and the values ``names``: the values, slots, numbers and a fourth by the key's hash.

    The order depends on the rows alone.
    """
    def encode(batch: pa.RecordBatch) -> dict:
        pairs = list(features.sparse_rows(*text_bytes(batch.column("_text")), present=present))
        return {**{n: batch.column(n) for n in names}, "slots": [s.tobytes() for s, _ in pairs],
                "values": [v.tobytes() for _, v in pairs], "fourth": batch.column("fourth")}

    schema = ", ".join(f"{n} double" for n in names) + (", " if names else "") + "slots binary, values binary, fourth long"
    rows = map_rows(found.withColumn("fourth", crc_mod("_key", 4)), [*names, "_text", "fourth"], schema, encode)
    return sorted(rows.collect(), key=lambda r: (r["fourth"], r["slots"], r["values"], *r[:len(names)]))


def labelled_features(docs: DataFrame, labels: DataFrame, values: list[str], features: HashedText, bound: int,
                      id_col: str = "doc_id", text_col: str = "text", present: bool = False) -> list:
    """Label values and hashed features of at most ``bound`` labelled documents, one of each labelled id (see ``hashed``).

    Labels given twice count once.
    """
    sample = bounded_labels(one_label(labels, id_col, *values), id_col, bound)
    names = [f"_label{i}" for i in range(len(values))]
    keys = sample.select(F.col(id_col).alias("_key"), *[F.col(v).cast("double").alias(n) for v, n in zip(values, names)])
    return hashed(first_texts(docs, keys, id_col, text_col), names, features, present)


def fit_logistic(x: Sparse, y: np.ndarray, size: int, steps: int = 120, rate: float = 0.1, ridge: float = 1e-4):
    """Weights and bias; the two classes weigh alike."""
    weights = np.zeros(size + 1)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    adam = Adam(rate)
    for _ in range(steps):
        error = (sigmoid(SCALE * x.dot(weights[:-1]) + weights[-1]) - y) * share
        gradient = np.append(SCALE * x.back(error, size) + ridge * weights[:-1], error.sum())
        weights = adam.update(weights, gradient)
    return weights[:-1], weights[-1]


def calibration_loss(line: np.ndarray, score: np.ndarray, target: np.ndarray) -> float:
    value = line[0] * score + line[1]
    return float((np.logaddexp(0, value) - target * value).mean())


def calibrate(score: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-back scores, on smoothed targets.

    Newton steps on scores of unit spread, each halved until the loss falls, so it never ends above the start (slope 1).
    """
    up, down = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    spread = float(np.std(score)) or 1.0
    score = score / spread
    line, design = np.array([spread, 0.0]), np.stack([score, np.ones_like(score)], 1)
    loss = calibration_loss(line, score, target)
    for _ in range(steps):
        p = sigmoid(design @ line)
        curve = (design * (p * (1 - p))[:, None]).T @ design / len(score) + 1e-9 * np.eye(2)
        step, share = np.linalg.solve(curve, design.T @ (p - target) / len(score)), 1.0
        while share > 1e-12 and calibration_loss(line - share * step, score, target) >= loss:
            share /= 2
        if share <= 1e-12:
            break
        line = line - share * step
        loss = calibration_loss(line, score, target)
    return float(line[0] / spread), float(line[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> QualityModel:
    """Fit on three of four sampled rows by a hash of the id, calibrate on the fourth. Bounded by ``rows`` labelled documents."""
    found = labelled_features(docs, labels, [label_col], FEATURES, rows, id_col, text_col)
    y = np.array([r[0] for r in found])
    if len(y) < 8 or len(set(y)) < 2:
        return QualityModel(FEATURES, np.zeros(FEATURES.slots, np.float32), 0.0, 40.0)
    back = np.array([r["fourth"] for r in found]) == 3
    if len(set(y[~back])) < 2:
        back[:] = False
    part = lambda mask: Sparse.of([(r[1], r[2]) for r, m in zip(found, mask) if m])
    x = part(~back)
    weights, bias = fit_logistic(x, y[~back], FEATURES.slots)
    held, target = (part(back), y[back]) if len(set(y[back])) == 2 else (x, y[~back])
    slope, offset = calibrate(SCALE * held.dot(weights) + bias, target)
    return QualityModel(FEATURES, (SCALE * weights).astype(np.float32), slope, offset + slope * float(bias))


def judge(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
          keep_at: float = KEEP_AT) -> DataFrame:
    """Per row: the counts, ``base_failed``, the calibrated ``probability`` and ``kept``."""
    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = text_bytes(batch.column(text_col))
        counts = [base_counts(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        failed = np.array([base_failed(c[0], c[4]) for c in counts], bool)
        probability = model.probability(data, offsets)
        return {id_col: batch.column(id_col), **{n: pa.array([c[i] for c in counts], pa.int64()) for i, n in enumerate(COUNTS)},
                "base_failed": failed, "probability": probability, "kept": ~failed & (probability >= keep_at)}

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, " + ", ".join(f"{n} long" for n in COUNTS) + ", base_failed boolean, probability double, kept boolean"
    return map_rows(docs, [id_col, text_col], schema, run)


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs``, all columns as they were, that the rules keep. No shuffle."""
    def keep(column: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(column)
        good = model.probability(data, offsets) >= keep_at
        for row in np.flatnonzero(good):
            words = data[offsets[row]:offsets[row + 1]].tobytes().split()
            good[row] = not base_failed(len(words), repeated_words(words) if len(words) >= MIN_WORDS else 0)
        return good

    return filter_rows(docs, text_col, keep)
