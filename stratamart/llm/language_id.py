"""Language identification by rank-order profiles.

A profile is the ``RANKS`` most frequent character n-grams (one to three letters, words bounded by a blank) of a
language, in order. A text is given the language whose profile lies nearest: the sum, over the text's own most
frequent n-grams, of how far each is out of place, or ``RANKS`` if the profile lacks it.

Ties: equal counts rank by the n-gram's code; equal distances go to the first language in order. Defined
results: a text that is null or has no letter is ``und`` with score 0; repeated rows get equal results; an empty
table gives no rows; without any learned language every text is ``und``. Only id and text are read of the texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, texts

RANKS = 300
# Labelled texts that a language's profile is learned from; more are sampled down by a hash of the id.
TRAIN_ROWS = 2000
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_POINT_BITS = 21
# Code points of text that one n-gram count takes; longer texts are counted part by part.
_STEP = 1 << 20


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of a text and their counts, in code order; none for a text without letters."""
    plain = _OTHER.sub(" ", text).lower().strip()
    if not any(map(str.isalpha, plain)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    found, counts = [], []
    for first in range(0, len(points), _STEP):
        part = points[first:first + _STEP + 2]
        one = part[:_STEP]
        two = (part[:-1] << _POINT_BITS | part[1:])[:_STEP]
        three = (part[:-2] << 2 * _POINT_BITS | part[1:-1] << _POINT_BITS | part[2:])[:_STEP]
        # A blank inside a two- or three-gram of two words says nothing about the language.
        three = three[part[1:-1][:_STEP] != 32]
        code, count = np.unique(np.concatenate([one[one != 32], two, three]), return_counts=True)
        found.append(code)
        counts.append(count)
    if len(found) == 1:
        return found[0], counts[0]
    code, place = np.unique(np.concatenate(found), return_inverse=True)
    return code, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def ranked(code: np.ndarray, count: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    if len(code) > ranks:
        least = np.partition(count, len(count) - ranks)[len(count) - ranks]
        kept = count >= least
        code, count = code[kept], count[kept]
    return code[np.lexsort((code, -count))][:ranks]


@dataclass
class Profiles:
    """Known n-gram codes in order, and per language and code the rank (``RANKS`` if the profile lacks it)."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, profiles: dict[str, np.ndarray]) -> "Profiles":
        languages = sorted(profiles)
        codes = np.unique(np.concatenate([profiles[n] for n in languages])) if languages else np.zeros(0, np.int64)
        ranks = np.full((len(languages), len(codes) + 1), RANKS, np.int64)  # the last column is for other n-grams
        for row, name in enumerate(languages):
            ranks[row, np.searchsorted(codes, profiles[name])] = np.arange(len(profiles[name]))
        return cls(languages, codes, ranks)

    def predict(self, text: str) -> tuple[str, float]:
        """Language, and how much nearer its profile is than a profile that shares nothing (0 to 1)."""
        top = ranked(*grams(text))
        if not len(top) or not self.languages:
            return UNKNOWN, 0.0
        place = np.minimum(np.searchsorted(self.codes, top), max(len(self.codes) - 1, 0))
        column = np.where(self.codes[place] == top, place, len(self.codes))
        out_of_place = np.minimum(np.abs(self.ranks[:, column] - np.arange(len(top))), RANKS)
        out_of_place[self.ranks[:, column] == RANKS] = RANKS
        distance = out_of_place.sum(1)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (RANKS * len(top))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = TRAIN_ROWS) -> Profiles:
    """Profiles from about ``rows`` texts a language, chosen by a hash of the id; rows without a language are left out."""
    known = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    sizes = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}  # a row per language
    spread = 1 << 30
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(spread * min(1, rows / n)))]),
                         F.col("_lang")) if sizes else F.lit(0)
    sample = known.filter(F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(spread)) < share)

    def count(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"lang": [], "code": [], "n": []}
        by: dict[str, list] = {}
        for name, text in zip(batch.column("_lang").to_pylist(), texts(batch.column("_text"))):
            by.setdefault(name, []).append(grams(text))
        for name, found in by.items():
            code, place = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            total = np.bincount(place, np.concatenate([n for _, n in found]), minlength=len(code)).astype(np.int64)
            out["lang"] += [name] * len(code)
            out["code"] += code.tolist()
            out["n"] += total.tolist()
        return {"lang": pa.array(out["lang"], pa.string()), "code": pa.array(out["code"], pa.int64()),
                "n": pa.array(out["n"], pa.int64())}

    counted = map_rows(sample, ["_lang", "_text"], "lang string, code long, n long", count)
    top = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("order"), "code"))), 1, RANKS)
    # Distinct n-grams of a bounded sample; the best of each part first, so no list holds them all.
    totals = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    parts = totals.groupBy("lang", F.pmod(F.xxhash64("code"), F.lit(64)).alias("part")).agg(top.alias("top"))
    best = parts.select("lang", F.explode("top").alias("t")).select("lang", "t.code", (-F.col("t.order")).alias("n"))
    rows_found = best.groupBy("lang").agg(top.alias("top")).collect()  # RANKS codes per language
    return Profiles.of({r["lang"]: np.array([t["code"] for t in r["top"]], np.int64) for r in rows_found})


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``lang_pred`` and ``score``."""
    def run(batch: pa.RecordBatch) -> dict:
        found = [profiles.predict(t) for t in texts(batch.column(text_col))]
        return {id_col: batch.column(id_col), "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64())}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, lang_pred string, score double", run)
