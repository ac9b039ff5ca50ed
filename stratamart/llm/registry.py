"""The operators as queries over whole tables, with production parameters.

Only op13 can be written as SQL for DuckDB: the others need trained models, tokenizer files, XXH64 with a seed, CRC-32
or match positions. ``tests/llm`` holds brute-force versions.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, hard_negatives, language_id, packing, periodic_runs, quality_classifier, quality_rules
from . import secret_scan, simhash, token_files, toxicity, winnowing
from .bpe import BpeEncoder
from .byte_bpe import ByteBpe
from .common import crc_mod, map_rows
from .sentencepiece_codec import Codec, map_encoded

PIECE_MODEL, BPE_MODEL, BPE_RANKS = "piece_bpe_32k.model", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
FILE_END, PACK_END = 2, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = Codec.load(public_tokenizers.path(PIECE_MODEL))

    def finish(sources, encoded):
        sha = lambda data: hashlib.sha256(data).hexdigest()
        return {
            "n_tokens": [len(e.ids) for e in encoded],
            "ids_sha256": [sha(",".join(map(str, e.ids)).encode()) for e in encoded],
            "decoded_sha256": [sha(codec.decode(e.ids).encode()) for e in encoded],
            "spans_sha256": [sha(np.stack([e.starts, e.ends]).astype("<i8").tobytes()) for e in encoded],
            "bytes_covered": [int((e.ends - e.starts).sum()) for e in encoded],
        }

    return map_encoded(table(spark, sf_dir, "documents"), codec, "n_tokens long, ids_sha256 string, decoded_sha256 string, "
                       "spans_sha256 string, bytes_covered long", finish)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out), pool=docs.filter(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", "predicted")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents"), copies_once=True))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = BpeEncoder.load(public_tokenizers.path(BPE_MODEL), marks_as_text=False)
    manifest = token_files.write(table(spark, sf_dir, "documents"), encoder, FILE_END)
    return token_files.read(manifest, lambda key, start, ids: (key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
                            "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    found = language_id.predict(docs, language_id.train(docs.filter(~held_out)))
    return found.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = BpeEncoder.load(public_tokenizers.path(BPE_MODEL), marks_as_text=False)
    packed = packing.pack(table(spark, sf_dir, "documents"), encoder, PACK_END)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, quality_classifier.graded(table(spark, sf_dir, "labels")))
    return quality_classifier.score(docs, model)


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of an id that the query plants a period in, from a place and of a length that follow from the id."""
    n = len(words)
    if doc_id is None or not n:
        return words
    group, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    first = group % n
    period = 1 + (n - first) // (3 + group % 8)
    unit = words[first:first + period]
    return words[:first] + (unit * (-(-(n - first) // period)))[:n - first]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = lambda data: hashlib.sha256(data).hexdigest()
    names = ("start", "length", "period", "exponent_milli")

    def run(batch) -> dict:
        out = {n: [] for n in ("n_runs", *names, "runs_sha256", "collapsed_sha256")}
        for words, runs in periodic_runs.scanned(batch, "doc_id", "text", planted_period):
            best = periodic_runs.strongest(runs)
            values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs.tolist())
            row = (len(runs), *values, sha(listed.encode()), sha(periodic_runs.collapsed(words, runs)))
            for column, value in zip(out.values(), row):
                column.append(value)
        numbers = {n: pa.array(out[n], pa.int64()) for n in ("n_runs", *names)}
        return {"doc_id": batch.column("doc_id"), **numbers, "runs_sha256": out["runs_sha256"], "collapsed_sha256": out["collapsed_sha256"]}

    return map_rows(table(spark, sf_dir, "documents"), ["doc_id", "text"], "doc_id long, n_runs long, start long, length long, "
                    "period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string", run)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = ByteBpe.load(public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batch) -> dict:
        found = [bpe.encode(t) for t in byte_bpe.texts(batch.column("text"))]
        return {"doc_id": batch.column("doc_id"), "n_tokens": [len(ids) for ids in found],
                "ids_sha256": [sha(bpe.digits(ids).encode()) for ids in found],
                "decoded_sha256": [sha(bpe.decode(ids)) for ids in found]}

    return map_rows(table(spark, sf_dir, "documents"), ["doc_id", "text"],
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.shifted_labels(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_sentencepiece, op2_quality_rules, op3_simhash, op4_toxicity, op5_secret_scan, op6_winnowing,
             op7_token_files, op8_language_id, op9_packing, op10_quality_classifier, op11_periodic_runs, op12_byte_bpe,
             op13_hard_negatives]
    return {f.__name__: f for f in found}


HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label,
           CAST(list_dot_product(a.vector, v.vector) AS BIGINT) AS score
    FROM vectors a JOIN vectors v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, s.vec_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id
WHERE s.label <> s.anchor_label AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER best <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_hard_negatives": HARD_NEGATIVES}
