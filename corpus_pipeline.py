"""Training corpus from raw documents: select, clean, remove copies, mask secrets, pack.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of documents. Models are fitted on the labelled rows of the whole documents table, since earlier stages
have removed most bad examples. Null texts count as empty, which the first stage may reject; extra columns pass
through the first four stages untouched.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.llm import near_copies, packing, quality_classifier, quality_rules, secret_scan
from stratamart.llm.bpe import BpeEncoder
from stratamart.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grades = quality_classifier.graded(_table(spark, sf_dir, "labels"))
    return quality_classifier.select(docs, quality_classifier.train(_table(spark, sf_dir, "documents"), grades))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rules.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op3's SimHash links with pigeonring filtering, joined by those of resembling shingle sets."""
    return near_copies.keep_first(docs, by_simhash=True)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, copies_once=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoder = BpeEncoder.load(public_tokenizers.path("byte_bpe_50k.json"), marks_as_text=False)
    packed = packing.pack(docs, encoder, 0)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier_stage),
    ("quality rules", quality_rules_stage),
    ("near-dedup", near_duplicates_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, "pipeline")
    return docs


# Trained models and tokenizer files cannot be expressed in SQL; tests/llm compares with plain Python.
ORACLE_SQL = None
