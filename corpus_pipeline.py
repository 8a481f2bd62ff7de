"""Training-corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontaminate, pii, quality_rules
from panelcast.llm.common import written
from panelcast.llm.packing import pack_documents
from panelcast.llm.simhash_dedup import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # calibration reads no others; labels grow with the documents, so the join is a shuffle at every size
    labelled = docs.join(labels.where("quality is not null").select("doc_id").hint("merge"), "doc_id", "left_semi")
    measured = written(labelled.select("doc_id", quality_rules.stratum_of(F.col("lang")).alias("stratum"),
                                       quality_rules.metrics(F.col("text")).alias("m")), "metrics")
    cutoffs = written(quality_rules.calibrate(measured, labels), "cutoffs")
    return quality_rules.keep(docs, cutoffs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs, shingle=3, radius=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.redact(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in training sequences."""
    return pack_documents(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), cut="space_led", end_id=0)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("pii", personal_data),
    ("best_fit_packing", packed),
]

#: Not expressible in SQL: fingerprints, tokenizers and trained models take part.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k + 1 == len(STAGES) else written(out, f"stage-{name}")
    return docs
