"""Corpus pipeline: documents to sampled token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared scratch folder and reads it back
as the next one's documents.  All stages but the last return the columns of
documents.

1. quality rules: documents that a rule rejects go;
2. n-gram Jaccard join: one document of every near-duplicate group stays (the
   smallest doc_id); documents without words stay;
3. suffix-array dedup: bytes covered by a 200-byte string that occurs anywhere
   else go from the texts, n_chars follows; a text may become empty;
4. mixing: documents are repeated 0 to 2 times so that sources reach their
   target shares; a document without words stays once;
5. SentencePiece: one sampled segmentation per row, seeded by doc_id.

Null texts are rejected by stage 1, null keys and sources pass; an empty table
passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import written
from llm.mixing import mix_sources, repeated
from llm.pieces import encode_sampled
from llm.quality import keep_good
from llm.shingle_join import keep_first
from llm.suffix_dedup import remove_repeats

PIECE_MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeated(mix_sources(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_sampled(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(PIECE_MODEL))
    return encoded.select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"),
                          "ids")


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("suffix_dedup", suffix_dedup),
          ("mixing", mixing), ("sentencepiece", sentencepiece)]

# Mixing draws at random and the encoding samples: SQL cannot express them (see tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
