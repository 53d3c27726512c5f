"""A corpus pipeline of five operators of ``facetspark.llm``.

Each stage takes the documents its predecessor kept (columns doc_id, text,
lang, source, n_chars; others are carried) and works on all of them:

1. quality rules: documents that the rules reject go;
2. SimHash: one document of each group of near-duplicates stays;
3. personal data: every span found is replaced by its kind;
4. mixing: documents are cut to the words that each pass of the source mix
   takes, one row per document and pass;
5. BPE: token ids of every text and their decoding.

``run`` writes each stage's result as a table in the shared checkpoint folder
and reads it as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetspark.llm import bpe, mixing, pii, quality, simhash
from facetspark.llm.common import with_columns
from facetspark.llm.queries import tokenizer
from facetspark.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(docs.withColumn("__all", F.struct("*")))
    return judged.where("kept").select("__all.*")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs, shingle_words=3, max_bits=2)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(docs, pii.redact(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = mixing.mix(docs, weights=(3, 1, 2), share=1.5, most=2.0)
    return _sized(docs, mixing.mixed_documents(docs, plan).drop("__epoch"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    coded = bpe.encode(docs.select("doc_id", "text"), path).select("doc_id", "ids")
    return with_columns(bpe.decode(coded, path), {"n_tokens": F.size("ids").cast("long")})


def _sized(docs: DataFrame, out: DataFrame) -> DataFrame:
    """``out`` with n_chars brought up to date, columns as in ``docs``."""
    sized = with_columns(out, {"n_chars": F.length("text").cast("long")}) if "n_chars" in docs.columns else out
    return sized.select(*docs.columns)


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("personal data", personal_data_stage),
    ("source mixing", mixing_stage),
    ("bpe encoding", bpe_stage),
]

# Not expressible in SQL: 64-bit hashes, EM, permutations and BPE. Tested
# against a brute-force version in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
