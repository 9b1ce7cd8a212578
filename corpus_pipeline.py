"""From raw documents to token ids, in five stages.

Each stage takes all that the one before has kept; ``run`` writes every stage as Parquet
into the shared scratch folder and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.llm import bpe, decontaminate, languages, neardup, secrets
from assaymill.llm.common import fold, stored

ORACLE_SQL = None  # expectation-maximisation and sampled hashes have no SQL form


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with the length of the text brought up to date where there is such a column."""
    if "n_chars" not in columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that one language or a mixture of several explains; others and those without letters are rejected."""
    names, model = languages.learn(docs.where(fold("doc_id", 5) != 0))
    told = languages.annotate(docs, names, model)
    return told.where((F.col("lang_pred") != languages.UNKNOWN) & F.col("explained")).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near-duplicates."""
    return neardup.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark gone."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _measured(decontaminate.clean(docs, items), docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark."""
    return _measured(secrets.redact(docs), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and whether the ids decode to the text."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"))
    decoded = bpe.encode(rows, path, pattern, keep=("doc_id", "lang", "source", "sha"), decoded="decoded")
    return decoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
                          (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))


STAGES = [
    ("language identification", known_language),
    ("near-duplicates", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("secret scan", without_secrets),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
