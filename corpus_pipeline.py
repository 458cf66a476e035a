"""The corpus pipeline: five stages from raw documents to shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmeter.llm.decontaminate import drop_leaked
from cabmeter.llm.minhash import drop_near_duplicates
from cabmeter.llm.mixture import mix_documents
from cabmeter.llm.quality import keep_good
from cabmeter.llm.queries import N_SHARDS, table
from cabmeter.llm.scratch import cut
from cabmeter.llm.shards import shard_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good. Documents without text are
    scored like the others; a document without a label is never dropped for
    that."""
    return keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest doc_id, of each group of documents that
    are alike by 5-word shingles at 0.8 or more."""
    return drop_near_duplicates(docs.select(*COLUMNS), shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no consistent template window with the benchmark."""
    return drop_leaked(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources: a document comes as often as it is taken (0
    to 3 times); the one cut document of a source holds the words taken, and
    its n_chars is that of the cut text."""
    return mix_documents(docs.select(*COLUMNS), N_SHARDS).withColumn(
        "n_chars", F.least("n_chars", F.length("text").cast("long"))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard (0 to 39) and place in the shard."""
    return shard_documents(docs.select(*COLUMNS), N_SHARDS)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# The classifier's fit and the hashes of mixing and sharding have no SQL form;
# tests/llm/test_pipeline.py holds the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
