"""A corpus from raw documents to tokens: each stage reads what the one before it has kept.

Toxic documents go, of each group of near copies one stays, documents that hold benchmark passages go, secrets are
replaced by a mark, and what is left is encoded. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from signwatch.lineage import scratch
from signwatch.llm import contamination, pieces, queries, secrets, shingle_join, toxicity

#: Bytes of rows that a Python worker is given at once. With Spark's 64 MB, each task of an executor holds such a batch of
#: whole texts several times: in the JVM's buffers, in the worker, and again when the kept rows return.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def stage(f):
    """A stage of the corpus: its Python workers get their rows in batches of ``BATCH_BYTES``, unless the user has set a size.

    What a stage returns is planned when it is written, so the setting stays with the session.
    """

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, str(BATCH_BYTES))
        return f(spark, docs, sf_dir)

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a toxicity score of 0.3 or more; the labels of all folds train the models."""
    model = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of links: sets of five-word shingles with a similarity of 0.8 or more."""
    return shingle_join.drop_near_duplicates(docs, words=5, percent=80)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item."""
    return contamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mark."""
    return secrets.redact(docs, secrets.fit(docs))


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text."""
    return pieces.encode(docs, pieces.vocabulary_of(spark))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding", encode),
]

#: The trained models of the first and fourth stages have no SQL form; tests/llm holds the run against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written as Parquet and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, step in STAGES:
        at = f"{folder}/{name.replace(' ', '-')}-{uuid.uuid4().hex[:8]}"
        step(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
