"""A training corpus from raw documents: toxicity, near copies, benchmark leaks, personal data, tokens.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns what
the next one gets as its docs; all but the last return the columns of docs. ``run`` writes
every stage's result as Parquet to the shared folder and reads it again, so a lost
executor never repeats an earlier stage.

Documents without text are neither toxic, near copies nor leaks, and are encoded as no
tokens. Documents without id are scored and redacted like others but have no near copies.
Repeated rows are near copies of each other: one of equal rows stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.decontamination import decontaminate
from marquee.llm.jaccard_join import drop_near_copies
from marquee.llm.personal_data import redact
from marquee.llm.pieces import encode_texts
from marquee.llm.toxicity import drop_toxic, fit_toxicity
from marquee.session import scratch_path

PIECE_MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the span tagger does not reject."""
    return drop_toxic(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (5 words, 80 percent)."""
    return drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip) of all documents."""
    with open(public_tokenizers.path(PIECE_MODEL), "rb") as file:
        return encode_texts(docs, file.read())


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Models, latent retrieval and bootstrapping cannot be expressed in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
