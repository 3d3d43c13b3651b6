"""The corpus pipeline: documents to token files in five stages, one operator each.

1. language ID: documents that the classifier rejects go
2. n-gram Jaccard join: of near duplicates the smallest doc_id of a group stays
3. benchmark decontamination: documents that hold an item of ``benchmark`` go
4. mixing: documents are taken as often as the mix of their sources asks for
5. token output: the kept texts as token files, read back

Each stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import decontaminate, jaccard, langid, mixing, queries, tokens
from cartwheel.llm.common import stored

# Stages 1 and 5 run a trained classifier and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.filter(~queries.held_out(docs)))
    return langid.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # half the usual chunk: the executors' Python workers also hold what earlier stages left
    return tokens.token_binary(docs, queries.tokenizer_path(), chunk_bytes=tokens.CHUNK_BYTES // 2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix_sources),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last one."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
