"""From raw documents to packed training sequences: stages that each apply one operator to what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from transfero.llm.common import store, table
from transfero.llm.op03_mixing import mixture
from transfero.llm.op05_packing import pack
from transfero.llm.op07_similarity_join import one_of_each
from transfero.llm.op08_secrets import redact
from transfero.llm.op10_language import known_language

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", lambda spark, docs, sf_dir: known_language(docs)),
    ("n-gram Jaccard join", lambda spark, docs, sf_dir: one_of_each(docs)),
    ("secret scans", lambda spark, docs, sf_dir: redact(docs)),
    ("mixing sources to target weights", lambda spark, docs, sf_dir: mixture(docs)),
    ("packing", lambda spark, docs, sf_dir: pack(docs)),
]

#: Language models, Markov models and NNLS are not SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
