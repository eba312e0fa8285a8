"""A corpus pipeline of five stages; each reads what the one before it wrote.

``STAGES`` lists them. ``run`` applies them to the documents of a folder. Between two stages the
rows are written to the shared folder and read again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, lines, near, pieces, rules
from shelfwise.llm.common import table
from shelfwise.llm.queries import content, vocabulary
from shelfwise.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality rules reject."""
    return rules.accepted(docs, vocabulary())


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts boilerplate lines out of the texts; no document goes."""
    return lines.edited(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: shingles of five words, 0.8 or more."""
    return near.unique(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document that is left."""
    return pieces.encode(docs, content("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece", tokens),
]

# Tokens have no SQL form; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
