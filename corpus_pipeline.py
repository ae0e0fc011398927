"""From raw documents to packed training sequences: five stages over a documents table.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, langid, packing, pii, simhash
from riskloom.llm.frames import stored, table
from riskloom.llm.queries import END_ID, TOKENIZER

#: No SQL: a trained model, hashes and a tokenizer decide. tests/llm compares the stages with brute force.
ORACLE_SQL = None


def _length(docs: DataFrame) -> str | None:
    return "n_chars" if "n_chars" in docs.columns else None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier accepts."""
    rows, _, _, accepted = langid.identify(docs, langid.fit(docs))
    return rows.where(F.col(accepted)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the test items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), length=_length(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redact(docs, length=_length(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are stored before the next."""
    rows = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if k < len(STAGES) - 1:
            rows = stored(rows, name)
    return rows
