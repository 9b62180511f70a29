"""A training corpus from ``documents``: five stages, each one operator of :mod:`spotweave.llm`.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor kept; its result
is written as Parquet and read again as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``.

Nulls and odd rows: a null or empty text fails the quality rules and goes; a row without a doc_id is kept
as a document of its own; repeated rows of an id become one; a null source is a source; extra columns pass
through all stages.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.batches import read_table
from spotweave.llm.decontamination import BUDGET_PERCENT, keep_clean
from spotweave.llm.mixing import mix
from spotweave.llm.near_duplicates import keep_one_of_each
from spotweave.llm.pii import mask_personal_data
from spotweave.llm.quality import keep_quality
from spotweave.storage import release, stored

#: Near duplicates share at least so many per cent of their five-word shingles.
SIMILAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near some language reference."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least doc_id."""
    return keep_one_of_each(docs, SIMILAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"), BUDGET_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets and ``n_chars`` counted anew."""
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says, numbered by ``copy``."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing_sources),
]

#: SQL can't express the divergence rules over fitted references, the random field or the similarity join.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole of ``documents``."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
