"""Corpus preparation in stages: each reads what the one before it kept.

Stages are (name, function) with function(spark, docs, sf_dir) -> DataFrame; labels and benchmark are
read from sf_dir. All but the last return the columns they got. Null texts count as empty; an empty
text is clean, equal to every other empty one, and packs as its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, neardups, packing, pii, toxicity
from ledgerloom.llm.frames import session, stored, table
from ledgerloom.llm.tokens import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of labelled documents does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal and similar texts."""
    session(spark)
    return neardups.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty stand in a benchmark passage."""
    return decontamination.without_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    session(spark)
    masked = pii.redacted(docs)
    changed = F.char_length("text").cast(masked.schema["n_chars"].dataType) if "n_chars" in masked.columns else None
    return masked if changed is None else masked.withColumn("n_chars", F.coalesce(changed, "n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, cut and packed into sequences: one row per piece."""
    session(spark)
    return packing.pack(packing.token_pieces(docs, vocabulary(), end_id=1))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: No SQL: tokenizers, trained models and local search are beyond it; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
