"""From raw documents to packed training sequences: five stages over whole tables.

toxicity      documents that the class-conditional models reject go
exact_dedup   of equal texts the row with the largest id stays
near_dedup    of each class of near-duplicates one document stays
secrets       secrets in texts are replaced by their kind
packing       texts become token sequences

Every stage reads what its predecessor kept, as Parquet. Each takes NULLs in any column, repeated rows, an empty table
and columns named like its own; all but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arearisk.llm import exactdup, neardup, packing, secrets, toxicity
from arearisk.scratch import materialize


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents that are still there. Without labels, or for a NULL or empty text, see `toxicity.drop_toxic`."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """NULL texts count as empty, so one row of all without text stays; of rows equal in all but the id the largest id."""
    return exactdup.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of fewer than five words are near none and stay; classes without any id are named by their text."""
    return neardup.drop_near(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No row goes; NULL stays NULL; `n_chars` follows the text."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A NULL or empty text is its end id alone."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("secrets", hide_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages learn, sample by hash and tokenize, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
