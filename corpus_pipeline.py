"""A corpus pipeline of five stages; each works on all that the one before kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Nulls, empty texts and repeated rows
are treated as the operators' modules say. An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm.common import clean, materialize, table, written
from skyloom.llm.op3_toxicity import reject_toxic
from skyloom.llm.op4_packing import pack_documents, sequences
from skyloom.llm.op5_jaccard import keep_one_of_each
from skyloom.llm.op6_language import reject_unknown_language
from skyloom.llm.op8_pii import redact
from skyloom.ship import shipped


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place. A null text counts as empty: a piece of the end mark. Repeated rows and
    null ids are kept. The packed ids themselves come from :func:`packed_sequences`."""
    return pack_documents(docs)


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus: (sequence_id, ids binary, n) of what the filtering stages keep."""
    return sequences(kept(spark, sf_dir))


STAGES = [
    ("toxicity", shipped(reject_toxic)),
    ("language", shipped(reject_unknown_language)),
    ("near_duplicates", shipped(keep_one_of_each)),
    ("personal_data", shipped(redact)),
    ("packing", shipped(_pack)),
]

#: Trained models and tokenizers have no form in SQL; tests/llm/test_pipeline.py holds each stage against a plain Python version.
ORACLE_SQL = None


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages but the last leave of documents; what each returns is written and read again, and then all that the stage and
    those before it wrote besides is deleted."""
    docs, first = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        clean(spark, first, keep=docs)
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    return STAGES[-1][1](spark, kept(spark, sf_dir), sf_dir)
