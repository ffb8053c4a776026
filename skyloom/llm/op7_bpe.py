"""Operator 7: BPE encoding and decoding by a bounded-lookahead streaming transducer (see bpe.py).

Null and empty texts give no ids and the digests of the empty string. Repeated rows are kept, each with its result;
a null id is kept as null. Columns other than the two named ones aren't read, so clashing names do no harm.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Decoder_of, digests, transducer_for
from .common import small_batches, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    small_batches(docs.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        made = transducer_for(path)
        return pd.Series([made.encode(t or "") for t in texts], dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), encode(F.col(text_col)).alias("ids"))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    path = path or vocabulary_path()

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        made = transducer_for(path)
        return pd.Series([Decoder_of(made.merges).feed(list(r) if r is not None else [], True) for r in rows], dtype=object)

    return encoded.select("doc_id", decode("ids").alias("text"))


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one streaming pass."""
    small_batches(docs.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def both(texts: pd.Series) -> pd.DataFrame:
        made = transducer_for(path)
        return pd.DataFrame([digests(made, t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), both.asNondeterministic()(F.col(text_col)).alias("r")).select("doc_id", "r.*")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
