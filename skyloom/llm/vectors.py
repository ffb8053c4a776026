"""Reading of embedding columns: which vectors take part, and as what."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_vector(v) -> np.ndarray | None:
    """The vector in double precision; None if it's null, empty, zero or holds a null or non-finite component."""
    if v is None:
        return None
    try:
        a = np.asarray(v, dtype=np.float64)
    except (TypeError, ValueError):
        return None
    if a.ndim != 1 or not len(a) or not np.isfinite(a).all() or not a.any():
        return None
    return a


def stored(a: np.ndarray) -> bytes:
    """The vector's bytes: single precision where that's exact, which halves what is moved; else double."""
    small = a.astype(np.float32)
    return (small if (small == a).all() else a).tobytes()


def loaded(raws, dim: int) -> np.ndarray:
    """Rows x dim in double precision from what :func:`stored` made."""
    raws = list(raws)
    if all(len(r) == 4 * dim for r in raws):
        return np.frombuffer(b"".join(raws), np.float32).reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64).astype(np.float64) for r in raws])


def read_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, vec, cls, norm2) of every row; all but vec_id are null for vectors that take no part. cls: a digest of the vector."""

    @F.pandas_udf("dim int, vec binary, cls binary, norm2 double")
    def read(column: pd.Series) -> pd.DataFrame:
        got = [as_vector(v) for v in column]
        of = lambda f: [None if a is None else f(a) for a in got]
        made = {"dim": of(len), "vec": of(stored), "cls": of(lambda a: xxhash.xxh3_128_digest((a + 0.0).tobytes())), "norm2": of(lambda a: float(a @ a))}
        return pd.DataFrame(made).astype({"dim": "Int32", "norm2": "Float64"})

    told = vectors.select(F.col(id_col).cast("long").alias("vec_id"), read.asNondeterministic()(F.col(vec_col)).alias("r"))
    return told.select("vec_id", "r.*")
