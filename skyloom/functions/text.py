"""Column functions over names and identifiers.

``compat`` repeats the eager system's handling of nulls (they become words and match each other); the default keeps nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_name(c: Column | str, compat: bool = False) -> Column:
    """Lower case, without white space at the ends."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.lower(F.regexp_replace(c.cast("string"), r"(?U)(^\s+)|(\s+$)", ""))
    return F.coalesce(out, F.lit("nan")) if compat else out


def parse_id(c: Column | str) -> Column:
    """The first run of ten digits or more as a long; null where there's none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(c.cast("string"), "([0-9]{10,})", 1), F.lit("")).try_cast("bigint")


def to_number(c: Column | str) -> Column:
    """As a double; null where that fails, and for NaN."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def alias_value(c: Column) -> Column:
    """How an identifier stands in alias tables."""
    return F.lower(F.trim(c.cast("string")))


def utc_stamp() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")


def nan_to_null(df):
    """NaN becomes null in all floating columns, so that comparisons and averages see missing values only."""
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))
