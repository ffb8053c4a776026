"""Column discovery by name (the first in column order wins) and the one-pass column profile that data-dependent schemas need."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most rows of a block, a power of two, see :func:`in_blocks`.
BLOCK = 256
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class MissingColumns(KeyError):
    """Columns that an operator can't do without."""


def require(df: DataFrame, *names: str) -> None:
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise MissingColumns(f"columns not found: {', '.join(lacking)}")


def first(df: DataFrame | Iterable[str], test: Callable[[str], bool]) -> str | None:
    names = df.columns if isinstance(df, DataFrame) else df
    return next((c for c in names if test(c)), None)


def holding(*parts: str) -> Callable[[str], bool]:
    """All parts occur, whatever the case."""
    return lambda c: all(p in c.lower() for p in parts)


def ending(*ends: str, but: str | None = None) -> Callable[[str], bool]:
    return lambda c: c.lower().endswith(ends) and not (but and c.lower().endswith(but))


def among(*names: str) -> Callable[[str], bool]:
    return lambda c: c.lower() in names


def id_column(df: DataFrame) -> str | None:
    return first(df, holding("gaia", "id"))


def coordinates(df: DataFrame) -> tuple[str, str] | None:
    ra, dec = first(df, among("ra", "ra_deg", "right_ascension", "alpha")), first(df, among("dec", "dec_deg", "decl", "declination", "delta"))
    return (ra, dec) if ra and dec else None


def host_column(df: DataFrame) -> str | None:
    return first(df, among("hostname", "host", "star_name", "name"))


def numeric_columns(df: DataFrame, with_boolean: bool = False) -> list[str]:
    return [c for c, t in df.dtypes if t.startswith(NUMERIC) or (with_boolean and t == "boolean")]


def filled(df: DataFrame, names: Iterable[str] | None = None) -> dict[str, int]:
    """Non-null values of each column, all in one job."""
    names = list(df.columns if names is None else names)
    if not names:
        return {}
    row = df.agg(*(F.count(F.col(f"`{c}`")).alias(str(k)) for k, c in enumerate(names))).first()
    return {c: row[k] for k, c in enumerate(names)}


def prefixed(df: DataFrame, source: str, keep: Iterable[str] = ()) -> DataFrame:
    """All columns but ``keep`` get the source's name in front, in one projection."""
    return df.select(*(F.col(f"`{c}`").alias(c if c in keep else f"{source}_{c}") for c in df.columns))


def with_row_index(df: DataFrame, name: str = "_row_idx") -> DataFrame:
    """An explicit row index in scan order: increasing, unique, not dense. Materialise it before use in two plans."""
    return df if name in df.columns else df.withColumn(name, F.monotonically_increasing_id())


def record_id(df: DataFrame, index: str = "_row_idx", name: str = "pl_name") -> DataFrame:
    """``record_id`` from the row index and the planet's name; only if absent."""
    if "record_id" in df.columns:
        return df
    text = F.col(index).cast("string")
    return df.withColumn("record_id", F.concat_ws("_", text, F.coalesce(F.col(name), F.lit("unknown"))) if name in df.columns else text)


def drop_listed(df: DataFrame, names: Iterable[str] = ("P_NAME", "S_NAME")) -> DataFrame:
    return df.drop(*names)


def dealt(df: DataFrame, *keys: str, times: int = 4) -> DataFrame:
    """Dealt by the keys (evenly without any) into a number of partitions that adaptive execution leaves alone. It goes by the bytes read, so it would put many keys of small rows into a few tasks
    that make nearly all pairs; and a task with few keys writes few different values again and again, which files store in little space."""
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def in_blocks(df: DataFrame, rows: str, *keys: str, more: Iterable[Column] = ()) -> DataFrame:
    """The keys and, in ``rows``, an array of up to BLOCK rows of a key, which hold all other columns; ``more`` are further aggregates of these.
    ``df`` is dealt by the keys and sorted by them first."""
    at = F.shiftright(F.monotonically_increasing_id(), BLOCK.bit_length() - 1)
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in keys))
    return df.withColumn("_block", at).groupBy(*keys, "_block").agg(F.collect_list(row).alias(rows), *more).drop("_block")


def pairs_of(blocks: DataFrame, left: str, right: str) -> DataFrame:
    """All pairs of rows of two blocks that were joined; a block that met none gives rows with nulls. A block's rows come again and again, each time with one row of the other side:
    short cycles and runs, which files store in little space however many rows a key has, where all rows of a key in turn would take their full width."""
    # the lambda isn't compiled into the join's loop, which would hold all pairs that a left block makes; so it hands on the rows of one block at a time
    one = blocks.select(left, F.inline_outer(F.transform(right, lambda x: x)))
    return one.select(F.inline_outer(left), *(F.col(f"`{c}`") for c in one.columns[1:]))
