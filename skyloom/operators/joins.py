"""Equi-joins of a primary table with a source by identifier or name; the source's columns get its name in front.

Keys are computed columns, so Catalyst picks broadcast or sort-merge, and adaptive execution splits hot keys. ``compat``
lets null keys match each other, as eager frames do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_name, parse_id, to_number
from .columns import dealt, first, holding, host_column, id_column, in_blocks, pairs_of, prefixed, require, with_row_index
from .missing import keep_first
from .names import most_similar, similar_pairs

HOW = {"left": "left", "right": "right", "inner": "inner", "outer": "full", "full": "full", "cross": "cross"}


def join_on(primary: DataFrame, source: DataFrame, name: str, left: Callable[[], Column], right: Callable[[], Column], how: str = "left", compat: bool = False, one_each: bool = False, fan_out: bool = False) -> DataFrame:
    """``left`` and ``right`` make the key of each side. ``one_each``: of source rows with the same key, only the first in scan order is joined.
    ``fan_out``: keys repeat on both sides, so the result is far larger than its input; both are dealt by key alone, see :func:`~.columns.dealt`, and
    meet in blocks, see :func:`~.columns.pairs_of`. All columns are in these, so select what is needed before."""
    if how not in HOW:
        raise ValueError(f"unknown join: {how}")
    keyed = source.withColumn("_r", right())
    if one_each:
        # by _src_idx where the source has it; combined before the exchange that the join needs anyway
        keyed = keep_first(with_row_index(keyed, "_src_idx"), ["_r"], "_src_idx").select(*source.columns, "_r")
    l_key, r_key = primary.withColumn("_l", left()), prefixed(keyed, name, keep=("_r",))
    if how == "cross":
        return l_key.crossJoin(r_key).drop("_l", "_r")
    match = F.col("_l").eqNullSafe(F.col("_r")) if compat else F.col("_l") == F.col("_r")
    if fan_out and not one_each and not compat:
        l_rows, r_rows = (in_blocks(dealt(df, key).sortWithinPartitions(key), f"{key}_rows", key) for df, key in ((l_key, "_l"), (r_key, "_r")))
        return pairs_of(l_rows.join(r_rows.hint("merge"), match, HOW[how]), "_l_rows", "_r_rows")
    return l_key.join(r_key, match, HOW[how]).drop("_l", "_r")


def by_id(primary: DataFrame, source: DataFrame, name: str, key: str = "gaia_id", how: str = "left", compat: bool = False, exact: bool = False, one_each: bool = False) -> DataFrame:
    """By long identifiers, exactly. In ``compat``, unless ``exact``, keys pass through doubles, so ids that differ in the last digits meet."""
    other = id_column(source)
    if other is None:
        return primary
    require(primary, key)

    def made(df: DataFrame, c: str) -> Column:
        # numbers are ids as they stand; only text is searched for one
        value = F.col(c).cast("bigint") if dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") else parse_id(c)
        return value.cast("double") if compat and not exact else value

    return join_on(primary, source, name, lambda: made(primary, key), lambda: made(source, other), how, compat, one_each)


def by_name(primary: DataFrame, source: DataFrame, name: str, key: str = "name", how: str = "left", compat: bool = False, one_each: bool = False) -> DataFrame:
    other = first(source, lambda c: "name" in c.lower() and c != key)
    return primary if other is None else _by_text(primary, source, name, key, other, how, compat, one_each)


def by_planet_name(primary: DataFrame, source: DataFrame, name: str, key: str = "pl_name", how: str = "left", compat: bool = False) -> DataFrame:
    other = first(source, lambda c: "pl_name" in c.lower() or "planet" in c.lower())
    return primary if other is None else _by_text(primary, source, name, key, other, how, compat)


def by_host(primary: DataFrame, source: DataFrame, name: str, how: str = "left", compat: bool = False, one_each: bool = False) -> DataFrame:
    key, other = host_column(primary), host_column(source)
    return primary if key is None or other is None else _by_text(primary, source, name, key, other, how, compat, one_each, fan_out=True)


def by_any_name(primary: DataFrame, source: DataFrame, name: str, how: str = "left", compat: bool = False, one_each: bool = False) -> DataFrame:
    """The planet's name with the source's first column that holds 'name'."""
    other = first(source, holding("name"))
    return primary if other is None or "pl_name" not in primary.columns else _by_text(primary, source, name, "pl_name", other, how, compat, one_each)


def by_stellar_id(primary: DataFrame, source: DataFrame, name: str, key: str = "tic_id", how: str = "left", compat: bool = False) -> DataFrame:
    other = first(source, lambda c: any(p in c.lower() for p in ("tic", "kep", "stellar")))
    if other is None:
        return primary
    require(primary, key)
    return join_on(primary, source, name, lambda: to_number(key), lambda: to_number(other), how, compat)


def by_similar_host(primary: DataFrame, source: DataFrame, name: str, how: str = "left", threshold: float = 0.8, compat: bool = False, one_each: bool = False, digits: int | None = None) -> DataFrame:
    """By the host names that are spelt most alike, from ``threshold`` on; ``<name>_name_similarity`` tells how much so, rounded, if ``digits`` are given, once a name. Each primary name meets one name of the source."""
    key, other = host_column(primary), host_column(source)
    if key is None or other is None:
        return primary
    best = most_similar(similar_pairs(primary, source, key, other, threshold))
    similarity = F.col("similarity") if digits is None else F.round("similarity", digits)
    told = best.select(F.col("left_name").alias("_n"), F.col("right_name").alias("_best"), similarity.alias(f"{name}_name_similarity"))
    keyed = primary.withColumn("_n", norm_name(key)).join(told, "_n", "left").drop("_n")
    return join_on(keyed, source, name, lambda: F.col("_best"), lambda: norm_name(other), how, compat, one_each, fan_out=True).drop("_best")


def _by_text(primary, source, name, key, other, how, compat, one_each=False, fan_out=False) -> DataFrame:
    require(primary, key)
    return join_on(primary, source, name, lambda: norm_name(key, compat), lambda: norm_name(other, compat), how, compat, one_each, fan_out)


STRATEGIES = {"gaia_source_id": by_id, "exact_name": by_name, "stellar_id": by_stellar_id, "planet_name": by_planet_name, "hostname": by_host, "similar_hostname": by_similar_host, "generic_name": by_any_name}


def fold(primary: DataFrame, sources: Iterable[tuple[str, DataFrame]], strategy: str, **options) -> DataFrame:
    """Join all sources to the primary table in order."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    return reduce(lambda df, x: STRATEGIES[strategy](df, x[1], x[0], **options), sources, primary)


def choose_primary(counts: dict[str, int]) -> str:
    """The largest catalog whose name tells of the exoplanet archive, else the largest."""
    named = {n: k for n, k in counts.items() if "nasa" in n.lower() or "exoplanet" in n.lower()}
    return max(named or counts, key=(named or counts).get)


def kind_of(name: str) -> str:
    """Which join a catalog's name asks for."""
    low = name.lower()
    for kind, parts in {"gaia": ("gaia",), "candidate": ("toi", "koi", "candidate", "tess", "kepler"), "stellar": ("sweet", "stellar", "hipparcos", "tycho")}.items():
        if any(p in low for p in parts):
            return kind
    return "generic"
