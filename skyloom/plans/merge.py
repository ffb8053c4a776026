"""One merge from sources to a written table with its statistics; a failure is told in the result."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.profile import merge_statistics, null_share

log = logging.getLogger("skyloom.merge")


@dataclass(frozen=True)
class MergeResult:
    path: str
    success: bool
    rows: int = 0
    sources: tuple[str, ...] = ()
    seconds: float = 0.0
    statistics: dict = field(default_factory=dict)
    error: str = ""


def check_inputs(sources: dict[str, DataFrame], join_keys: dict[str, list[str]] | None = None) -> None:
    if not sources:
        raise ValueError("no sources")
    for name, keys in (join_keys or {}).items():
        lacking = [k for k in keys if name in sources and k not in sources[name].columns]
        if lacking:
            raise KeyError(f"{name} lacks {', '.join(lacking)}")
    for name, df in sources.items():
        if df.isEmpty():
            log.warning("source %s has no rows", name)


def run_merge(sources: dict[str, DataFrame], strategy: Callable[[dict[str, DataFrame]], DataFrame], path: str, join_keys: dict[str, list[str]] | None = None, distinct: bool = True) -> MergeResult:
    """Check, merge, drop repeated rows, and write; rows and share of nulls are observed as they're written, so the result isn't read again."""
    began = time.monotonic()
    try:
        check_inputs(sources, join_keys)
        df = strategy(sources)
        df, seen = df.dropDuplicates() if distinct else df, Observation()
        df.observe(seen, F.count("*").alias("rows"), null_share(df).alias("null_pct")).write.mode("overwrite").parquet(path)
        stats = merge_statistics(df, sources, seen.get["rows"]) | {"null_pct": seen.get["null_pct"]}
        return MergeResult(path, True, stats["output_rows"], tuple(sources), time.monotonic() - began, stats)
    except Exception as e:  # the result tells; callers that want to stop raise on it
        return MergeResult(path, False, 0, (), time.monotonic() - began, {}, f"{type(e).__name__}: {e}")


def strategies() -> list[str]:
    """The names that :func:`merge_by` knows."""
    from .registry import STRATEGIES

    return STRATEGIES.listed()


def merge_by(strategy: str, sources: dict[str, DataFrame], path: str, **options) -> DataFrame:
    """Run a strategy by its name and read what it wrote; a failure is an error. ``options``: spec and primary."""
    from .registry import STRATEGIES

    told = run_merge(sources, lambda s: STRATEGIES.get(strategy)(s, **options), path)
    if not told.success:
        raise RuntimeError(f"merge failed: {told.error}")
    return next(iter(sources.values())).sparkSession.read.parquet(path)
