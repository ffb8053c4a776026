"""Named strategies and preprocessors; both are functions over DataFrames and can be added to. All strategies are called in one way:
with the sources by name, a spec, and the name of the primary source if it's known."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame

from ..operators import columns, joins, missing, physics
from ..operators.sky import cone_join
from .pipeline import Catalog, Spec, catalog_merge, merged


class Registry:
    def __init__(self, known: dict[str, Callable] | None = None):
        self._known = dict(known or {})

    def register(self, name: str, function: Callable) -> None:
        self._known[name] = function

    def unregister(self, name: str) -> None:
        self._known.pop(name, None)

    def get(self, name: str) -> Callable:
        if name not in self._known:
            raise KeyError(f"unknown: {name}; known: {', '.join(self.listed())}")
        return self._known[name]

    def listed(self) -> list[str]:
        return sorted(self._known)

    def info(self, name: str) -> dict:
        return {"name": name, "doc": (self.get(name).__doc__ or "").strip()}


#: A strategy: (sources by name, spec, name of the primary source or None) -> DataFrame.
Strategy = Callable[..., DataFrame]


def _primary(sources: dict[str, DataFrame], name: str | None) -> str:
    """The one named; else the only one; else by the catalogs' names and counted sizes."""
    if not sources:
        raise ValueError("no sources")
    if name is not None and name not in sources:
        raise KeyError(f"unknown source: {name}; known: {', '.join(sources)}")
    return name or (next(iter(sources)) if len(sources) == 1 else joins.choose_primary({n: d.count() for n, d in sources.items()}))


def _each(join: Callable[..., DataFrame]) -> Strategy:
    """All sources joined to the primary one by the same join, in order of the spec's priorities and then of their names."""

    def merge(sources: dict[str, DataFrame], spec: Spec = Spec(), primary: str | None = None) -> DataFrame:
        first, known = _primary(sources, primary), {c.name: c for c in spec.catalogs}
        rest = sorted((n for n in sources if n != first), key=lambda n: (known[n].priority if n in known else 999, n))
        return reduce(lambda df, n: join(df, sources[n], n, known.get(n, Catalog(n)), spec.compat), rest, sources[first])

    merge.__doc__ = join.__doc__
    return merge


def _keyed(f: Callable[..., DataFrame]) -> Strategy:
    return _each(lambda df, source, name, c, compat: f(df, source, name, **({"key": c.key} if c.key else {}), compat=compat))


def _plain(f: Callable[..., DataFrame]) -> Strategy:
    return _each(lambda df, source, name, c, compat: f(df, source, name, compat=compat))


def _position(df: DataFrame, source: DataFrame, name: str, c: Catalog, compat: bool) -> DataFrame:
    """The nearest source row within the catalog's tolerance."""
    return cone_join(df, source, name, c.arcsec, c.years, compat)


def _by_names(sources: dict[str, DataFrame], spec: Spec = Spec(), primary: str | None = None) -> DataFrame:
    """Each catalog by the join that its name asks for, with ids, provenance and scores."""
    return catalog_merge(sources, spec.compat, _primary(sources, primary))


def _pipeline(sources: dict[str, DataFrame], spec: Spec = Spec(), primary: str | None = None) -> DataFrame:
    """All stages. Without catalogs in the spec, each source goes by its name."""
    first = _primary(sources, primary)
    spec = spec if spec.catalogs else replace(spec, catalogs=tuple(Catalog(n, priority=k) for k, n in enumerate(sources) if n != first))
    return merged(sources[first], {n: d for n, d in sources.items() if n != first}, spec)


#: Positions, catalogs by their names, and the whole pipeline; aliases are one strategy under several names (fixed values).
POSITION_STRATEGIES = ("cone_search", "coordinate_match", "position_match", "astrometric_match")
CATALOG_STRATEGIES = ("exoplanet_catalog", "candidate_validation", "stellar_parameters", "mission_data")
PIPELINE_STRATEGIES = ("comprehensive_merge", "multi_catalog_merge", "unified_ingestion", "unified", "baseline", "gaia_enriched")
_PLAIN = ("hostname", "similar_hostname", "generic_name")
STRATEGIES = Registry(
    {n: (_plain if n in _PLAIN else _keyed)(f) for n, f in joins.STRATEGIES.items()} | {n: _each(_position) for n in POSITION_STRATEGIES} | {n: _by_names for n in CATALOG_STRATEGIES} | {n: _pipeline for n in PIPELINE_STRATEGIES}
)


def _if_there(names: Iterable[str], step: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Tables without the columns pass through."""
    return lambda df: step(df) if set(names) <= set(df.columns) else df


PREPROCESSORS = Registry({
    "hz_edges": _if_there(("st_teff", "st_lum"), physics.add_hz_edges),
    "hz_edges_optimistic": _if_there(("st_teff", "st_lum"), lambda d: physics.add_hz_edges(d, optimistic=True)),
    "columns_pruner": columns.drop_listed,
    "data_type_optimizer": missing.narrow_types,
    "missing_drop": missing.drop_sparse,
    "missing_mean": lambda d: missing.impute(d, "mean"),
    "missing_median": lambda d: missing.impute(d, "median"),
    "missing_mode": lambda d: missing.impute(d, "mode"),
})


def stage_of(preprocessor: str) -> str:
    """The stage a preprocessor's output belongs to, by its name."""
    low = preprocessor.lower()
    return "03_feature_engineered" if "feature" in low or "engineering" in low else "02_quality_filtered"
