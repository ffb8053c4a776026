"""The whole integration as a chain of DataFrame transformations, and one write in front of the entity tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import joins, missing, normalize, physics, quality, units
from ..operators.columns import filled, record_id, with_row_index
from ..operators.montecarlo import monte_carlo
from ..operators.sky import cone_join


@dataclass(frozen=True)
class Catalog:
    """A source to join: method, the primary's key, priority (low first) and, for positions, tolerance and years of proper motion;
    for similar host names, how alike they must be."""

    name: str
    method: str = "other"
    key: str | None = None
    priority: int = 999
    arcsec: float = 3.0
    years: float | bool = 0.0
    similarity: float = 0.8


@dataclass(frozen=True)
class Spec:
    catalogs: tuple[Catalog, ...] = ()
    samples: int = 1000
    seed: int = 42
    zero_point: bool = True
    compat: bool = False
    units_mode: str = "pipeline"
    options: dict = field(default_factory=dict)


def join_catalog(df: DataFrame, source: DataFrame, c: Catalog, compat: bool = False, one_each: bool = False) -> DataFrame:
    """One source by its method; an unknown method goes by the catalog's name. ``one_each``: at most one source row for each row."""
    if c.method == "gaia_source_id":
        return joins.by_id(df, source, c.name, c.key or "gaia_id", compat=compat, one_each=one_each)
    if c.method == "exact_name":
        return joins.by_name(df, source, c.name, c.key or "pl_name", compat=compat, one_each=one_each)
    if c.method == "fuzzy_hostname":  # compares exactly; see the README
        return joins.by_name(df, source, c.name, c.key or "hostname", compat=compat, one_each=one_each)
    if c.method == "similar_hostname":
        return joins.by_similar_host(df, source, c.name, threshold=c.similarity, one_each=one_each)
    if c.method in ("multiple_identifiers", "coordinate_match"):
        return cone_join(df, source, c.name, c.arcsec, c.years, compat)
    kind = joins.kind_of(c.name)
    if kind == "gaia":
        return quality.add_gaia_flags(joins.by_id(df, source, c.name, compat=compat, one_each=one_each), c.name)
    if kind == "candidate":
        return quality.add_candidate_flags(cone_join(df, source, c.name, c.arcsec, c.years, compat), c.name)
    return (joins.by_host if kind == "stellar" else joins.by_any_name)(df, source, c.name, compat=compat, one_each=one_each)


def join_all(primary: DataFrame, sources: dict[str, DataFrame], spec: Spec, one_each: Iterable[str] = ()) -> DataFrame:
    """Sources in priority order; those that aren't there are passed over. ``one_each``: names of sources that give each row at most one."""
    for c in sorted(spec.catalogs, key=lambda c: c.priority):
        if c.name in sources:
            primary = join_catalog(primary, sources[c.name], c, spec.compat, c.name in one_each)
    return primary


def without_ids(primary: DataFrame, sources: dict[str, DataFrame], spec: Spec) -> list[str]:
    """Sources that canonical ids read nothing of. All rows that such a join repeats have the same ids, and one of them stays in the end, so it needn't repeat any."""
    known = [c.name for c in sorted(spec.catalogs, key=lambda c: c.priority) if c.name in sources]
    owner = {c: None for c in primary.columns} | {f"{n}_{c}": n for n in known for c in sources[n].columns}
    read = {owner[c] for c in missing.identity_columns(list(owner)) if c}
    return [n for n in known if n not in read]


def catalog_merge(sources: dict[str, DataFrame], compat: bool = False, primary: str | None = None) -> DataFrame:
    """Merge by the catalogs' names alone: the primary, unless named, is chosen by name and counted size; ids, provenance and scores follow."""
    name = primary or joins.choose_primary({n: d.count() for n, d in sources.items()})
    df = record_id(with_row_index(sources[name]))
    for n, d in sources.items():
        if n != name:
            df = join_catalog(df, d, Catalog(n), compat)
    df = missing.add_prefix_provenance(normalize.with_ids(df))
    return quality.add_overall_quality(quality.add_completeness(df, available_only=True))


def _spread(df: DataFrame) -> DataFrame:
    """Over as many tasks as the session shuffles to: the step that follows takes far longer for a row than its bytes tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def enrich(df: DataFrame, spec: Spec = Spec(), drop_empty: bool = True) -> DataFrame:
    """Ids, units, range checks, quality, physics, Monte Carlo, missingness, provenance and distance, in this order. Jobs run before the write
    only for columns whose presence depends on values: an empty publication date (unless ``drop_empty`` is off) and several distances."""
    steps: list[Callable[[DataFrame], DataFrame]] = [
        lambda d: missing.add_canonical_ids(d, compat=spec.compat),
        lambda d: units.standardize_units(d, spec.units_mode),
        lambda d: units.range_checks(d, drop_empty),
        quality.add_completeness,
        lambda d: quality.add_crossmatch_quality(d, spec.compat),
        quality.add_ruwe_class,
        physics.derive_features,
        _spread,
        lambda d: monte_carlo(d, spec.samples, spec.seed),
        missing.add_missing_patterns,
        missing.add_missing_indicators,
        missing.add_provenance,
        lambda d: physics.add_distance(d, spec.zero_point),
    ]
    for step in steps:
        df = df.transform(step)
    return df


def merged(primary: DataFrame, sources: dict[str, DataFrame], spec: Spec) -> DataFrame:
    """The wide table: joined, enriched, distinct. Left joins keep every row, so whether the publication date is empty is asked of the primary table."""
    if "pl_pubdate" in primary.columns and not filled(primary, ["pl_pubdate"])["pl_pubdate"]:
        primary = primary.drop("pl_pubdate")
    primary = record_id(with_row_index(primary))
    return enrich(join_all(primary, sources, spec, without_ids(primary, sources, spec)), spec, drop_empty=False)


def tables(wide: DataFrame) -> dict[str, DataFrame]:
    """Entity tables of a wide table that is written or persisted."""
    return normalize.entity_tables(wide)
