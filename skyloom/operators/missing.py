"""Missingness flags, provenance, canonical ids, imputation and type narrowing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_name
from .columns import ending, filled, first, numeric_columns
from .quantiles import exact_quantiles, modes

#: Groups of columns that tend to be missing together (fixed values).
PATTERNS = {
    "missing_stellar_params": ("st_teff", "st_lum", "st_mass", "st_rad"),
    "missing_planetary_mass": ("pl_masse", "pl_massj"),
    "missing_planetary_radius": ("pl_rade", "pl_radj"),
    "missing_orbital_params": ("pl_orbsmax", "pl_orbper", "pl_orbeccen"),
    "missing_candidate_info": ("tfopwg_disp", "koi_disposition", "tess_candidate_flag", "kepler_candidate_flag"),
}
#: Sources whose contribution is flagged (fixed values).
SOURCES = {"nasa_source": "nasa_exoplanet_archive_pscomppars", "phl_source": "phl_exoplanet_catalog", "gaia_source": "gaia_dr3_astrophysical_parameters", "sweet_source": "sweet_cat"}


def _all_null(names):
    return reduce(lambda a, b: a & b, (F.col(c).isNull() for c in names), F.lit(True))


def add_missing_patterns(df: DataFrame, patterns=PATTERNS) -> DataFrame:
    """``missing_pattern_<name>``: all columns of the group that exist are null; none existing counts as missing."""
    return df.withColumns({f"missing_pattern_{n}": _all_null([c for c in cols if c in df.columns]) for n, cols in patterns.items()})


def add_missing_indicators(df: DataFrame, patterns=PATTERNS) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull() for cols in patterns.values() for c in cols if c in df.columns})


def add_provenance(df: DataFrame, sources=SOURCES) -> DataFrame:
    """True where any column that holds the source's id has a value."""
    return df.withColumns({flag: ~_all_null([c for c in df.columns if name in c]) for flag, name in sources.items()})


def add_prefix_provenance(df: DataFrame) -> DataFrame:
    """``has_<prefix>_data`` for each first word of the columns' names."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        if "_" in c.strip("_"):
            groups.setdefault(c.split("_")[0], []).append(c)
    return df.withColumns({f"has_{p}_data": ~_all_null(cols) for p, cols in groups.items() if p})


def keep_first(df: DataFrame, keys, order: str = "_row_idx") -> DataFrame:
    """One row a key (nulls are one key), the first in ``order``. The minimum is combined before the exchange, so a hot key costs little."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    packed = df.select(*keys, F.struct(F.col(order).alias("_o"), *(F.col(c) for c in rest)).alias("_v"))
    one = packed.groupBy(*keys).agg(F.min_by("_v", F.col("_v._o")).alias("_v"))
    return one.select(*(F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in df.columns))


def identity_columns(names) -> tuple[str | None, str | None, str | None]:
    """The columns of the newer id, the older id and the planet's name that canonical ids read."""

    def find(*ends: str):
        return next((c for e in ends if (c := first(names, ending(e)))), None)

    return find("gaia_dr3_source_id", "source_id_dr3", "dr3_source_id"), find("gaia_dr2_source_id", "source_id_dr2", "dr2_source_id"), find("pl_name", "planet_name", "pl_hostname")


def add_canonical_ids(df: DataFrame, index: str = "_row_idx", dedupe: bool = True, compat: bool = False) -> DataFrame:
    """``star_id`` from DR3, else DR2 identifiers; ``planet_id`` from the normalised name; row index where there's no such column. One row a pair."""
    dr3, dr2, name = identity_columns(df.columns)
    ids = [F.col(c).cast("string") for c in (dr3, dr2) if c]
    row = F.col(index).cast("string")
    out = df.withColumns({"star_id": F.coalesce(*ids) if ids else row, "planet_id": norm_name(name, compat) if name else row})
    return keep_first(out, ["star_id", "planet_id"], index) if dedupe else out


def drop_sparse(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Columns with a larger share of nulls go, then rows with any null. An empty table keeps all columns."""
    n = df.count()
    has = filled(df)
    keep = [c for c in df.columns if not n or (n - has[c]) / n <= threshold]
    return df.select(*keep).na.drop("any")


def impute(df: DataFrame, strategy: str, columns=None) -> DataFrame:
    """``mean`` or ``median`` of numeric columns, or ``mode`` of all (the lowest on ties, zero if there's none); another strategy changes nothing.

    Means come from one job; medians and modes as quantiles.py says.
    """
    names = list(columns) if columns is not None else df.columns if strategy == "mode" else numeric_columns(df)
    if strategy not in ("mean", "median", "mode") or not names:
        return df
    if strategy == "mean":
        row = df.agg(*(F.avg(c).alias(str(k)) for k, c in enumerate(names))).first()
        fill = dict(zip(names, row, strict=True))
    elif strategy == "median":
        fill = {c: v[0] for c, v in exact_quantiles(df, names, [0.5]).items()}
    else:
        fill = {c: 0 if v is None else v for c, v in modes(df, names).items()}
    kinds = dict(df.dtypes)

    def filled_in(c):
        if c not in fill or fill[c] is None:
            return F.col(c)
        value = F.lit(fill[c])
        return F.coalesce(F.col(c), value if strategy != "mode" else value.cast(kinds[c])).alias(c)

    return df.select(*(filled_in(c) for c in df.columns))


def narrow_types(df: DataFrame) -> DataFrame:
    """Longs to the smallest type that holds their range, doubles to floats where no value changes; one job."""
    longs = [c for c, t in df.dtypes if t == "bigint"]
    doubles = [c for c, t in df.dtypes if t == "double"]
    asked = [x for c in longs for x in (F.min(c), F.max(c))] + [F.bool_and(F.col(c).cast("float").cast("double").eqNullSafe(F.col(c))) for c in doubles]
    if not asked:
        return df
    row = df.agg(*asked).first()
    to = {}
    for k, c in enumerate(longs):
        low, high = row[2 * k], row[2 * k + 1]
        bits = next((t for t, b in (("tinyint", 7), ("smallint", 15), ("int", 31)) if low is not None and -(1 << b) <= low and high < 1 << b), None)
        to |= {c: bits} if bits else {}
    to |= {c: "float" for k, c in enumerate(doubles) if row[2 * len(longs) + k]}
    return df.select(*(F.col(c).cast(to[c]).alias(c) if c in to else F.col(c) for c in df.columns))
