"""Consistency rules over a table: each a Spark SQL condition that must hold; all are checked in one pass, a row tells which it breaks.

A rule is asked only where the table has its columns. A condition that is unknown, for want of a value, isn't broken.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Earth radii in an au, Earth masses in a solar mass (fixed values).
R_EARTH_AU, M_SUN_EARTH = 4.26352e-5, 332946.0487


@dataclass(frozen=True)
class Rule:
    name: str
    holds: str
    needs: tuple[str, ...]


def positive(name: str, *columns: str) -> Rule:
    return Rule(name, " and ".join(f"({c} is null or {c} > 0)" for c in columns), columns)


def between(name: str, column: str, low: float, high: float) -> Rule:
    return Rule(name, f"{column} between {low!r} and {high!r}", (column,))


def required(column: str) -> Rule:
    return Rule(f"required_{column}", f"{column} is not null", (column,))


def precise(column: str, most: float) -> Rule:
    """The larger error is at most a share of the value."""
    return Rule(f"uncertainty_{column}", f"greatest(abs({column}err1), abs({column}err2)) <= {most!r} * abs({column})", (column, f"{column}err1", f"{column}err2"))


_PERIASTRON = "pl_orbsmax * (1 - coalesce(pl_orbeccen, 0))"
_ORBIT = ("pl_orbsmax", "pl_orbeccen", "pl_masse", "pl_rade", "st_mass")
#: The checks of planets and stars. Bounds are fixed values.
CONSISTENCY = (
    positive("positive_masses", "pl_masse", "st_mass"),
    positive("positive_radii", "pl_rade", "st_rad"),
    between("realistic_temperatures", "st_teff", 2000.0, 60000.0),
    # a planet is smaller than the sphere in which it holds what orbits it
    Rule("hill_sphere", f"case when pl_masse > 0 and st_mass > 0 then {_PERIASTRON} * pow(pl_masse / (3 * {M_SUN_EARTH!r} * st_mass), 1e0 / 3) > pl_rade * {R_EARTH_AU!r} end", _ORBIT),
    # and farther from its star than tides would tear it apart at
    Rule("roche_limit", f"case when pl_masse > 0 and st_mass > 0 then {_PERIASTRON} > 2.44 * pl_rade * {R_EARTH_AU!r} * pow({M_SUN_EARTH!r} * st_mass / pl_masse, 1e0 / 3) end", _ORBIT),
    Rule("tidal_circularization", "not (pl_orbper > 0 and pl_orbper < 5 and pl_orbeccen > 0.4)", ("pl_orbper", "pl_orbeccen")),
    # luminosity (its logarithm) within a factor of 10 of the mass's
    Rule("main_sequence_consistency", "case when st_mass > 0 then abs(st_lum - 3.5 * log10(st_mass)) <= 1.0 end", ("st_lum", "st_mass")),
    Rule("age_mass_relation", "case when st_mass > 0 then st_age <= 13.8 and st_age <= 15 * pow(st_mass, -2.5) end", ("st_age", "st_mass")),
)


def from_config(config: dict) -> tuple[Rule, ...]:
    """Rules of a settings file: ``min_required_columns``, ``max_fractional_uncertainty``, ``ranges`` (name: [low, high]) and ``conditions`` (name: SQL, with its columns under ``columns``)."""
    made = [required(c) for c in config.get("min_required_columns", ())]
    made += [precise(c, float(most)) for c, most in config.get("max_fractional_uncertainty", {}).items()]
    made += [between(f"range_{c}", c, float(low), float(high)) for c, (low, high) in config.get("ranges", {}).items()]
    made += [Rule(name, c["holds"], tuple(c["columns"])) for name, c in config.get("conditions", {}).items()]
    return tuple(made)


def applicable(df: DataFrame, rules: Iterable[Rule]) -> list[Rule]:
    return [r for r in rules if set(r.needs) <= set(df.columns)]


def check(df: DataFrame, rules: Iterable[Rule] = CONSISTENCY, into: str = "violations") -> DataFrame:
    """``df`` with the names of the rules that each row breaks, in the rules' order."""
    broken = [F.when(~F.expr(r.holds), F.lit(r.name)) for r in applicable(df, rules)]
    return df.withColumn(into, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))


def summary(checked: DataFrame, rules: Iterable[Rule], by: Iterable[str] = (), column: str = "violations") -> DataFrame:
    """(by..., rule, n_rows, n_broken): one aggregate over a :func:`check` ed table, a row a rule and group."""
    by, rules = list(by), list(rules)
    counts = checked.groupBy(*by).agg(F.count("*").alias("n_rows"), F.array(*(F.struct(F.lit(r.name).alias("rule"), F.sum(F.array_contains(column, r.name).cast("long")).alias("n_broken")) for r in rules)).alias("all"))
    return counts.select(*by, "n_rows", F.explode("all").alias("r")).select(*by, "r.rule", "n_rows", "r.n_broken")
