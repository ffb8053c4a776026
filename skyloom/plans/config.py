"""Configuration files: sources, merges, constants and graphs below one folder, as YAML or JSON."""

from __future__ import annotations

import json
import logging
from pathlib import Path

from ..sources.catalog import Registry, Source
from .pipeline import Catalog, Spec

log = logging.getLogger("skyloom.config")
ENDS = (".yml", ".yaml", ".json")


def read(path: str | Path) -> dict:
    """JSON as it is; all else by the YAML parser, where it's installed."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text)
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.safe_load(text) or {}


def files(folder: str, kind: str) -> dict[str, Path]:
    """Files of a kind ('sources', 'mergers', 'constants', 'dags') by their names without the ending, sorted."""
    at = Path(folder) / kind
    return {p.stem: p for p in sorted(at.iterdir()) if p.suffix in ENDS} if at.is_dir() else {}


def read_one(folder: str, kind: str, name: str) -> dict:
    found = files(folder, kind)
    if name not in found:
        raise FileNotFoundError(f"{folder}/{kind}/{name}.yml")
    return read(found[name])


def sources(folder: str) -> Registry:
    """All sources of the folder. A file that can't be read, or lacks an id, is logged and left out; the others hold."""
    registry = Registry()
    for path in files(folder, "sources").values():
        try:
            registry.add(Source.of(read(path)))
        except Exception as e:  # one broken file doesn't take the others with it
            log.warning("source %s left out: %s", path, e)
    return registry


def merge_spec(made: dict, **options) -> tuple[str, Spec]:
    """(id of the primary source, :class:`Spec`) of a merge file: its catalogs with priority, method, key and tolerance, its samples and seed."""
    told = made.get("sources") or {}
    if not told.get("primary"):
        raise ValueError("a merge needs a primary source")
    catalogs = []
    for c in told.get("catalogs", []):
        match = c.get("cross_match") or {}
        key, tolerance = match.get("primary_key"), match.get("tolerance")
        by_place = match.get("method") in ("multiple_identifiers", "coordinate_match")
        catalogs.append(
            Catalog(c["id"], match.get("method", "other"), key if isinstance(key, str) else None, int(c.get("priority", 999)), float(tolerance) if by_place and tolerance is not None else 3.0, bool(match.get("epoch_correction", False)))
        )
    sampling = made.get("uncertainty_propagation") or {}
    zero_point = ((made.get("data_quality") or {}).get("enhanced_gaia_quality") or {}).get("apply_parallax_zero_point", True)
    known = {"samples": int(sampling.get("num_samples", 1000)), "seed": int(sampling.get("random_seed", 42)), "zero_point": bool(zero_point), "options": made.get("output") or {}}
    return told["primary"], Spec(tuple(catalogs), **(known | options))


def dropped_columns(folder: str) -> tuple[str, ...]:
    """Columns that the constants say to drop; the preprocessor's own list where there's no such file."""
    return tuple((read(p).get("columns_to_drop") or ()) if (p := files(folder, "constants").get("drop_columns")) else ("P_NAME", "S_NAME"))
