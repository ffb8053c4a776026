"""Tables: status, sources, config, validate."""

from ...functions.astro import HZ
from ...sources import scan
from .. import config


def arguments(parser) -> None:
    parser.add_argument("action", choices=["status", "sources", "config", "validate"])
    parser.add_argument("-d", "--detailed", action="store_true")


def _names(spark, folder: str) -> list[str]:
    return sorted(path.rstrip("/").rsplit("/", 1)[-1] for _, path in scan.modified(spark, folder))


def _tables(spark, folder: str) -> dict[str, str]:
    """Tables of a folder by their names, as paths without the ending."""
    return {n.rsplit(".", 1)[0]: f"{folder}/{n.rsplit('.', 1)[0]}" for n in _names(spark, folder) if n.endswith((".parquet", ".csv"))}


def run(given, context) -> int:
    s = context.settings
    if given.action == "config":
        context.tell({"folder": s.config_folder, "sources": config.sources(s.config_folder).listed(), "constants": sorted(config.files(s.config_folder, "constants")), "habitable_zones": list(HZ)})
        return 0
    registry = config.sources(s.config_folder)
    if given.action == "sources":
        shown = ("name", "description", "url", "primary_keys", "join_keys")
        context.tell({i: {k: getattr(registry.get(i), k) for k in shown} | {"query": bool(registry.get(i).query), "columns": len(registry.get(i).columns)} for i in registry.listed()} if given.detailed else registry.listed())
        return 0
    spark = context.spark
    if given.action == "validate":
        found = scan.data_status(spark, {i: f"{s.raw}/{i}/{i}" for i in registry.listed()})
        context.tell({"sources": found, "valid": sum(x["status"] in ("ok", "csv only") for x in found.values()), "total": len(found)})
        return 0
    raw = {n: f"{s.raw}/{n}/{n}" for n in _names(spark, s.raw)}
    nested = lambda folder: {n: scan.data_status(spark, _tables(spark, f"{folder}/{n}")) for n in _names(spark, folder)}
    context.tell({"raw": scan.data_status(spark, raw), "interim": nested(s.interim), "processed": nested(s.processed)})
    return 0
