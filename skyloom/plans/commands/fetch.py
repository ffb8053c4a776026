"""Fetch one source, or all; without a name, list them."""

from ...sources.catalog import fetch_all


def arguments(parser) -> None:
    parser.add_argument("source", nargs="?")
    parser.add_argument("--sequential", action="store_true")


def run(given, context) -> int:
    registry = context.handlers.registry
    if not given.source:
        context.tell({"sources": registry.listed()})
        return 0
    if given.source.lower() != "all" and given.source not in registry.listed():
        context.tell({"error": f"unknown source: {given.source}", "sources": registry.listed()})
        return 1
    ids = registry.listed() if given.source.lower() == "all" else [given.source]
    s = context.settings
    got = fetch_all(context.spark, registry, s.raw, ids, 1 if given.sequential else s.workers, s.force)
    context.tell({i: {"rows": f.rows, "path": f.path, "placeholder": f.placeholder, "error": f.error} for i, f in got.items()})
    return 0
