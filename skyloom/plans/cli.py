"""Command line. Commands are the modules of a package: each has ``arguments(parser)`` and ``run(given, context)``, and its name is the command's."""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import pkgutil
from functools import cached_property
from types import ModuleType

from .handlers import Handlers
from .settings import load

log = logging.getLogger("skyloom.cli")
COMMANDS = "skyloom.plans.commands"


class Context:
    """What commands share: settings, and a session that starts once it's needed."""

    def __init__(self, **settings):
        self.settings = load(**settings)

    @cached_property
    def spark(self):
        from pyspark.sql import SparkSession

        return SparkSession.builder.appName("skyloom").getOrCreate()

    @cached_property
    def handlers(self) -> Handlers:
        return Handlers(self.spark, self.settings)

    @staticmethod
    def tell(said) -> None:
        print(json.dumps(said, default=str))


def commands(package: str = COMMANDS) -> dict[str, ModuleType]:
    """The modules of a package that are commands. One that can't be imported is logged and left out."""
    found = {}
    for m in pkgutil.iter_modules(importlib.import_module(package).__path__):
        try:
            module = importlib.import_module(f"{package}.{m.name}")
        except Exception as e:  # a broken plug-in doesn't take the others with it
            log.error("command %s left out: %s", m.name, e)
            continue
        if hasattr(module, "arguments") and hasattr(module, "run"):
            found[m.name] = module
    return found


def main(args: list[str] | None = None, packages: tuple[str, ...] = (COMMANDS,)) -> int:
    parser = argparse.ArgumentParser("skyloom")
    parser.add_argument("--root", help="folder of data and configuration")
    parser.add_argument("--force", action="store_true", help="fetch again what's there")
    below = parser.add_subparsers(dest="command", required=True)
    known = {name: module for p in packages for name, module in commands(p).items()}
    for name, module in sorted(known.items()):
        module.arguments(below.add_parser(name, help=(module.__doc__ or "").strip().split("\n")[0]))
    given = parser.parse_args(args)
    context = Context(**({"root": given.root} if given.root else {}), **({"force": True} if given.force else {}))
    return known[given.command].run(given, context) or 0


if __name__ == "__main__":
    raise SystemExit(main())
