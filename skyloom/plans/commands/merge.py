"""Merge the landed sources by a strategy; without one, list them."""

from .. import config
from ..dag import Task
from ..registry import STRATEGIES


def arguments(parser) -> None:
    parser.add_argument("strategy", nargs="?")
    parser.add_argument("--list-strategies", action="store_true")
    parser.add_argument("--info", action="store_true")
    parser.add_argument("--output", default="merged")


def run(given, context) -> int:
    files = list(config.files(context.settings.config_folder, "mergers"))
    if given.info:
        context.tell({n: STRATEGIES.info(n)["doc"] for n in STRATEGIES.listed()} | {n: "a file of the mergers' folder" for n in files})
    elif given.list_strategies or not given.strategy:
        context.tell({"strategies": sorted({*STRATEGIES.listed(), *files})})
    else:
        try:
            context.tell(context.handlers.merge(Task("merge", "merge", config={"strategy": given.strategy, "output": given.output})))
        except (KeyError, FileNotFoundError, RuntimeError) as e:
            context.tell({"error": str(e)})
            return 1
    return 0
