"""Version, fetchers, strategies, preprocessors and settings."""

from dataclasses import asdict

from ..registry import PREPROCESSORS, STRATEGIES

VERSION = "0.2.0"


def arguments(parser) -> None:
    pass


def run(given, context) -> int:
    context.tell({"version": VERSION, "fetchers": ["query", "http"], "strategies": STRATEGIES.listed(), "preprocessors": PREPROCESSORS.listed(), "settings": asdict(context.settings)})
    return 0
