"""Settings and graphs: show, dags."""

from dataclasses import asdict

from .. import config


def arguments(parser) -> None:
    parser.add_argument("action", choices=["show", "dags"])


def run(given, context) -> int:
    s = context.settings
    context.tell(asdict(s) | {"raw": s.raw, "interim": s.interim, "processed": s.processed} if given.action == "show" else [p.name for p in config.files(s.config_folder, "dags").values()])
    return 0
