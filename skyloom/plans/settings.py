"""Folders and limits; environment variables with a prefix take precedence. Folders are made only when asked."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace
from pathlib import Path

PREFIX = "SKYLOOM_"


@dataclass(frozen=True)
class Settings:
    root: str = "."
    workers: int = 4
    samples: int = 1000
    seed: int = 42
    #: Seconds that a transport may take for a download, and for a query.
    timeout: int = 120
    query_timeout: int = 300
    strategy: str = "baseline"
    force: bool = False
    #: Folder of configuration; below the root unless it's absolute or remote.
    config: str = "config"

    @property
    def raw(self) -> str:
        return f"{self.root}/data/raw"

    @property
    def interim(self) -> str:
        return f"{self.root}/data/interim"

    @property
    def processed(self) -> str:
        return f"{self.root}/data/processed"

    @property
    def config_folder(self) -> str:
        return self.config if self.config.startswith("/") or ":" in self.config else f"{self.root}/{self.config}"

    def make_folders(self) -> None:
        """Only for a local root; object stores have no folders."""
        for p in (self.raw, self.interim, self.processed):
            Path(p).mkdir(parents=True, exist_ok=True)


def load(**given) -> Settings:
    found = Settings(**given)
    for f in fields(Settings):
        if (v := os.environ.get(f"{PREFIX}{f.name.upper()}")) is not None:
            kind = type(getattr(found, f.name))
            found = replace(found, **{f.name: v.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(v)})
    return found
