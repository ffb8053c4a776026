"""Sends this package to the executors, so that Python workers find it wherever the driver runs."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

_sent: set[str] = set()


def ship(spark) -> None:
    """Once an application: the package's sources as a zip file."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="skyloom-")
    path = os.path.join(folder, "skyloom_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(path)
    _sent.add(sc.applicationId)


def shipped(f):
    """A query or stage that ships the package before it plans."""

    @functools.wraps(f)
    def run(spark, *args):
        ship(spark)
        return f(spark, *args)

    return run
