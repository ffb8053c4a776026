"""What the jobs share: settings, the log, and the session of the command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("jobs")


def settings(spark: SparkSession, path: str) -> dict:
    """A settings file, wherever Spark can read it."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that an earlier run wrote; None if there's none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def main(name: str, run: Callable, arguments: dict[str, str], argv: list[str] | None = None) -> None:
    """``python -m jobs.<name> --config FILE --<argument> PATH ...``: the only place that makes and stops a session."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=run.__doc__)
    parser.add_argument("--config", required=True, help="settings, a JSON file that Spark can read")
    for key, told in arguments.items():
        parser.add_argument(f"--{key}", required=True, help=told)
    given = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    try:
        run(spark, *(getattr(given, key) for key in arguments), settings(spark, given.config))
    finally:
        spark.stop()
