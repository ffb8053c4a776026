"""What tasks of a graph do: fetch, merge, preprocess, validate and export tables below the settings' folders."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..operators import profile, tiers
from ..sources import catalog, scan
from . import config
from .dag import Task
from .merge import run_merge
from .pipeline import Spec
from .registry import PIPELINE_STRATEGIES, PREPROCESSORS, STRATEGIES, stage_of
from .settings import Settings

#: Landed tables of the newer and the older release, which the tiers read.
RELEASES = ("gaia_dr3", "gaia_dr2")


def file_transport(spark: SparkSession) -> catalog.Transport:
    """Answers from files that Hadoop can open; other addresses need a transport of one's own."""

    def read(url: str, query: str | None, timeout: float) -> bytes:
        if query is not None or url.startswith(("http:", "https:")):
            raise ConnectionError(f"no transport for {url or 'queries'}")
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(url)
        stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
        try:
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    return read


class Handlers:
    """``registry``: sources and their fetchers; by default those of the configuration folder, over ``transport``."""

    def __init__(self, spark: SparkSession, settings: Settings, registry: catalog.Registry | None = None, transport: catalog.Transport | None = None):
        self.spark, self.settings = spark, settings
        self.registry = registry if registry is not None else config.sources(settings.config_folder)
        if not self.registry.fetchers:
            catalog.usual_fetchers(self.registry, spark, settings.raw, transport or file_transport(spark), settings.timeout, settings.query_timeout)

    def by_type(self) -> dict[str, Callable[[Task], object]]:
        return {"fetch": self.fetch, "merge": self.merge, "preprocess": self.preprocess, "validate": self.validate, "export": self.export}

    def _latest(self, last: int = 3) -> str | None:
        return scan.latest_stage(self.spark, self.settings.interim, last)

    def _landed(self, name: str) -> DataFrame | None:
        return scan.scan_any(self.spark, self.settings.raw, name)

    def _by_tiers(self, source: catalog.Source) -> catalog.Fetched | None:
        """An astrometric catalog as the tiers find it for the primary table's ids, where both releases are landed."""
        primary = self.registry.find("nasa")
        tables = [self._landed(n) for n in ((primary.id,) if primary else ()) + RELEASES]
        if not source.id.startswith("gaia") or len(tables) < 3 or any(t is None for t in tables):
            return None
        out = f"{self.settings.raw}/{source.id}/{source.id}.parquet"
        scan.keep(tiers.cascade(*tables), source.columns).write.mode("overwrite").parquet(out)
        return catalog.Fetched(source.id, out, self.spark.read.parquet(out).count())

    def fetch(self, task: Task) -> dict:
        """One source by its id ('source'), 'force_refresh' or not. A source that can't be had is a placeholder's row, and the result says so."""
        name = task.config.get("source")
        if not name:
            raise ValueError("a fetch task needs a source")
        got = self._by_tiers(self.registry.get(name)) or catalog.fetch(self.spark, self.registry, name, self.settings.raw, bool(task.config.get("force_refresh", self.settings.force)))
        return {"source": name, "success": True, "path": got.path, "rows": got.rows, "placeholder": got.placeholder, "error": got.error}

    def merge_plan(self, strategy: str, task: Task | None = None) -> tuple[Callable, str | None, Spec, list[str]]:
        """(strategy, primary, spec, names of sources). A strategy that has a file in the mergers' folder takes its sources from there; the
        pipeline's names do so too where there's a single file."""
        told = task.config if task else {}
        files = config.files(self.settings.config_folder, "mergers")
        name = strategy if strategy in files else next(iter(files)) if strategy in PIPELINE_STRATEGIES and len(files) == 1 else None
        if strategy not in STRATEGIES.listed() and name is None:
            raise KeyError(f"unknown strategy: {strategy}; known: {', '.join(sorted({*STRATEGIES.listed(), *files}))}")
        primary, spec = config.merge_spec(config.read(files[name])) if name else (None, Spec(samples=self.settings.samples, seed=self.settings.seed))
        spec = replace(spec, samples=int(told.get("monte_carlo_samples", spec.samples)))
        names = list(told.get("sources") or ([primary, *(c.name for c in spec.catalogs)] if primary else self.registry.listed()))
        return STRATEGIES.get(strategy if strategy in STRATEGIES.listed() else "unified"), primary, spec, names

    def merge(self, task: Task) -> dict:
        """By the task's strategy, over the landed tables of its sources; those that aren't there are passed over."""
        strategy = task.config.get("strategy", self.settings.strategy)
        run, primary, spec, names = self.merge_plan(strategy, task)
        sources = {n: df for n in names if (df := self._landed(n)) is not None}
        if primary is not None and primary not in sources:
            raise FileNotFoundError(f"the primary source {primary} isn't landed")
        out = scan.stage_path(self.settings.interim, scan.STAGES[0], task.config.get("output", "merged"))
        told = run_merge(sources, lambda s: run(s, spec, primary), out)
        if not told.success:
            raise RuntimeError(f"merge failed: {told.error}")
        return {"strategy": strategy, "rows": told.rows, "columns": told.statistics["output_columns"], "output_path": out, "statistics": told.statistics}

    def preprocess(self, task: Task) -> dict:
        """The named preprocessor over the newest table of the last stage."""
        name = task.config.get("preprocessor")
        if not name:
            raise ValueError("a preprocess task needs a preprocessor")
        path = self._latest()
        if path is None:
            raise FileNotFoundError(f"no stage below {self.settings.interim}")
        df = self.spark.read.parquet(path)
        step = (lambda d: d.drop(*config.dropped_columns(self.settings.config_folder))) if name == "columns_pruner" else PREPROCESSORS.get(name)
        out = scan.write_stage(step(df), self.settings.interim, stage_of(name), task.config.get("output", f"processed_{name.lower()}"))
        return {"preprocessor": name, "success": True, "input_rows": df.count(), "output_rows": self.spark.read.parquet(out).count(), "output_path": out}

    def validate(self, task: Task) -> dict:
        """The checks that the task asks for, over the newest table; without any table, none passes, but that's no error."""
        asked = [c for c in ("completeness", "data_types", "hz_columns") if task.config.get(f"check_{c}", False)]
        path = self._latest()
        if path is None:
            return {"checks": asked, "all_passed": False, "error": "no tables"}
        df = self.spark.read.parquet(path)
        rows = profile.validate(df, **{c: c in asked for c in ("completeness", "data_types", "hz_columns")}).collect() if asked else []
        return {"checks": asked, "all_passed": all(r.passed for r in rows), "results": {r.check: {"passed": r.passed, "value": r.value} for r in rows}, "columns": len(df.columns)}

    def export(self, task: Task) -> dict:
        """The newest table of the last stage to the processed folder."""
        path = self._latest(4)
        if path is None:
            raise FileNotFoundError(f"no stage below {self.settings.interim}")
        name = task.config.get("filename") or task.config.get("name", "catalog")
        folder = f"{self.settings.processed}/{task.config.get('output_path', name)}"
        return {"success": True, "output_path": folder, "exported": scan.export(self.spark.read.parquet(path), folder, name, task.config.get("formats", ["parquet"]))}
