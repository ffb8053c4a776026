"""Descriptors of source catalogs, and fetching of landed files. There's no network code: a transport is any function that
answers a request with bytes, and the fetchers here hold the rules around it: what's asked, what's refused, and what file it becomes."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .scan import empty, exists, ingest, placeholder

#: Where a query takes the ids of another source's rows (fixed value).
ID_LIST = "<GAIA_ID_LIST>"
#: A transport: (url, the query or None, seconds) -> bytes.
Transport = Callable[[str, str | None, float], bytes]


@dataclass(frozen=True)
class Source:
    id: str
    name: str = ""
    url: str = ""
    query: str = ""
    columns: tuple[str, ...] = ()
    primary_keys: tuple[str, ...] = ()
    join_keys: tuple[str, ...] = ()
    format: str = "csv"
    description: str = ""

    @property
    def waits_for_ids(self) -> bool:
        """Its query needs the ids of another source first."""
        return ID_LIST in self.query

    @staticmethod
    def of(spec: dict) -> Source:
        """From a configuration's names; unknown ones are dropped."""
        take = lambda *names: next((spec[n] for n in names if spec.get(n)), None)
        listed = lambda *names: tuple(take(*names) or ())
        if not spec.get("id"):
            raise ValueError("a source needs an id")
        return Source(spec["id"], take("name") or spec["id"], take("url", "download_url") or "", take("query", "adql") or "", listed("columns", "columns_to_keep"), listed("primary_keys"), listed("join_keys"), take("format") or "csv", take("description") or "")


@dataclass
class Registry:
    """Sources by id, and fetchers by name with the test that tells which one a source needs; the first that fits wins."""

    sources: dict[str, Source] = field(default_factory=dict)
    fetchers: dict[str, tuple[Callable[[Source], bool], Callable[[Source], str]]] = field(default_factory=dict)

    def add(self, source: Source) -> None:
        self.sources[source.id] = source

    def get(self, id_: str) -> Source:
        if id_ not in self.sources:
            raise KeyError(f"unknown source: {id_}; known: {', '.join(self.listed())}")
        return self.sources[id_]

    def listed(self) -> list[str]:
        return sorted(self.sources)

    def find(self, prefix: str) -> Source | None:
        return next((self.sources[i] for i in self.listed() if i.startswith(prefix)), None)

    def register(self, name: str, fits: Callable[[Source], bool], land: Callable[[Source], str]) -> None:
        self.fetchers[name] = (fits, land)

    def unregister(self, name: str) -> None:
        self.fetchers.pop(name, None)

    def fetcher_for(self, source: Source) -> Callable[[Source], str]:
        for fits, land in self.fetchers.values():
            if fits(source):
                return land
        raise LookupError(f"no fetcher for {source.id}")


class Rejected(ValueError):
    """An answer that isn't a table."""


def write_bytes(spark: SparkSession, path: str, data: bytes) -> str:
    """A file of bytes, by Hadoop's file system, so the path may be remote."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(data)
    finally:
        out.close()
    return path


def stamped(source: str, folder: str, end: str = "csv") -> str:
    """A raw file's path with the time (UTC) in its name, so that none is written over."""
    return f"{folder}/{source}/{source}_{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}_{time.time_ns() % 10**9:09d}.{end}"


def http_fetcher(spark: SparkSession, folder: str, transport: Transport, timeout: float = 120) -> Callable[[Source], str]:
    """Downloads a source's url; the raw file keeps the url's ending."""

    def land(source: Source) -> str:
        if not source.url:
            raise ValueError(f"{source.id} has no url")
        return write_bytes(spark, stamped(source.id, folder, "parquet" if source.url.lower().endswith(".parquet") else "csv"), transport(source.url, None, timeout))

    return land


def query_fetcher(spark: SparkSession, folder: str, transport: Transport, endpoint: str = "", timeout: float = 300) -> Callable[[Source], str]:
    """Posts a source's query. Services tell errors as XML with a good status, so an answer that starts like XML is refused; the others are kept as a stamped raw CSV."""

    def land(source: Source) -> str:
        data = transport(source.url or endpoint, source.query, timeout)
        if data.lstrip()[:1] == b"<":
            raise Rejected(f"{source.id}: an XML answer: {data[:200].decode('utf-8', 'replace')}")
        return write_bytes(spark, stamped(source.id, folder), data)

    return land


def with_ids(source: Source, ids: Iterable[int]) -> str:
    """The query with its list of ids."""
    return source.query.replace(ID_LIST, ",".join(str(int(i)) for i in ids))


def usual_fetchers(registry: Registry, spark: SparkSession, folder: str, transport: Transport, timeout: float = 120, query_timeout: float = 300) -> Registry:
    """Registers the two above: a query goes before a url."""
    registry.register("query", lambda s: bool(s.query), query_fetcher(spark, folder, transport, timeout=query_timeout))
    registry.register("http", lambda s: bool(s.url), http_fetcher(spark, folder, transport, timeout))
    return registry


@dataclass(frozen=True)
class Fetched:
    source: str
    path: str
    rows: int
    placeholder: bool = False
    error: str = ""


def fetch(spark: SparkSession, registry: Registry, id_: str, folder: str, force: bool = False, with_placeholder: bool = True) -> Fetched:
    """Land a source and ingest it; a table that's there is used unless ``force``. A failure writes a one-row placeholder and says so."""
    source = registry.get(id_)
    out = f"{folder}/{id_}/{id_}.parquet"
    if exists(spark, out) and not force:
        return Fetched(id_, out, spark.read.parquet(out).count())
    if source.waits_for_ids:
        # its rows come by the tiers over another source's ids; till then an empty table holds its place
        if not exists(spark, out):
            empty(spark, ", ".join(f"`{c}` string" for c in source.columns or source.primary_keys or ("id",))).write.parquet(out)
        return Fetched(id_, out, spark.read.parquet(out).count())
    try:
        return Fetched(id_, out, ingest(spark, registry.fetcher_for(source)(source), out, source.columns, source.url).count())
    except Exception as e:
        if not with_placeholder:
            raise
        key = (source.primary_keys or source.columns or ("id",))[0]
        df: DataFrame = placeholder(spark, id_, source.columns, key)
        df.write.mode("overwrite").parquet(out)
        return Fetched(id_, out, 1, True, f"{type(e).__name__}: {e}"[:500])


def fetch_all(spark: SparkSession, registry: Registry, folder: str, ids: Iterable[str] | None = None, workers: int = 4, force: bool = False) -> dict[str, Fetched]:
    names = list(registry.listed() if ids is None else ids)
    with ThreadPoolExecutor(max(1, workers)) as pool:
        return dict(zip(names, pool.map(lambda i: fetch(spark, registry, i, folder, force), names), strict=True))
