"""Remote catalogs read on the executors, as a Spark data source and by the ids of another table.

A transport answers a request with bytes and is named by its module and function, so that each task finds its own; requests and answers stay on the executors,
and a failed task is asked again by Spark. There's no network code here either.

    register(spark)
    spark.read.format("remote_catalog").schema("source_id long, parallax double").options(transport="my.module:ask", url=..., query="... in (<GAIA_ID_LIST>)", ids="1,2,3").load()
    by_ids(targets, source, "my.module:ask", "source_id long, parallax double", batch=100)

The data source takes a bounded list of ids from its options, a partition a batch of them; :func:`by_ids` takes a table of any size and never gathers it.
"""

from __future__ import annotations

import csv
import importlib
import io
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

from .catalog import ID_LIST, Rejected, Source, Transport

#: Ids of a request in the first, second and third tier (fixed values), and the most that options may list.
BATCHES = (100, 50, 100)
MOST_LISTED = 100_000
_NUMBERS = {LongType: int, IntegerType: int, ShortType: int, DoubleType: float, FloatType: float}


def transport_named(name: str) -> Transport:
    """The function behind ``module:function``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def rows_of(data: bytes, schema: StructType) -> Iterator[tuple]:
    """Rows of a CSV answer with a header, in the schema's columns; those it lacks are null, as are values that aren't of their type. XML is refused."""
    if data.lstrip()[:1] == b"<":
        raise Rejected(f"an XML answer: {data[:200].decode('utf-8', 'replace')}")

    def value(text: str | None, kind):
        if text is None or text == "":
            return None
        if isinstance(kind, BooleanType):
            return {"true": True, "t": True, "1": True, "false": False, "f": False, "0": False}.get(text.strip().lower())
        try:
            made = _NUMBERS.get(type(kind), str)(text)
        except ValueError:
            return None
        return None if made != made else made

    for row in csv.DictReader(io.StringIO(data.decode("utf-8", "replace"))):
        yield tuple(value(row.get(f.name), f.dataType) for f in schema.fields)


def asked(transport: Transport, url: str, query: str | None, timeout: float, tries: int, pause: float) -> bytes:
    """An answer, asked for again after a failure of the connection; what the service refuses isn't repeated."""
    for left in reversed(range(tries)):
        try:
            return transport(url, query, timeout)
        except (ConnectionError, TimeoutError, OSError):
            if not left:
                raise
            time.sleep(pause)
    raise ValueError("a request needs a try at least")


class _Batch(InputPartition):
    def __init__(self, ids: tuple[int, ...]):
        super().__init__(ids)
        self.ids = ids


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns, self.options = schema, dict(options)

    def partitions(self) -> list[_Batch]:
        listed = [int(x) for x in self.options.get("ids", "").split(",") if x.strip()]
        if len(listed) > MOST_LISTED:
            raise ValueError(f"at most {MOST_LISTED} ids as an option; a table of them goes through by_ids")
        size = int(self.options.get("batch", BATCHES[0]))
        return [_Batch(tuple(listed[k : k + size])) for k in range(0, len(listed), size)] if ID_LIST in self.options.get("query", "") else [_Batch(())]

    def read(self, partition: _Batch) -> Iterator[tuple]:
        o = self.options
        query = o.get("query") and o["query"].replace(ID_LIST, ",".join(map(str, partition.ids)))
        data = asked(transport_named(o["transport"]), o.get("url", ""), query or None, float(o.get("timeout", 300)), int(o.get("tries", 3)), float(o.get("pause", 1)))
        yield from rows_of(data, self.columns)


class RemoteCatalog(DataSource):
    """Options: transport, url, query, ids, batch, timeout, tries, pause. The schema is the reader's."""

    @classmethod
    def name(cls) -> str:
        return "remote_catalog"

    def schema(self) -> str:
        raise ValueError("a remote catalog is read with a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Once a session; the same name is registered anew."""
    spark.dataSource.register(RemoteCatalog)


def by_ids(targets: DataFrame, source: Source, transport: str | Transport, schema: str, batch: int = BATCHES[0], id_col: str = "target_id", requests: int | None = None, timeout: float = 300, tries: int = 3, pause: float = 1.0) -> DataFrame:
    """The rows a source answers for the distinct ids of a table, asked for in batches by the tasks that hold them. ``requests``: tasks that may ask at a time, in which case
    the ids are dealt to so many partitions."""
    if not source.waits_for_ids:
        raise ValueError(f"the query of {source.id} takes no ids")
    columns = StructType.fromDDL(schema)
    ids = targets.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct()
    ids = ids.repartition(requests, "id") if requests else ids
    ask: Callable[[], Transport] = (lambda: transport_named(transport)) if isinstance(transport, str) else (lambda: transport)

    def run(batches):
        held: list[int] = []
        answers = ask()

        def rows(some: list[int]) -> pd.DataFrame:
            data = asked(answers, source.url, source.query.replace(ID_LIST, ",".join(map(str, some))), timeout, tries, pause)
            return pd.DataFrame(list(rows_of(data, columns)), columns=columns.fieldNames(), dtype=object)

        for rows_ in batches:
            held += rows_["id"].tolist()
            while len(held) >= batch:
                some, held = held[:batch], held[batch:]
                yield rows(some)
        if held:
            yield rows(held)

    return ids.mapInPandas(run, columns)
