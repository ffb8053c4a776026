"""Reading and writing tables. Paths may be remote; only Spark and Hadoop's file system touch them."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import nan_to_null

#: Folders of stages below the interim folder, in order (fixed values).
STAGES = ("01_initial_merge", "02_quality_filtered", "03_feature_engineered", "04_scaled_encoded")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def modified(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(time, path) of the entries of a folder; empty if there's none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(x.getModificationTime(), x.getPath().toString()) for x in fs.listStatus(at)] if fs.exists(at) else []


def scan_parquet(spark: SparkSession, path: str, columns: Iterable[str] | None = None, where: str | None = None) -> DataFrame:
    """Strict about ``columns``; NaN becomes null.

    ``where`` reaches the scan as a pushed filter; it's asked again after NaN became null, for NaN is larger than all numbers to Spark.
    """
    df = spark.read.parquet(path)
    df = df.filter(where) if where else df
    df = nan_to_null(df.select(*columns) if columns else df)
    return df.filter(where) if where else df


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """With a header; give a schema to spare the pass that infers types. Dates stay text."""
    reader = spark.read.option("header", True).option("prefersDate", False).option("inferTimestamp", False)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    return nan_to_null(df.select(*(F.col(f"`{c}`").cast("string").alias(c) if t in ("date", "timestamp") else F.col(f"`{c}`") for c, t in df.dtypes)))


def keep(df: DataFrame, columns: Iterable[str] | None) -> DataFrame:
    """Only the listed columns that exist; no list keeps all."""
    names = [c for c in df.columns if c in set(columns)] if columns else df.columns
    return df.select(*(F.col(f"`{c}`") for c in names))


def scan_any(spark: SparkSession, folder: str, name: str, columns: Iterable[str] | None = None, required: bool = False) -> DataFrame | None:
    """``folder/name/name.parquet``, else ``.csv``; a missing source is None, or an error if required."""
    for end, scan in (("parquet", scan_parquet), ("csv", scan_csv)):
        if exists(spark, path := f"{folder}/{name}/{name}.{end}"):
            return keep(scan(spark, path), columns)
    if required:
        raise FileNotFoundError(f"{folder}/{name}/{name}.(parquet|csv)")
    return None


def ingest(spark: SparkSession, raw: str, out: str, columns: Iterable[str] | None = None, url: str | None = None) -> DataFrame:
    """A landed raw file to Parquet. The format follows the url's ending: Parquet is strict about columns, all else is CSV."""
    told = (url or raw).lower()
    df = scan_parquet(spark, raw, columns) if told.endswith(".parquet") else keep(scan_csv(spark, raw), columns)
    df.write.mode("overwrite").parquet(out)
    return spark.read.schema(df.schema).parquet(out)


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def placeholder(spark: SparkSession, name: str, columns: Iterable[str], key: str) -> DataFrame:
    """One row of nulls with a dummy key, for a source that couldn't be fetched."""
    columns = list(dict.fromkeys([*columns, key]))
    return spark.range(1).select(*(F.lit(f"dummy_{name}" if c == key else None).cast("string").alias(c) for c in columns))


def stage_path(interim: str, stage: str, name: str) -> str:
    return f"{interim}/{stage}/{name}.parquet"


def write_stage(df: DataFrame, interim: str, stage: str, name: str) -> str:
    path = stage_path(interim, stage, name)
    df.write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, interim: str, stage: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    for end, scan in (("parquet", scan_parquet), ("csv", scan_csv)):
        if exists(spark, path := f"{interim}/{stage}/{name}.{end}"):
            df = scan(spark, path)
            return df.select(*columns) if columns else df
    raise FileNotFoundError(f"{interim}/{stage}/{name}.(parquet|csv)")


def latest_stage(spark: SparkSession, interim: str, last: int = 3) -> str | None:
    """The newest table of the last stage that has one."""
    for stage in reversed(STAGES[:last]):
        found = [x for x in modified(spark, f"{interim}/{stage}") if x[1].endswith(".parquet")]
        if found:
            return max(found)[1]
    return None


def write_tables(tables: dict[str, DataFrame], folder: str, codec: str = "zstd", rows_a_file: int | None = None) -> dict[str, str]:
    """One folder a table; a failure is an error."""
    out = {}
    for name, df in tables.items():
        writer = df.write.mode("overwrite").option("compression", codec)
        if rows_a_file:
            writer = writer.option("maxRecordsPerFile", rows_a_file)
        writer.parquet(path := f"{folder}/{name}.parquet")
        out[name] = path
    return out


def export(df: DataFrame, folder: str, name: str, formats: Iterable[str] = ("parquet", "csv"), compression: str | None = None) -> dict[str, str]:
    """Known formats are written, others named under 'skipped'."""
    out: dict[str, str] = {}
    for f in formats:
        if f not in ("parquet", "csv"):
            out["skipped"] = ",".join([*filter(None, [out.get("skipped")]), f])
            continue
        writer = df.write.mode("overwrite")
        if compression and f == "csv":
            writer = writer.option("compression", {"gz": "gzip", "bz2": "bzip2"}.get(compression, compression))
        out[f] = f"{folder}/{name}.{f}"
        writer.parquet(out[f]) if f == "parquet" else writer.option("header", True).csv(out[f])
    return out


def parquet_to_csv(spark: SparkSession, path: str, out: str, compression: str | None = None) -> str:
    """gzip, bz2 or none; Spark writes no zip or xz."""
    if compression not in (None, "gzip", "gz", "bz2", "bzip2"):
        raise ValueError(f"CSV can't be compressed by {compression} here")
    at = PurePosixPath(out)
    return export(spark.read.parquet(path), str(at.parent), at.stem, ["csv"], compression)["csv"]


def data_status(spark: SparkSession, paths: dict[str, str]) -> dict[str, dict]:
    """Rows of each named table; 'missing', 'csv only' or 'corrupted' where that holds."""
    out = {}
    for name, base in paths.items():
        kind = next((e for e in ("parquet", "csv") if exists(spark, f"{base}.{e}")), None)
        if kind is None:
            out[name] = {"status": "missing"}
            continue
        try:
            n = (scan_parquet if kind == "parquet" else scan_csv)(spark, f"{base}.{kind}").count()
            out[name] = {"status": "ok" if kind == "parquet" else "csv only", "rows": n}
        except Exception as e:  # a table that can't be read is what this reports
            out[name] = {"status": "corrupted", "error": type(e).__name__}
    return out
