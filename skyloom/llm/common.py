"""Helpers shared by the training-data operators: reading tables, shared storage, small guards."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches stay small because a document may be very long.
ARROW_ROWS = 256
_written: list[str] = []


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker gets at once. Spark has this setting by session only, and reads it when a plan runs; it's lowered, never raised."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` below ``sf_dir``, read by Spark alone (the path may be remote)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset and all runs in this process (tests)."""
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir", None)
    if known:
        return known
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="skyloom-")
    sc.setCheckpointDir(made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses; :func:`clean` knows it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    It cuts the lineage, so a lost executor costs only the rereading of files, and a plan that is used twice runs once.
    """
    small_batches(df.sparkSession)
    path = fresh_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_narrow(df: DataFrame, name: str) -> DataFrame:
    """The same for rows of a few numbers: a few files a core, however many shuffle partitions there are."""
    return materialize(df.coalesce(max(32, 4 * df.sparkSession.sparkContext.defaultParallelism)), name)


def clean(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Deletes what was written to paths of :func:`fresh_path` in this application, from the path number ``since`` on, but for the table ``keep`` reads.
    Frames that read the others can't be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    kept = [p for p in _written[since:] if keep is not None and any(p.split("/")[-1] in f for f in keep.inputFiles()[:1])]
    for path in set(_written[since:]) - set(kept):
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    _written[since:] = kept


def written() -> int:
    """How many paths :func:`fresh_path` has made; what's written to later ones can be deleted by :func:`clean`."""
    return len(_written)


def collected(df: DataFrame) -> pd.DataFrame:
    """A result of bounded size on the driver, by Arrow: no row becomes Python objects on the way."""
    return df.toArrow().to_pandas()


def packed(docs: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that no name of theirs meets one of ours; ``row.*`` brings them back."""
    small_batches(docs.sparkSession)
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def fold_of(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def held_out(id_col: str = "doc_id"):
    """True where the fold is 2; a null id is never held out."""
    return F.coalesce(fold_of(id_col) == 2, F.lit(False))


def trainable(id_col: str = "doc_id"):
    """True where the fold is known and not 2."""
    return F.coalesce(fold_of(id_col) != 2, F.lit(False))
