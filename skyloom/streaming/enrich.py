"""Continuous enrichment of rows as they land: the stateless steps run unchanged on a stream; ids are deduplicated under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.text import norm_name
from ..operators import physics, quality


def landed(spark: SparkSession, folder: str, schema: StructType | str, files_a_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def enrich_stream(stream: DataFrame) -> DataFrame:
    """Physics and completeness, row by row."""
    return quality.add_completeness(physics.derive_features(stream), available_only=True)


def first_of_each(stream: DataFrame, event_time: str, key: str = "pl_name", late: str = "1 day") -> DataFrame:
    """The first row of each name within the watermark; state is dropped beyond it."""
    named = stream.withWatermark(event_time, late).withColumn("planet_id", norm_name(key))
    return named.dropDuplicatesWithinWatermark(["planet_id"])
