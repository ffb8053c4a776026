"""Takes in text records as their files land: standardises and checks them, tells copies of what came before, and keeps a profile of every batch.

    python -m jobs.text_intake --config jobs/text_intake.json --landing 'DIR/{documents}.parquet' --out DIR --checkpoint DIR

A run streams the files that the checkpoint doesn't know, and ends. Each batch has its own folders below ``out``, which a batch that is run again after a failure replaces:
``groups/batch=<n>`` (texts that came more than once), ``records/batch=<n>`` (partitioned by status and the column the settings name), ``profile/batch=<n>`` (quantile sketches of the settings' columns) and, from the second
batch on, ``drift/batch=<n>`` (that batch against all before it, from sketches alone). So a repeated run with nothing new changes nothing.

A record is ``accepted``; ``rejected`` if it breaks a rule (``violations``); or a ``duplicate`` of ``first_id``: an accepted record of an earlier batch with the same
text but for white space, or else the one of least id in its own; a row that repeats an accepted one with its id is accepted too. Rejected records aren't originals. A null or
blank text is no copy of another. An empty file makes an empty batch. The landing path is a folder or a pattern (a plain file isn't a stream's path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, main, stored
from skyloom.operators import drift, rules

#: A text with more than one in so many rows of a batch's repeated texts is hot.
SHARE = 1000


def standard(df: DataFrame, config: dict) -> DataFrame:
    """Blank strings become null, the length is counted, and the text has a digest that white space doesn't change."""
    text, kinds = config["text"], dict(df.dtypes)
    blank = [c for c in df.columns if kinds[c] == "string" and c != text]
    df = df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in blank})
    plain = F.btrim(F.regexp_replace(text, r"[\t\n\x0B\f\r ]+", " "))
    return df.withColumns({"counted_chars": F.char_length(text).cast("long"), "digest": F.when(plain != "", F.sha2(plain, 256))})


def good() -> Column:
    return F.size("violations") == 0


def originals(df: DataFrame, before: DataFrame | None, key: str) -> DataFrame:
    """(digest, first_id, earlier, n) of the texts that a batch has more than once, or that an earlier one has: a minimum a text, combined before the exchange."""
    own = df.filter(good() & F.col("digest").isNotNull()).groupBy("digest").agg(F.min(key).alias("own_id"), F.count("*").alias("n"))
    if before is None:
        return own.filter("n > 1").select("digest", F.col("own_id").alias("first_id"), F.lit(False).alias("earlier"), "n")
    known = before.filter("status = 'accepted'").groupBy("digest").agg(F.min(key).alias("known_id"), F.lit(True).alias("known"))
    met = own.join(known, "digest", "left").filter("n > 1 or known")
    return met.select("digest", F.when(F.col("known"), F.col("known_id")).otherwise(F.col("own_id")).alias("first_id"), F.coalesce("known", F.lit(False)).alias("earlier"), "n")


def judged(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Status and original of a batch's checked records. ``groups``: a written table of :func:`originals`.

    Texts with more than one in ``SHARE`` of the rows of all groups are fewer than that, so they're sent to all tasks; the other rows are dealt by
    digest, and those that need no lookup by their own id, so that no task gets a hot text's rows.
    """
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = groups.withColumnRenamed("digest", "_digest")
    hot, rest = groups.filter(F.col("n") * SHARE > total).drop("n"), groups.filter(F.col("n") * SHARE <= total)
    looked = df.join(F.broadcast(hot), good() & (F.col("digest") == F.col("_digest")), "left")
    asks = good() & F.col("digest").isNotNull() & F.col("_digest").isNull()
    looked = looked.withColumn("_key", F.when(asks, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64(key).cast("string")))).drop("_digest")
    looked = looked.join(rest.select(F.col("_digest").alias("_key"), F.col("first_id").alias("_first"), F.col("earlier").alias("_earlier")), "_key", "left")
    first, earlier = F.coalesce("first_id", "_first"), F.coalesce("earlier", "_earlier")
    copy = earlier.isNotNull() & (earlier | ~F.col(key).eqNullSafe(first))
    status = F.when(~good(), "rejected").when(copy, "duplicate").otherwise("accepted")
    return looked.withColumns({"status": status, "first_id": F.when(good() & copy, first)}).drop("_key", "_first", "earlier", "_earlier")


def take(spark: SparkSession, batch: DataFrame, number: int, out: str, config: dict) -> int:
    """One batch: its records, profile and drift. Everything is written to the batch's own folders, and reads only batches before it. Returns the number of rows."""
    before = stored(spark, f"{out}/records")
    before = before if before is None else before.filter(F.col("batch") < number)
    parts, seen = ["status", config["partition"]], Observation(f"intake-{number}")
    df = rules.check(standard(batch, config), rules.from_config(config["rules"]))
    groups = originals(df, before, config["key"])
    groups.write.mode("overwrite").parquet(at := f"{out}/groups/batch={number}")
    rows = judged(df, spark.read.schema(groups.schema).parquet(at), config["key"]).withColumn("violations", F.concat_ws(",", "violations"))
    counts = (F.sum((F.col("status") == s).cast("long")).alias(s) for s in ("accepted", "duplicate", "rejected"))
    rows = rows.observe(seen, F.count("*").alias("rows"), *counts)
    rows.write.mode("overwrite").partitionBy(*parts).option("maxRecordsPerFile", config["rows_a_file"]).parquet(path := f"{out}/records/batch={number}")
    log.info("batch %d: wrote %s: %s", number, path, seen.get)
    kept = spark.read.schema(rows.schema).parquet(path)
    drift.sketches(kept.filter("status = 'accepted'"), config["profiled"], F.lit(str(number))).drop("release").write.mode("overwrite").parquet(f"{out}/profile/batch={number}")
    profiles = stored(spark, f"{out}/profile")
    earlier, now = profiles.filter(F.col("batch") < number), profiles.filter(F.col("batch") == number)
    if number and not earlier.isEmpty():
        shift = drift.compare(drift.merged(earlier, ["column"]), now)
        shift.withColumn("drifted", F.col("largest_gap") > config["largest_gap"]).write.mode("overwrite").parquet(path := f"{out}/drift/batch={number}")
        log.info("batch %d: wrote %s", number, path)
    return seen.get["rows"]


def run(spark: SparkSession, landing: str, out: str, checkpoint: str, config: dict) -> DataFrame | None:
    """Takes in all files of ``landing`` that aren't in yet, waits for the end, and returns all records as read back; None if there never was one."""
    landed = stored(spark, landing)
    if landed is None:
        log.info("nothing has landed in %s yet", landing)
        return stored(spark, f"{out}/records")
    stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", config["files_a_batch"]).parquet(landing)
    log.info("reading what is new in %s since %s", landing, checkpoint)
    taken: list[int] = []
    query = stream.writeStream.foreachBatch(lambda batch, number: taken.append(take(batch.sparkSession, batch, number, out, config))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d new rows in %d batches", sum(taken), len(taken))
    return stored(spark, f"{out}/records")


if __name__ == "__main__":
    main("text_intake", run, {"landing": "folder or pattern of landed files", "out": "folder of the records", "checkpoint": "folder of the stream's marks"})
