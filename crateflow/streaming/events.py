"""Streams over event files: windows, sessions, deduplication, counters and keyed state.

Files are read as a stream with ``availableNow``, at most FILES of them in each micro-batch; results go to a written table of the
shared folder. Counts come in update mode and the last value of each key holds, so a finished stream has the rows of a batch.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from crateflow.session import scratch_path

FILES = 64
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, sf_dir: str, late: str = "40 days") -> DataFrame:
    """The event table as a stream with event time and a watermark."""
    path = f"{sf_dir}/events.parquet"
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", FILES)
    stream = raw.parquet(path) if os.path.isdir(path) or not glob.glob(path) else raw.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)


def run(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there; append results are written by the stream, others by each micro-batch."""
    spark = df.sparkSession
    out, check = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", check).trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").option("path", out).start()
    else:
        q = w.foreachBatch(lambda b, i: b.withColumn("batch_id", F.lit(i)).write.mode("overwrite").parquet(f"{out}/part={i}")).start()
    q.awaitTermination()
    return spark.read.option("basePath", out).parquet(out)


def _latest(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Of updated results the last of each key."""
    return df.groupBy(*keys).agg(*(F.max_by(v, "batch_id").alias(v) for v in values))


def tumbling_counts(spark: SparkSession, sf_dir: str, width: str = "1 hour") -> DataFrame:
    s = event_stream(spark, sf_dir).groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour_start"), "event_type", "n")
    out = _latest(run(s, "tumbling", "update"), ["hour_start", "event_type"], ["n"])
    return out.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


def sliding_counts(spark: SparkSession, sf_dir: str, width: str = "1 hour", step: str = "30 minutes") -> DataFrame:
    s = event_stream(spark, sf_dir).groupBy(F.window("at", width, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("slide_start"), "n")
    return _latest(run(s, "sliding", "update"), ["slide_start"], ["n"]).withColumn("slide_start", F.col("slide_start").cast("timestamp_ntz"))


def sessions(spark: SparkSession, sf_dir: str, gap: str = "2 hours") -> DataFrame:
    """Sessions of each user; complete output, as a stream that ends leaves its last sessions open in append mode."""
    s = event_stream(spark, sf_dir).groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("session_start"), "n")
    done = run(s, "sessions", "complete")
    last = done.agg(F.max("batch_id")).collect()[0][0]
    return done.where(F.col("batch_id") == last).select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


def first_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user, type and day, however often it comes."""
    s = event_stream(spark, sf_dir).withColumn("day", F.to_date("at")).dropDuplicates(["user_id", "event_type", "day"]).select("user_id", "event_type", "day")
    return run(s, "dedup").groupBy("user_id", "event_type").agg(F.count("*").alias("first_rows"))


def play_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts with the time last seen, kept by update output; late rows count, unlike with a moving cursor."""
    s = event_stream(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("plays"), F.max("ts").alias("last_ts"))
    return _latest(run(s, "counts", "update"), ["user_id"], ["plays", "last_ts"])


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    clicks, n, last, at, eid = state.get if state.exists else (0, 0, None, -1, -1)
    for pdf in batches:
        clicks += int((pdf.event_type == "click").sum())
        n += len(pdf)
        top = pdf.sort_values(["us", "event_id"]).iloc[-1]
        if (int(top.us), int(top.event_id)) > (at, eid):
            last, at, eid = top.event_type, int(top.us), int(top.event_id)
    state.update((clicks, n, last, at, eid))
    yield pd.DataFrame({"user_id": [key[0]], "clicks": [clicks], "n": [n], "last_type": [last]})


def lifecycle(spark: SparkSession, sf_dir: str, step: Callable = _advance) -> DataFrame:
    """Keyed state: each user's counters and last event type, carried from micro-batch to micro-batch."""
    s = event_stream(spark, sf_dir).select("user_id", "event_type", "event_id", F.unix_micros("at").alias("us")).groupBy("user_id")
    s = s.applyInPandasWithState(step, "user_id bigint, clicks bigint, n bigint, last_type string", "clicks bigint, n bigint, last string, at bigint, eid bigint", "update", GroupStateTimeout.NoTimeout)
    return _latest(run(s, "lifecycle", "update"), ["user_id"], ["clicks", "n", "last_type"])
