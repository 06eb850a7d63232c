"""State that outlives a run: cursors with the counts they belong to, store updates by key, lifecycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.functions import text
from crateflow.sources.sinks import VersionedTable


class Cursors:
    """Named values; a missing or unreadable number is the default. Each write is a new version, the last finished one holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, "key string, value string")

    def number(self, key: str, default: float = 0.0) -> float:
        got = self.table.read().where(F.col("key") == key).select(F.expr("try_cast(value AS double)")).limit(1).collect()
        return default if not got or got[0][0] is None else got[0][0]

    def put(self, key: str, value) -> None:
        held = self.table.read().where(F.col("key") != key)
        self.table.write(held.unionByName(held.sparkSession.createDataFrame([(key, str(value))], "key string, value string")).coalesce(1))


def counted_plays(tracks: DataFrame, history: DataFrame) -> DataFrame:
    """Tracks (track_key, play_count) with the plays of a history (artist, title) added; blank names and unknown keys count for none."""
    plays = history.select(text.file_key(F.col("artist"), F.col("title")).alias("track_key")).where("track_key IS NOT NULL").groupBy("track_key").agg(F.count("*").alias("_n"))
    return tracks.join(plays, "track_key", "left").withColumn("play_count", F.coalesce("play_count", F.lit(0)) + F.coalesce("_n", F.lit(0))).drop("_n")


class PlayStore:
    """Play counts and the cursor of the history in one version, so neither is ever written without the other."""

    SCHEMA = "track_key string, play_count bigint, cursor double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path, self.SCHEMA)

    def cursor(self) -> float:
        return self.table.read().agg(F.coalesce(F.max("cursor"), F.lit(0.0))).collect()[0][0]

    def tracks(self) -> DataFrame:
        return self.table.read().where("track_key IS NOT NULL").select("track_key", "play_count")

    def register(self, tracks: DataFrame) -> PlayStore:
        """Add tracks that are not there yet."""
        old = self.table.read()
        new = tracks.select("track_key", F.col("play_count").cast("long").alias("play_count"), F.lit(None).cast("double").alias("cursor")).where("track_key IS NOT NULL")
        self.table.write(old.unionByName(new.join(old.select("track_key"), "track_key", "left_anti").select("track_key", "play_count", "cursor")))
        return self

    def sync(self, history: DataFrame, now: float) -> PlayStore:
        """Count the plays (artist, title, played_at) after the cursor and advance it to the newest entry seen, or now if there is none."""
        at = self.cursor()
        fresh = history.where(F.col("played_at") > at) if at > 0 else history
        mark = fresh.agg(F.coalesce(F.max("played_at"), F.lit(float(now))).alias("cursor"))
        if at > 0:
            mark = mark.select(F.greatest("cursor", F.lit(at)).alias("cursor"))
        counts = counted_plays(self.tracks(), fresh).select("track_key", "play_count", F.lit(None).cast("double").alias("cursor"))
        self.table.write(counts.unionByName(mark.select(F.lit(None).cast("string").alias("track_key"), F.lit(None).cast("long").alias("play_count"), "cursor")))
        return self


def in_cooldown(deleted_at: Column, now: float, days: float) -> Column:
    """Deleted less than so many days ago."""
    return deleted_at.isNotNull() & (F.lit(now) - deleted_at < days * 86400)


def updated_by_key(df: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields set to the values that ``changes`` holds for their key; keys that aren't there are ignored."""
    new = changes.groupBy(key).agg(*(F.max_by(f, F.struct("ord", f)).alias(f"_{f}") for f in fields), F.lit(True).alias("_hit"))
    out = df.join(new, key, "left")
    return out.withColumns({f: F.when(F.col("_hit"), F.col(f"_{f}")).otherwise(F.col(f)) for f in fields}).drop("_hit", *(f"_{f}" for f in fields))


def lifecycles(actions: DataFrame, key: str, at: str, kind: str, upload: str, delete: str, play: str) -> DataFrame:
    """(key, uploaded_at, deleted_at, play_count) of each key that was ever uploaded.

    An upload makes a track active and sets its plays to none; a deletion after it marks it deleted. Two aggregations by key,
    each combined before its shuffle, take the place of a fold over ordered actions.
    """
    last = actions.where(F.col(kind) == upload).groupBy(key).agg(F.max(at).alias("uploaded_at"))
    after = actions.where(F.col(kind).isin(delete, play)).join(last, key).where(F.col(at) > F.col("uploaded_at"))
    since = after.groupBy(key).agg(F.max(F.when(F.col(kind) == delete, F.col(at))).alias("deleted_at"), F.count_if(F.col(kind) == play).alias("play_count"))
    return last.join(since, key, "left").select(key, "uploaded_at", "deleted_at", F.coalesce("play_count", F.lit(0)).alias("play_count"))
