"""Writers: versioned tables, ring buffers, reports and action logs. Every write is a new folder, so a retry harms nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under a path whose writing has ended, sorted."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes on disk under a path, asked of Hadoop's file system (local, HDFS and object stores alike)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


class VersionedTable:
    """A table whose versions are folders; readers see the last finished one."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def versions(self) -> list[str]:
        return finished_folders(self.spark, self.path)

    def read(self) -> DataFrame:
        v = self.versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{v[-1]}") if v else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame) -> str:
        """Write the next version; the plan may read the present one."""
        v = self.versions()
        name = f"v{int(v[-1][1:]) + 1 if v else 1:08d}"
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return name


def ring_append(old: DataFrame, new: DataFrame, order: str, keep: int = 30) -> DataFrame:
    """The last ``keep`` rows of old and new."""
    return old.unionByName(new).orderBy(F.desc(order)).limit(keep)


def pruned(store: DataFrame, valid: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows with valid keys and how many were dropped."""
    kept = store.join(valid.select(key), key, "left_semi")
    return kept, store.count() - kept.count()


def last_wins(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows replaced by new ones of the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def appended(queue: DataFrame, new: DataFrame, by) -> DataFrame:
    """Queue with the new rows whose key isn't queued yet."""
    k = "_k"
    return queue.unionByName(new.withColumn(k, by).join(queue.select(by.alias(k)), k, "left_anti").drop(k))


def actions(df: DataFrame, op: str, key: str) -> DataFrame:
    """Rows of an action log, to be carried out idempotently."""
    return df.select(F.lit(op).alias("op"), F.col(key).cast("string").alias("key")).distinct()


def report(df: DataFrame, status: str) -> DataFrame:
    """Counts by status with shares, as one JSON text."""
    n = df.groupBy(status).agg(F.count("*").alias("n"))
    return n.agg(F.to_json(F.struct(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(status), F.col("n"))))).alias("by_status"))).alias("report"))


QUEUE = ["id", "artist", "title", "cover", "search", "source"]


def write_queue(df: DataFrame, path: str) -> None:
    """The six columns of the queue as JSON; readers see the old or the new queue, never a part."""
    df.select(*QUEUE).write.mode("overwrite").json(path)


def write_statistics(df: DataFrame, path: str) -> None:
    """One row of a run's numbers."""
    df.coalesce(1).write.mode("overwrite").json(path)


def first_spellings(entries: DataFrame, artist: str, key, order: str) -> DataFrame:
    """Distinct artists by a comparable key, in the spelling that came first; blank keys are none."""
    return entries.where(F.col(artist).isNotNull()).select(artist, key.alias("_k"), order).where("_k <> ''").groupBy("_k").agg(F.min_by(artist, order).alias(artist)).select(artist)


def write_profile(spark: SparkSession, path: str, vectors: DataFrame, artists: DataFrame, built_at: str) -> None:
    """A profile's vectors, its artists and when it was built; the time is written last and makes it whole."""
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    artists.write.mode("overwrite").parquet(f"{path}/artists")
    spark.createDataFrame([(built_at,)], "built_at string").coalesce(1).write.mode("overwrite").json(f"{path}/built")


class TagCache:
    """Tags of look-ups by key; nothing is written unless something new was put."""

    SCHEMA = "k string, tags array<string>, at double"

    def __init__(self, spark: SparkSession, path: str):
        self.table, self.new = VersionedTable(spark, path, self.SCHEMA), None

    def put(self, rows: DataFrame) -> None:
        self.new = rows.select("k", "tags", "at") if self.new is None else last_wins(self.new, rows.select("k", "tags", "at"), "k")

    def flush(self) -> bool:
        if self.new is None:
            return False
        self.table.write(last_wins(self.table.read(), self.new, "k"))
        self.new = None
        return True


def after_uploads(queue: DataFrame, failed: int) -> DataFrame:
    """The queue that is left after a run: empty if nothing failed, else as it was, so the next run tries again."""
    return queue if failed else queue.limit(0)
