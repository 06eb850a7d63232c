import pytest
from pyspark.sql import functions as F

from crateflow.streaming import events


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    """Events in four files that come one after the other, one of them late."""
    at = tmp_path_factory.mktemp("stream")
    rows = [(i, 1_704_000_000 + 1_500 * (i * 7 % 40), i % 5, ("click", "view", "purchase")[i % 3], 1.0, None) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id bigint, s bigint, user_id bigint, event_type string, value double, props string")
    df = df.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")
    for k in range(4):
        df.where(f"event_id % 4 = {k}").coalesce(1).write.mode("append").parquet(f"{at}/events.parquet")
    return str(at), df


def test_state_is_carried_from_batch_to_batch(spark, cut, monkeypatch):
    path, df = cut
    monkeypatch.setattr(events, "FILES", 1)
    plain = lambda d, *c: {tuple(r) for r in d.select(*c).collect()}
    want = df.groupBy("user_id").agg(F.count("*").alias("plays"), F.max("ts").alias("last_ts"))
    assert plain(events.play_counts(spark, path), "user_id", "plays", "last_ts") == plain(want, "user_id", "plays", "last_ts")
    want = df.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("clicks"), F.count("*").alias("n"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))
    assert plain(events.lifecycle(spark, path), "user_id", "clicks", "n", "last_type") == plain(want, "user_id", "clicks", "n", "last_type")
    want = df.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").start.cast("timestamp_ntz").alias("hour_start"), "event_type").agg(F.count("*").alias("n"))
    assert plain(events.tumbling_counts(spark, path), "hour_start", "event_type", "n") == plain(want, "hour_start", "event_type", "n")
    want = df.select("user_id", "event_type", F.to_date("ts").alias("d")).distinct().groupBy("user_id", "event_type").agg(F.count("*").alias("first_rows"))
    assert plain(events.first_per_day(spark, path), "user_id", "event_type", "first_rows") == plain(want, "user_id", "event_type", "first_rows")
    got = events.sessions(spark, path)
    assert got.agg(F.sum("n")).collect()[0][0] == 40
