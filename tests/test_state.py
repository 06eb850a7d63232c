from pyspark.sql import functions as F

from crateflow.operators import audits, state, tags, vectors
from crateflow.sources.connect import Breaker, Memo, Retry, Throttle, progress
from tests.test_functions import one


def test_cursor_and_counts_advance_together(spark, tmp_path):
    path = str(tmp_path / "plays")
    tracks = spark.createDataFrame([("a - x", 2), ("b - y", None), (None, 1)], "track_key string, play_count bigint")
    store = state.PlayStore(spark, path).register(tracks)
    assert store.cursor() == 0.0
    h = spark.createDataFrame([("A", "X", 10.0), ("a", "x ", 20.0), ("", "y", 30.0), ("Z", "Q", 40.0)], "artist string, title string, played_at double")
    store.sync(h, 99.0)
    again = state.PlayStore(spark, path)
    assert again.cursor() == 40.0 and {tuple(r) for r in again.tracks().collect()} == {("a - x", 4), ("b - y", 0)}
    again.sync(h, 99.0)  # nothing after the cursor
    assert again.cursor() == 99.0 and {tuple(r) for r in again.tracks().collect()} == {("a - x", 4), ("b - y", 0)}


def test_named_cursors(spark, tmp_path):
    c = state.Cursors(spark, str(tmp_path / "c"))
    assert c.number("k") == 0.0 and c.number("k", 5.0) == 5.0
    c.put("k", 7)
    c.put("other", "text")
    assert state.Cursors(spark, str(tmp_path / "c")).number("k") == 7.0 and c.number("other", 1.0) == 1.0


def test_cooldown_and_updates(spark):
    rows = [(100.0,), (100.0 - 86400,), (None,)]
    assert one(spark, "d double", rows, state.in_cooldown(F.col("d"), 100.0, 1)) == [True, False, False]
    df = spark.createDataFrame([("a", "old"), ("b", "old")], "k string, mood string")
    new = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("c", "z", 1)], "k string, mood string, ord int")
    assert {tuple(r) for r in state.updated_by_key(df, new, "k", ["mood"]).collect()} == {("a", "y"), ("b", "old")}


def test_tags(spark):
    df = spark.createDataFrame([(["Rock", "rock "], ["Pop", "rock"], []), ([], None, [" "]), (None, None, ["live"])], "a array<string>, b array<string>, c array<string>")
    got = [(r.u.tags, r.u.sources_hit) for r in df.select(tags.united([("m", F.col("a")), ("d", F.col("b"))], ("f", F.col("c"))).alias("u")).collect()]
    assert got == [(["rock", "pop"], ["m", "d"]), ([], []), (["live"], ["f"])]
    got = df.select(tags.curated_then_crowd(F.col("a"), F.col("b")).alias("t")).collect()
    assert got[0].t == ["rock", "rock", "pop"]
    body = [('{"toptags": {"tag": [{"name": "Rock"}, {"count": 1}]}}',), ('{"toptags": {"tag": {"name": "x"}}}',), ("{}",), ("bad",), (None,)]
    assert one(spark, "b string", body, tags.of_top_tags(F.col("b"))) == [["rock"], [], [], [], []]


def test_audits(spark):
    rows = [(5, "codec", 1.0, None), (20_000, None, 1.0, None), (20_000, "wma", 1.0, None), (20_000, "mp3", 0.0, None), (20_000, "mp3", 9.0, "fine\nError a\nCORRUPT b"), (20_000, "mp3", 9.0, "fine")]
    got = one(spark, "s int, c string, d double, e string", rows, audits.download_problem(F.col("s"), F.col("c"), F.col("d"), F.col("e")))
    assert got == ["File too small (< 10KB)", "No audio stream found", "Unexpected audio codec: wma", "Invalid duration (0 or negative)", "Decode errors: Error a; CORRUPT b", ""]


def test_vectors_of_any_kind(spark, tmp_path):
    ref = spark.createDataFrame([([1.0, 0.0],), ([0.0, 1.0],), (None,)], "v array<float>")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [1.0]), ("d", [0.5, 0.5])], "k string, v array<float>")
    assert {r.k: r.score for r in vectors.best_mean(q, ref, "k", "v", 5).collect()} == {"a": 0.5, "d": 0.5}
    small, vectors.SMALL_VALUES = vectors.SMALL_VALUES, 1
    try:
        assert {r.k: r.score for r in vectors.best_mean(q, ref, "k", "v", 1).collect()} == {"a": 1.0, "d": 0.5}
    finally:
        vectors.SMALL_VALUES = small
    assert vectors.best_mean(q, ref.limit(0), "k", "v", 5).count() == vectors.best_mean(q.limit(0), ref, "k", "v", 5).count() == 0
    store = vectors.VectorStore(spark, str(tmp_path / "v"))
    assert store.all().count() == 0
    store.add(spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "key string, vector array<float>"))
    store.add(spark.createDataFrame([("a", [3.0])], "key string, vector array<float>"))
    assert {r.key: r.vector for r in store.all().collect()} == {"a": [3.0], "b": [2.0]}
    store.data.write(spark.createDataFrame([("z", [0.0])], "key string, vector array<float>"))  # the index wasn't written
    assert store.all().count() == 0


def test_connector_helpers():
    assert [round(Retry(1, 60).delay(n, lambda: 0.5), 3) for n in (0, 1, 3, 9)] == [1, 2, 8, 60]
    b = Breaker()
    for _ in range(5):
        assert b.state(0) == "closed"
        b.failure(0)
    assert b.state(59) == "open" and b.state(60) == "half_open"
    b.failure(60)
    assert b.state(61) == "open"
    b.success()
    assert b.state(61) == "closed"
    t = Throttle(1.05)
    assert t.wait(0) == 0 and abs(t.wait(0.05) - 1.0) < 1e-9 and t.wait(50) == 0
    m = Memo(4)
    for i in range(5):
        m.put(i, i)
    assert [m.get(i) for i in range(5)] == [None, None, 2, 3, 4]
    assert progress(10, 30, 5) == (2.0, 10.0) and progress(0, 5, 0) == (0.0, 0.0)


def _loader():
    return (lambda x: x * 2), {"total": lambda s: s.sum(1), "top": lambda s: s.max(1)}


def test_models_and_settings(spark):
    import pytest

    from crateflow.config import Gates, Settings
    from crateflow.operators.models import scored

    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None), ("c", [0.0])], "k string, v array<float>")
    assert [tuple(r) for r in scored(df, "k", "v", 2, _loader, ["total", "top"]).collect()] == [("a", 6.0, 4.0)]
    s = Settings.read({"STATION_URL": "https://x/", "STATION_KEY": "12345678", "STATION_ID": "2", "TAG_KEY": "t"})
    assert (s.station_url, s.station_id, s.missing()) == ("https://x", 2, ["release_token", "notify_key"])
    for bad in ({"station_url": "x", "station_key": "12345678"}, {"station_url": "http://x", "station_key": "1"}, {"station_url": "http://x", "station_key": "12345678", "station_id": 0}):
        with pytest.raises(ValueError):
            Settings(**bad)
    with pytest.raises(ValueError):
        Gates(shortest=400)


def test_sinks_and_readers(spark, tmp_path):
    from crateflow.sources import readers, sinks

    q = spark.createDataFrame([("1", "a", "t", None, "a - t", "s", 9)], "id string, artist string, title string, cover string, search string, source string, extra int")
    sinks.write_queue(q, str(tmp_path / "q"))
    assert readers.queue(spark, str(tmp_path / "q")).collect()[0].artist == "a" and readers.queue(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad.json").write_text('"text"')
    assert readers.queue(spark, str(tmp_path / "bad.json")).count() == 0
    assert sinks.after_uploads(q, 0).count() == 0 and sinks.after_uploads(q, 2).count() == 1
    sinks.write_statistics(spark.createDataFrame([(3, 1)], "ok int, failed int"), str(tmp_path / "stats"))
    assert tuple(readers.statistics(spark, str(tmp_path / "stats"), "ok int, failed int").collect()[0]) == (3, 1)
    assert readers.statistics(spark, str(tmp_path / "no"), "ok int").count() == 0
    cache = sinks.TagCache(spark, str(tmp_path / "cache"))
    assert not cache.flush()
    cache.put(spark.createDataFrame([("k", ["x"], 1.0)], cache.SCHEMA))
    assert cache.flush() and not cache.flush() and cache.table.read().count() == 1
    (tmp_path / "station.json").write_text('{"id": 1, "backend_config": {"duplicate_prevention_time_range": 120}, "backend_type": "x"}')
    assert readers.station_config(spark, str(tmp_path / "station.json")).collect()[0].backend_config.duplicate_prevention_time_range == 120
    (tmp_path / "rows.jsonl").write_text("".join('{"artist": "a%d", "title": "t"}\n' % i for i in range(50)) + "broken\n")
    spark.dataSource.register(readers.RecordsSource)
    for parts in (1, 3, 80):
        got = spark.read.format("records").option("path", str(tmp_path / "rows.jsonl")).option("partitions", parts).load()
        assert sorted(r.artist for r in got.collect()) == sorted(f"a{i}" for i in range(50))
    sinks.write_profile(spark, str(tmp_path / "p"), spark.createDataFrame([("a", [1.0])], "k string, v array<float>"), spark.createDataFrame([("A",)], "artist string"), "now")
    assert spark.read.parquet(str(tmp_path / "p/artists")).count() == 1
