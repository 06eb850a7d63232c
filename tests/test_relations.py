from pyspark.sql import functions as F

from crateflow.operators import relations as rel
from crateflow.operators import vectors
from crateflow.sources import readers, sinks


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


def test_first_heads_and_claims(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 5)], "k string, o int")
    assert rows(rel.keep_first(df, ["k"], ["o"])) == rows(spark.createDataFrame([("a", 1), ("b", 3), (None, 4)], "k string, o int"))
    assert rows(rel.later_claims(df, ["k"], ["o"])) == [("a", 2), (None, 5)]
    assert rel.capped(df, ["o"], 2).count() == 2 and rel.keep_first(df.limit(0), ["k"], ["o"]).count() == 0


def test_look_ups(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "i int, k string")
    b = spark.createDataFrame([("x", 9), ("x", 8), ("y", 7)], "k string, v int")
    assert rows(rel.looked_up(a, b, "k", ["v"], "v", "first"), "i", "first") == [(1, 8), (2, 7), (3, None)]
    assert rows(rel.unique_match(a, b, "k", "v"), "i", "v") == [(1, None), (2, 7), (3, None)]
    c = rel.duplicate_classes(b.union(b), "k", "v", ["v"])
    assert rows(c, "v", "class_key", "class_rows") == [(7, 7, 2), (7, 7, 2), (8, 8, 4), (8, 8, 4), (9, 8, 4), (9, 8, 4)]
    cache = spark.createDataFrame([("x", [], 100.0), ("y", ["t"], 10.0)], "k string, v array<string>, at double")
    assert rows(rel.cached_or(a, cache, "k", "v", "at", 130.0, 50.0), "i", "cached", "hit") == [(1, [], True), (2, None, False), (3, None, False)]


def test_upserts_and_counters(spark):
    old = spark.createDataFrame([("a", "A", 1), ("b", "B", 1)], "k string, n string, v int")
    new = spark.createDataFrame([("b", "Z", 2), ("c", "C", 3), ("c", "D", 4)], "k string, n string, v int")
    assert rows(rel.upserted(old, new, "k", ["n"], ["v"], ["v"])) == [("a", "A", 1), ("b", "B", 2), ("c", "D", 4)]
    gone = rel.soft_deleted(old.withColumn("at", F.lit(None).cast("double")), new, "k", "at", 5.0, ["v"])
    assert rows(gone, "k", "at", "v") == [("a", None, 1), ("b", 5.0, None)]
    assert rows(rel.counted(old.select("k", "v"), new, "k", "v")) == [("a", 1), ("b", 2)]
    e = spark.createDataFrame([(1.0,), (2.0,)], "at double")
    assert rel.after_cursor(e, "at", 1.0).count() == 1 and rel.after_cursor(e, "at", 0.0).count() == 2


def test_orders_without_one_task(spark):
    df = spark.range(1000).repartition(7)
    assert [r.rank for r in rel.global_ranks(df, ["id"]).orderBy("id").collect()] == list(range(1000))
    assert sorted(r.id for r in rel.strided(df, ["id"], 10).collect()) == list(range(0, 1000, 100))
    got, cursor = rel.rotated(spark.range(3), ["id"], 2, 2)
    assert sorted(r.id for r in got.collect()) == [0, 2] and cursor == 1
    d = spark.createDataFrame([("x", "a1", 1), ("x", "a1", 2), ("x", "a2", 3), ("y", "b", 4), ("y", "b", 5)], "g string, p string, o int")
    assert rows(rel.round_robin(d, "g", "p", ["o"], 2), "o") == [(1,), (3,), (4,), (5,)]


def test_reasons_and_tags(spark):
    df = spark.createDataFrame([(1, [" Rock", "rock", None, ""]), (2, ["jazz", "reggae", "gospel"])], "d int, t array<string>")
    assert [r[0] for r in df.select(rel.ordered_distinct(F.col("t"))).collect()] == [["rock"], ["jazz", "reggae", "gospel"]]
    assert [r[0] for r in df.select(rel.first_blocked(F.col("t"), ["gospel", "reggae"])).collect()] == [None, "reggae"]
    assert [r[0] for r in df.select(rel.first_reason((F.col("d") < 2, "low"), (F.col("d") < 3, "mid"))).collect()] == ["low", "mid"]


def test_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "p"), (1, [0.9, 0.1], "p"), (2, [0.0, 1.0], "q"), (3, [0.8, 0.2], "q")], "i bigint, v array<float>, l string")
    assert [r.i for r in vectors.nearest(df, "i", "v", 0, 2).collect()] == [1, 3]
    assert [r.i for r in vectors.nearest(df, "i", "v", 0, 2, df.where("l = 'q'")).collect()] == [3, 2]
    assert [r.i for r in vectors.walk(df, "i", "v", 0, 9).orderBy("step").collect()] == [0, 1, 3, 2]
    got = {r.i: round(r.score, 5) for r in vectors.best_mean(df.where("l = 'q'"), df.where("l = 'p'"), "i", "v", 50).collect()}
    assert got == {2: 0.05, 3: 0.77}


def test_sources(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"ord":1,"artist":" A ","title":"T","thumb_url_large":"u"}\nbroken\n{"ord":2,"artist":" ","title":"T"}\n')
    assert rows(readers.chart(spark, str(p)), "artist", "cover", "search") == [("A", "u", "A - T")]
    assert readers.chart(spark, str(tmp_path / "none")).count() == 0
    e = spark.createDataFrame([("f", 1, "A - B", "l/ok"), ("f", 2, "C - D", "l/no"), ("f", 3, "E - F", "l/ok"), ("g", 1, "x ~ y", None)], "label string, entry_ord int, title string, link string")
    s = spark.createDataFrame([("u", "dash", "ok", "f", True, 2), ("u", "tilde", None, "g", None, None), ("u", "odd", None, "h", True, 5)], readers.FEED)
    assert rows(readers.feeds(e, s), "artist", "title", "source") == [("A", "B", "f"), ("x", "y", "g")]
    sim = spark.createDataFrame([("S", 1, "N1", "0.9"), ("S", 2, "s", "0.9"), ("S", 3, "N2", "0.1"), ("S", 4, "N3", "0.5")], "seed string, ord int, name string, match string")
    top = spark.createDataFrame([("n1", 1, "t1", None), ("N3", 1, "t2", [("large", "img")])], "artist string, ord int, name string, image array<struct<size:string,text:string>>")
    assert rows(readers.personal(sim, spark.createDataFrame([("S", 0)], "artist string, ord int"), top), "artist", "title", "cover") == [("N1", "t1", None), ("N3", "t2", "img")]
    spark.dataSource.register(readers.RecordsSource)
    assert rows(spark.read.format("records").option("path", str(p)).load(), "artist", "title") == [(" ", "T"), (" A ", "T")]
    f = spark.createDataFrame([("a/X - Y.mp3", {"BPM": "x", "MOOD": "Sad"}), ("b/q.mp3", {"ARTIST": "Z"})], "path string, frames map<string,string>")
    assert rows(readers.identity(f), "artist", "title") == [("X", "Y"), ("Z", "q")]
    assert rows(readers.tag_frames(f), "bpm", "mood") == [(0, ""), (0, "Sad")]


def test_sinks(spark, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"), "k int, v int")
    assert t.read().count() == 0
    t.write(spark.createDataFrame([(1, 1)], "k int, v int"))
    t.write(t.read().withColumn("v", F.col("v") + 1))
    assert rows(t.read()) == [(1, 2)] and len(t.versions()) == 2
    d = spark.createDataFrame([(i, i) for i in range(40)], "k int, v int")
    assert sinks.ring_append(d, spark.createDataFrame([(99, 99)], "k int, v int"), "v").count() == 30
    kept, dropped = sinks.pruned(d, d.where("k < 10"), "k")
    assert (kept.count(), dropped) == (10, 30)
    assert sinks.last_wins(d, spark.createDataFrame([(1, 7)], "k int, v int"), "k").where("k = 1").collect()[0].v == 7
    assert sinks.appended(d, spark.createDataFrame([(1, 0), (77, 0)], "k int, v int"), F.col("k")).count() == 41
    assert '"total":40' in sinks.report(d.withColumn("s", F.lit("ok")), "s").collect()[0][0]
