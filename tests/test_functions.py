from pyspark.sql import functions as F

from crateflow.functions import fuzzy, numbers, text


def one(spark, schema, rows, col):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(col).collect()]


def test_track_key(spark):
    rows = [("  Beach House  ", "Space Song "), ("M83", "Wait (Live)"), ('Artist "X"', "Song [Remaster]"), ("A  B", "C   D"), (None, "x")]
    assert one(spark, "a string, t string", rows, text.track_key(F.col("a"), F.col("t"))) == ["beach house - space song", "m83 - wait live", "artist x - song remaster", "a b - c d", None]


def test_parsers(spark):
    rows = [("Fine – Portal",), ("Some Artist - Some Track",), ("no separator",), ("",), (None,), ("A - B - C",)]
    got = one(spark, "t string", rows, text.dash_pair(F.col("t")))
    assert [tuple(g) if g else None for g in got] == [("Fine", "Portal"), ("Some Artist", "Some Track"), None, None, None, ("A", "B - C")]
    rows = [("Artist &#8211; “Track”",), ('Artist – "Track"',), ("A\u00a0–\u2003B",), ("“” - x",)]
    got = one(spark, "t string", rows, text.dash_pair(F.col("t")))
    assert [tuple(g) if g else None for g in got] == [("Artist", "Track"), ("Artist", "Track"), ("A", "B"), None]
    rows = [("Rock Music", "https://x/charli-xcx-rock-music/"), ("“Coconut Water”", "https://x/trim-coconut-water/"), ("“D!e”", "https://x/north-west-die/"), ("Rock", None), ("“Bleed (Jane Remover Diss)”", "https://x/young-dabo-bleed-jane-remover-diss/")]
    got = one(spark, "t string, l string", rows, text.parsed_by(F.lit("pitchfork"), F.col("t"), F.col("l")))
    assert [tuple(g) if g else None for g in got] == [("Charli Xcx", "Rock Music"), ("Trim", "Coconut Water"), None, None, ("Young Dabo", "Bleed (Jane Remover Diss)")]


def test_texts_for_comparison(spark):
    rows = [("Dvořák – Song (Acoustic Version)",), ("Ｗｉｄｅ [Official Music Video] ft. X",), ("Lyrics (Lyrics) (HD)",), (None,), ("",)]
    assert one(spark, "t string", rows, text.match_text(F.col("t"))) == ["dvorak song acoustic version", "wide feat x", "lyrics", None, ""]
    assert one(spark, "t string", [("Sigur  Rós!",), ("東京 (JP)",), (None,)], text.artist_text(F.col("t"))) == ["sigur ros", "東京 jp", None]
    assert one(spark, "t string", [("Déjà_Vu (1).mp3",)], text.skeleton(F.col("t"))) == ["dejavu1mp3"]
    assert one(spark, "a string, t string", [("A\u00a0B", "C\u2003 D"), (" ", "x"), (None, "x")], text.file_key(F.col("a"), F.col("t"))) == ["a b - c d", None, None]


def test_duration_score(spark):
    s = [0, -1, 29, 30, 59, 60, 119, 120, 240, 330, 331, 480, 500, 600, 601, 1200, None]
    want = [0.5, 0.5, 0, 0, 0, 0.8, 0.8, 1, 1, 1, 0.8, 0.8, 0.5, 0.5, 0, 0, 0.5]
    assert one(spark, "s int", [(x,) for x in s], numbers.duration_score(F.col("s"))) == want


def test_mood_sectors(spark):
    import math

    rows = [(math.cos(math.radians(d)), math.sin(math.radians(d))) for d in range(0, 360, 45)]
    assert one(spark, "v double, a double", rows, numbers.mood(F.col("v"), F.col("a"))) == list(numbers.MOODS)
    assert all(0.85 <= c <= 0.98 for c in one(spark, "v double, a double", rows, numbers.mood_confidence(F.col("v"), F.col("a"))))
    assert one(spark, "v double, a double", [(0.0, 0.0)], numbers.mood_confidence(F.col("v"), F.col("a"))) == [0.65]
    assert one(spark, "a double", [(-0.9,), (-0.5,), (0.0,), (0.5,), (0.9,), (None,)], numbers.energy_level(F.col("a"))) == ["very_low", "low", "medium", "high", "very_high", None]


def test_dates(spark):
    rows = [("1000.5",), ("1970-01-01T00:16:40Z",), ("1970-01-01T01:16:40+01:00",), ("1970-01-01 00:16:40",), ("soon",), (None,)]
    assert one(spark, "t string", rows, numbers.epoch(F.col("t"))) == [1000.5, 1000.0, 1000.0, 1000.0, 0.0, 0.0]
    assert one(spark, "h int", [(22,), (2,), (4,), (5,), (9,), (17,)], numbers.daypart(F.col("h"))) == ["Night", "Night", "Night", "Dawn", "Day", "Dusk"]


def test_ratios():
    assert fuzzy.ratio("abcd", "abcd") == 100 and fuzzy.ratio("", "") == 100 and fuzzy.ratio("ab", "cd") == 0
    assert fuzzy.ratio("lewenstein", "levenshtein") == 100 * 2 * 9 / 21
    assert fuzzy.token_sort_ratio("b a", "a b") == 100
    assert fuzzy.token_set_ratio("a b", "a b c d") == 100 and fuzzy.token_set_ratio("", "a") == 0
    assert 0 < fuzzy.token_set_ratio("red river", "red raven") < 100


def test_scores(spark):
    rows = [("x live", "x"), ("x live", "x live"), ("x karaoke", "x"), ("alive", "x")]
    assert one(spark, "f string, w string", rows, fuzzy.keyword_factor(F.col("f"), F.col("w"), ["karaoke"], {"live": 0.7})) == [0.7, 1.0, 0.0, 1.0]
    rows = [(0.9, None, 0.9, 30.0, 1.0), (0.9, 0.9, 0.9, 290.0, 1.0), (0.9, None, 0.9, None, 1.0)]
    got = one(spark, "f double, s double, c double, d double, k double", rows, fuzzy.composite(*[F.col(c) for c in "fscdk"]))
    assert got[0] == 0 and got[1] > 0.75 and got[2] > 0.5
    rows = [("X - Topic", "", "t", 0), ("X", "", "t", 0), ("Y", None, "t", 0), ("Y", "z", "T (Official Visualizer)", 0), ("Y", "z", "t", 200_000), (None, "X - Topic", "t", None)]
    trust = fuzzy.channel_trust(F.lit("x"), F.col("c"), F.col("u"), F.col("t"), F.col("n"))
    assert one(spark, "c string, u string, t string, n int", rows, trust) == [1.0, 0.9, 0.5, 0.6, 0.7, 1.0]
    rows = [("Cover Me", "cover me"), ("Song (Lo-Fi)", "song"), ("Song discover", "song"), ("Best Of X", "x"), ("My Recover", "recover live")]
    assert one(spark, "f string, w string", rows, fuzzy.keyword_factor(F.col("f"), F.col("w"))) == [1.0, 0.4, 1.0, 0.0, 1.0]


def test_small_text_functions(spark):
    assert one(spark, "t string", [("&#8220;A &amp; B&#8221; &#038; &#8211;",)], text.decoded(F.col("t"))) == ["“A & B” & –"]
    assert one(spark, "t string", [('a<b>:"c"/d|e?*  f ',)], text.safe_filename(F.col("t"))) == ["abcde f"]
    assert one(spark, "t string", [("Rock, rock ,, Jazz",)], text.csv_set(F.col("t"))) == [["rock", "jazz"]]
    assert one(spark, "s int", [(65,), (600,)], text.minutes_text(F.col("s"))) == ["1:05", "10:00"]
    assert one(spark, "t string", [("u?api_key=abc&x=1",)], text.redacted(F.col("t"))) == ["u?api_key=***&x=1"]
    assert one(spark, "v array<float>", [([3.0, 4.0],), ([0.0, 0.0],)], numbers.unit(F.col("v"))) == [[0.6, 0.8], None]
