from crateflow.llm.intake import RecordingIndex, repeated_tracks
from crateflow.llm.linkage import LabelModel, matches
from crateflow.llm.recordings import LIMIT, bag, channel_cost, distance, is_placeholder, parse
from crateflow.llm.variants import linked, same_recording_pairs

NICK = [("Nell", "Eleanor"), ("Bob", "Robert")]


def cost(a, b):
    return channel_cost(bag(a), bag(b))[0]


def test_notes_and_versions():
    assert parse("Red River (Official Audio)") == parse("Red River - 2012 Remaster") == parse("Red River") == ("Red River", ())
    assert parse("Red River, Pt. 2")[1] == parse("Red River part two")[1] == ("part 2",)
    assert parse("Red River (Live at Foxes)")[1] != parse("Red River live")[1] != ()
    assert parse("A feat. B ft C")[0] == "A" and parse("X [with Y Z]")[0] == "X"
    for v in ("(Remix)", "(cover)", "slowed + reverb", "1 hour loop", "(Demo) 38", "【Karaoke】", "piano tutorial"):
        assert parse("Red River " + v)[1], v
    assert is_placeholder("Unknown Artist", "Track 07") and is_placeholder("VA", "x") and not is_placeholder("The Vans", "Tracks")


def test_channel():
    assert distance("river", "rievr", 2) == 1 and distance("abc", "xyz", 1) == 2
    assert cost("Thomass Corpokenzab Red Rievr", "Thomas Corpolkenzab Red River") <= LIMIT
    assert cost("E. Vaskirim Slow Rumour", "Eleanor Väskirim Slow Rumour") < 2
    assert cost("FrovaFrocornor Cold Sun", "frovafrocornor cold sun") <= 2
    assert cost("Kind Clover Rinjin", "Red Clover Rinjin") > LIMIT
    assert cost("Charles Stone Old Moon", "Nicholas Stone Old Moon") > LIMIT


REQ = [
    (1, "Eleanor Väskirim", "Slow Paper Rumour", "s"), (2, "Nell Vaskirim", "slow paper rumuor", "s"), (3, "Slow Paper Rumour", "Väskirim, E.", "s"),
    (4, "Slow Paper Rumour by Eleanor Väskirim", None, "s"), (5, None, "ELEANOR VASKIRIM - SLOW PAPER RUMOUR", "s"), (6, "Eleanor Väskirim", "Slow Paper Rumour (Live)", "s"),
    (7, "Eleanor Väskirim", None, "s"), (8, None, None, None), (9, "", " ", ""), (10, "Rebecca Väskirim", "Slow Paper Rumour", "s"), (1, "Eleanor Väskirim", "Slow Paper Rumour", "s"),
]


def test_requests_of_one_recording(spark):
    df = spark.createDataFrame(REQ, "request_id bigint, artist string, title string, form string")
    nick = spark.createDataFrame(NICK, "short_form string, full_form string")
    got = {(r.a, r.b) for r in same_recording_pairs(df, nick).collect()}
    same = [1, 2, 3, 4, 5]
    assert got == {(a, b) for a in same for b in same if a < b}
    assert linked(df, nick).select("id").distinct().count() == 7
    assert same_recording_pairs(df.limit(0), nick.limit(0)).count() == 0


def test_clips_and_tracks(spark):
    words = "amber birch cedar dusk ember fjord grove harbour island jacket kettle lantern".split()
    tracks = [(f"k{i}", f"{a.title()} Stone", f"{b.title()} Window {c.title()}", 200 + i) for i, (a, b, c) in enumerate((a, b, c) for a in words for b in words[:3] for c in words[5:7])]
    clips = [(i, f"{t[1]} - {t[2]} (Official Video)", "songs4u1", "songs4u1", t[3] + 1.0) for i, t in enumerate(tracks)]
    clips += [(1000, "Amber Stone - Amber Window Ford", "x1", "x1", 201.0), (1001, tracks[0][2], "Amber Stone - Topic", "z", 0.0), (1002, f"{tracks[0][1]} - {tracks[0][2]} (Live)", "x", "x", 200.0)]
    clips += [(1003, f"{tracks[0][1]} - {tracks[0][2]}", "x", "x", 5000.0), (1004, None, None, None, None), (1005, "Nobody - Nothing At All", "x", "x", 200.0), (0, clips[0][1], "songs4u1", "songs4u1", clips[0][4])]
    c = spark.createDataFrame(clips, "result_id bigint, title string, uploader string, channel string, duration double")
    t = spark.createDataFrame([*tracks, tracks[0], ("n", None, "x", 1)], "track_key string, artist string, title string, duration int")
    nick = spark.createDataFrame(NICK, "short_form string, full_form string")
    got = {r.clip: r.track_key for r in matches(c, t, nick).collect()}
    assert got == {i: f"k{i}" for i in range(len(tracks))} | {1001: "k0"} | ({1000: "k0"} if 1000 in got else {})
    assert matches(c.limit(0), t, nick).count() == matches(c, t.limit(0), nick).count() == 0


def test_label_model_learns_accuracies():
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.5
    good = np.where(rng.random(4000) < 0.9, y, ~y)
    poor = np.where(rng.random(4000) < 0.6, y, ~y)
    x = np.stack([1 - good, 1 - poor, 1 - np.where(rng.random(4000) < 0.85, y, ~y)], 1).astype(int)
    p, n = np.unique(x, axis=0, return_counts=True)
    m = LabelModel({"a": 2, "b": 2, "c": 2}, {k: ([0.4, 0.6], [0.6, 0.4]) for k in "abc"}).fit(p, n.astype(float))
    assert ((m.posterior(x) > 0.5) == y).mean() > 0.85


TRACKS = [
    (1, "Thomas Corpolken", "Red River", 0), (2, "Unknown Artist", "Track 07", 0), (3, "Eleanor Vask", "Amber Moon", 0), (4, "Thommas Corpolken", "Red River (Deluxe Edition)", 1), (5, "Unknown Artist", "Track 07", 1),
    (6, "VA", "untitled", 1), (7, "Corpolken, Thomas", "RED RIVER!", 2), (8, "Eleanor Vask", "Amber Moon (Live)", 2), (9, "New One", "First Song", 3), (10, "New One", "Frist Song", 3), (11, None, None, 4), (12, "", "", 4), (13, "Eleanor Vask", "Silver Moon", 4),
]
HASHES = [(2, "AAAA1"), (6, "aaaa1"), (9, "da39a3ee5e6b4b0d3255"), (11, "da39a3ee5e6b4b0d3255"), (3, "bbbb"), (12, "BBBB"), (12, "BBBB"), (4, None), (5, "")]


def test_batches_against_history(spark):
    t = spark.createDataFrame(TRACKS + [TRACKS[3]], "track_id bigint, artist string, title string, batch_no int")
    f = spark.createDataFrame(HASHES, "track_id bigint, fingerprint_hash string")
    got = {(r.a, r.b) for r in repeated_tracks(t, f).collect()}
    assert got == {(1, 4), (1, 7), (2, 6), (9, 10), (3, 12)}
    assert repeated_tracks(t.limit(0), f).count() == repeated_tracks(t.limit(0), f.limit(0)).count() == 0


def test_a_batch_leaves_the_stored_history_alone(spark, tmp_path):
    index = RecordingIndex(spark, str(tmp_path / "ix"))
    schema = "track_id bigint, ord bigint, artist string, title string, hash string"
    index.add(spark.createDataFrame([(1, 1, "Ann Bell", "Cold Rain", "h1")], schema))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "ix").rglob("*.parquet")}
    got = index.add(spark.createDataFrame([(2, 2, "Ann Bel", "Cold Rain", None), (3, 3, "Other", "Name", "h1"), (4, 4, "Other", "Nam", "h9")], schema)).collect()
    assert {r.track_id: r.rec for r in got} == {2: 1, 3: 1, 4: 1}
    assert all(p.stat().st_mtime_ns == m for p, m in before.items())
    index.add(spark.createDataFrame([], schema))
    assert index.rows().count() == 4


def test_artists_of_like_letters_are_told_apart_by_words():
    from crateflow.llm.intake import _near_artists, _same_artists, letters

    import pyarrow as pa

    def entries(names):
        return pa.table({"cell": pa.array(range(len(names)), pa.int64()), "avec": [letters(n.split()).tobytes() for n in names], "names": names, "known": [True] * len(names)})

    one = ["eleanor vaskirim"]
    same = ["eleanor vaskirm", "elaenor vaskirim", "eleanorvaskirim", "e vaskirim", "of eleanor vaskirim", "ann eleanor vaskirim", "eleanor vaskirin", "vaskirim"]
    other = ["elenora vaskrimi", "eleanor virvaski", "arnolee vaskirim", "roelane kirivasm"]
    pairs = lambda f: set(f(entries(one), entries(same + other)).column("cell").to_pylist())
    near, kept = pairs(_near_artists), pairs(_same_artists)
    assert kept < near and kept & set(range(len(same))) == near & set(range(len(same)))
    assert not kept & {len(same) + 1, len(same) + 2, len(same) + 3}
    # short names in each other's field, and names whose spaces are elsewhere
    assert _same_artists(entries(["u2"]), entries(["one"])).num_rows == 1
    assert _same_artists(entries(["red foxes night"]), entries(["redfoxes night"])).num_rows == 1
