"""Pairs that the channel model accepts have to become candidates."""

import random
import tracemalloc

import pyarrow as pa

from crateflow.llm import intake
from crateflow.llm.intake import COST, REACH, RecordingIndex, _cost, _near_artists, letters, repeated_tracks
from crateflow.llm.linkage import _near_forms
from crateflow.llm.recordings import LIMIT, channel_cost, words
from crateflow.session import scratch_path
from tests.llm.test_blocking import sides


def bagged(text):
    return " ".join(sorted(text.split()))


def test_words_run_together_or_changed_meet_their_track(spark):
    pairs = [
        ("greentower sings tomorrow", "green tower sings tomorrow"), ("greentower sings", "green tower sings"), ("amberbirchcedar dusk fjord", "amber birch cedar dusk fjord"),
        ("kettel lanternn medow harbour island", "kettle lantern meadow harbour island"), ("rcket jaket orchard pebble", "rocket jacket orchard pebble"), ("gsland quartz violin zephyr", "island quartz violin zephyr"),
    ]
    pairs = [(bagged(a), bagged(b)) for a, b in pairs]
    assert all(channel_cost(a.split(), b.split())[0] <= LIMIT for a, b in pairs)
    forms = sides(spark, [a for a, _ in pairs], [b for _, b in pairs])
    name = {r.f: r.form for r in forms.collect()}
    assert set(pairs) <= {(name[r.f], name[r.g]) for r in _near_forms(forms).collect()}


def _entries(names):
    return pa.table({"cell": pa.array(range(len(names)), pa.int64()), "avec": pa.array([letters(n.split()).tobytes() for n in names], pa.binary()), "known": pa.array([True] * len(names))})


def test_near_artists_do_not_depend_on_the_number_of_artists():
    # 6,000 artists of one letter total, which fill several chunks, and one whose total is 3 larger
    rnd = random.Random(1)
    many = ["".join(rnd.choices("bcdfghjklmnp", k=12)) + " foxes" for _ in range(6000)]
    names = ["corpolken wolves of", "corpolken wolves ofrst", *many]
    for keep in (2, len(names)):
        got = _near_artists(_entries(names[:keep]), _entries(names[:keep]))
        assert (0, 1) in set(zip(got["artist"].to_pylist(), got["cell"].to_pylist()))


def test_a_batch_probes_sums_and_totals_within_reach(spark, monkeypatch):
    seen = []
    homes = RecordingIndex._homes
    monkeypatch.setattr(RecordingIndex, "_homes", staticmethod(lambda df, hot, reach: seen.append(reach) or homes(df, hot, reach)))
    index = RecordingIndex(spark, scratch_path(spark, "sums"))
    index.add(spark.createDataFrame([(1, 1, "Corpolken Wolves", "Red Moon", None)], INTAKE))
    assert seen == [0, REACH]


INTAKE = "track_id long, ord long, artist string, title string, hash string"


def test_an_index_is_opened_again_and_reads_probed_parts_only(spark):
    path = scratch_path(spark, "again")
    rnd = random.Random(2)
    name = lambda: "".join(rnd.choices("abcdefghiklmnoprstuvw", k=12)).title()
    rows = [(i, i, f"{name()} {name()}", f"{name()} {name()}", f"h{i}") for i in range(1, 60)]
    artist, title = rows[10][2:4]
    RecordingIndex(spark, path).add(spark.createDataFrame(rows, INTAKE))
    again = RecordingIndex(spark, path)
    assert again.batches == 1 and again.rows().count() == 59
    got = again.add(spark.createDataFrame([(100, 100, artist, title + "x", None), (101, 101, "New Name", "First Words", "h7")], INTAKE)).collect()
    assert {r.track_id: r.rec for r in got} == {100: 11, 101: 7}
    # a batch that probes one cell reads its part of the rows alone, whatever else is held
    seen = []
    read = RecordingIndex._read
    other = RecordingIndex(spark, path)
    other._read = lambda name, schema: seen.append(name) or read(other, name, schema)
    other.add(spark.createDataFrame([(200, 200, artist, title, None)], INTAKE))
    held = spark.read.parquet(f"{path}/rows")
    part = held.where("track_id = 11").select("part").first()[0]
    assert "rows" in seen and held.where(f"part = {part}").count() < held.count() / 4
    assert RecordingIndex(spark, path).rows().where("track_id = 200").first().rec == 11


def test_a_long_chain_inside_one_batch_leads_to_its_start(spark):
    rows = [(i, i, f"Name {i}", f"Word {i}", None) for i in range(1)] + [(i, i, None, None, None) for i in range(1, 70)]
    df = spark.createDataFrame(rows, INTAKE).select("track_id", "ord")
    links = spark.createDataFrame([(i, i - 1, None, None) for i in range(1, 70)], "track_id long, hit long, rec long, rec_ord long")
    got = {r.track_id: r.rec for r in RecordingIndex._resolved(df, links).collect()}
    assert got == {i: 0 for i in range(70)}


def test_two_edits_find_the_earlier_track(spark):
    said = [
        (("The Drofrozabpol Foxes", "Red Meadow Song"), ("Thhe Drofrozabpol Foxes", "Red Meadow Song")), (("Tammirquojin and Wolves", "Amber Song"), ("Tammirquojin annd Wolves", "Amber Song")),
        (("Corpolken Barrabin", "Silver Moon"), ("Cotpolken Batrabin", "Silver Moon")), (("Kettlering Harbour", "Slow Fjord"), ("Tettlering Hatbour", "Slow Fjord")), (("Phillipson Gardener", "Dusk Hymn"), ("Fillipson Gatdener", "Dusk Hymn")),
        (("Quibblestone Lost", "Grey Paper"), ("Quibblestone Loast", "Grey Paper")), (("Tge Vandermolen Lost", "Birch Paper"), ("Vandermolen Loast", "Birch Paper")), (("Jostlebury Trio", "Last Lantern"), ("Jostlebury Trio", "Laast Lanetrn")),
    ]
    assert all(_cost(*(" ".join(sorted(set(words(a)) - {"the", "and"} | set(words(t)) | ({"&"} if "and" in words(a) else set()))) for a, t in p))[0] <= COST for p in said)
    rows = [(10 * i + k, a, t, k) for i, p in enumerate(said) for k, (a, t) in enumerate(p)]
    rows += [(900, "Quibblestone Band", "Night Paper", 0), (901, "Quibblestone", "Night Paper", 1)]
    tracks = spark.createDataFrame(rows, "track_id long, artist string, title string, batch_no int")
    got = repeated_tracks(tracks, spark.createDataFrame([], "track_id long, fingerprint_hash string")).collect()
    assert sorted((r.a, r.b) for r in got) == [(10 * i, 10 * i + 1) for i in range(len(said))]


def test_a_block_of_artists_takes_little_memory():
    # 1,024 artists asked for of 40,000 held: whole matrices took more than 700 MB
    rnd = random.Random(4)
    held = _entries(["".join(rnd.choices("bcdfghjklmnp", k=12)) + " foxes" for _ in range(40_000)])
    tracemalloc.start()
    got = _near_artists(held.slice(0, 1024), held)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(range(1024)) <= {a for a, c in zip(got["artist"].to_pylist(), got["cell"].to_pylist()) if a == c}
    assert most < 150e6


def test_blocks_and_shares_lose_no_match(spark, monkeypatch):
    """The first batch of an index is cut into blocks too, and so are the rows that probe one cell."""
    rnd = random.Random(6)
    name = lambda n: "".join(rnd.choices("abcdefghiklmnoprstuvw", k=n)).title()
    rows = [(i, i, f"{name(7)} {name(6)}", f"{name(8)} {name(5)}", None) for i in range(1, 150)]
    rows += [(200 + i, 200 + i, "Corpolken Wolves", f"{name(6)} Moon", None) for i in range(150)]
    rows += [(1000 + i, 1000 + i, a[:-2] + a[-1], t + "s", None) for i, _, a, t, _ in rows]
    found, groups = [], []
    probe = RecordingIndex._splits
    monkeypatch.setattr(RecordingIndex, "_splits", staticmethod(lambda *x: groups.append(probe(*x)) or groups[-1]))
    for sizes in ({}, {"BLOCK_ROWS": 9, "ASK_ROWS": 13, "BUCKET_ROWS": 40, "CELL_ROWS": 30}):
        for k, v in sizes.items():
            monkeypatch.setattr(intake, k, v)
        got = RecordingIndex(spark, scratch_path(spark, "blocks")).add(spark.createDataFrame(rows, INTAKE)).collect()
        found.append(sorted(map(tuple, got)))
    assert found[0] == found[1] and sum(a != b for a, b in found[0]) > 250
    assert groups[1][1] > groups[0][1] and groups[1][0].where("shares > 1").count()
