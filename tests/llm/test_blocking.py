"""Every two bags that the channel accepts and that share what level 1 asks for have to meet, however crowded their keys are."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from crateflow.llm import blocking
from crateflow.llm.blocking import LEFT, RIGHT, near_bags
from crateflow.llm.linkage import _near_forms
from crateflow.llm.recordings import LIMIT, channel_cost
from crateflow.llm.variants import attach, weighed_pairs

WORDS = "amber birch cedar dusk fjord grove harbour island jacket kettle lantern meadow".split()
LIB = [" ".join(sorted(["ann", "bell", a, b])) for a in WORDS for b in WORDS if a < b]


def frame(spark, forms, role=LEFT + RIGHT):
    rows = spark.createDataFrame([(f, "") for f in forms], "form string, version string")
    return rows.withColumn("f", F.xxhash64("form", "version")).select("f", "form", "version", F.lit(role).alias("role"))


def sides(spark, mine, theirs):
    return frame(spark, mine, LEFT).union(frame(spark, theirs, RIGHT)).groupBy("f").agg(F.min("form").alias("form"), F.min("version").alias("version"), F.bit_or("role").alias("role"))


def typed(rnd, form):
    """A writing of a form: typos, initials, short forms, words run together."""
    ws = form.split()
    for _ in range(rnd.choice((1, 1, 2, 3))):
        i = rnd.randrange(len(ws))
        w = ws[i]
        kind = rnd.random()
        at = rnd.randrange(len(w))
        if kind < 0.55:
            w = rnd.choice((w[:at] + w[at + 1 :], w[:at] + rnd.choice("abcxyz") + w[at:], w[:at] + rnd.choice("abcxyz") + w[at + 1 :]))
        elif kind < 0.7:
            w = w[0]
        elif kind < 0.85:
            w = w[: max(3, len(w) - 3)]
        elif len(ws) > 3:
            w += ws.pop((i + 1) % len(ws))
            i = min(i, len(ws) - 1)
        if w:
            ws[i] = w
    return " ".join(sorted(set(ws)))


def held_by_level_one(a, b):
    x, y = set(a.split()), set(b.split())
    return len([w for w in x & y if len(w) > 1]) >= 2


def test_no_pair_is_lost_whatever_the_block(spark):
    rnd = random.Random(5)
    lib = LIB + ["ann bell dusk", "ann bell", "cedar of the dusk", " ".join(sorted(WORDS + ["ann", "bell"]))]
    mine = sorted({typed(rnd, f) for f in lib for _ in range(6)})
    want = {(a, b) for a, b in product(mine, lib) if a != b and held_by_level_one(a, b) and channel_cost(a.split(), b.split())[0] <= LIMIT}
    forms = sides(spark, mine, lib)
    name = {r.f: r.form for r in forms.collect()}
    assert len(want) > 250
    for block in (1, 4, 100_000):
        got = {(name[r.f], name[r.g]) for r in near_bags(forms, False, block).collect()}
        # the stated exception: words run together and misspelt besides, under a crowded key
        both = {p for p in want if block < 100 and len(p[0].split()) < len(p[1].split()) and sorted(p[0]) != sorted(p[1].replace(" ", "") + " " * p[0].count(" "))}
        assert not want - got - both and len(both - got) < 20
        assert all(a != b for a, b in got)


def test_library_side(spark):
    typos = [f.replace("a", "aa", 1) if i % 2 else f[:-1] + "x" for i, f in enumerate(LIB)]
    typos = [" ".join(sorted(t.split())) for t in typos]
    forms = sides(spark, typos, LIB)
    name = {r.f: r.form for r in forms.collect()}
    for block in (2, 10_000):
        assert set(zip(typos, LIB)) <= {(name[r.f], name[r.g]) for r in _near_forms(forms, block).collect()}
    assert _near_forms(forms.limit(0)).count() == 0 == _near_forms(frame(spark, LIB, LEFT)).count()


def test_long_bags_meet_by_their_words_of_smallest_hash(spark):
    rnd = random.Random(3)
    many = ["".join(rnd.choices("bcdfghklmnprst", k=8)) for _ in range(60)]
    a = sorted(many[:40])
    b = sorted(many[5:40] + many[50:55])  # five words differ
    forms = sides(spark, [" ".join(a)], [" ".join(b)])
    assert near_bags(forms, False).count() in (0, 1)
    b = sorted(many[1:40] + [many[0][:-1] + "x"])
    assert near_bags(sides(spark, [" ".join(a)], [" ".join(b)]), False).count() == 1


def test_variants_side(spark):
    forms = LIB + [f.replace("bell", "bel") for f in LIB[::20]]
    df = frame(spark, forms).withColumn("n", F.when(F.col("form").contains("bell"), 5).otherwise(1))
    name = {r.f: r.form for r in df.collect()}
    want = {tuple(sorted((f, f.replace("bell", "bel")))) for f in LIB[::20]}
    for block in (2, 10_000):
        assert want <= {tuple(sorted((name[r.f], name[r.g]))) for r in weighed_pairs(df, block).collect()}
    roots = {name[r.f]: name[r.root] for r in attach(df, weighed_pairs(df)).collect()}
    assert all(roots[f.replace("bell", "bel")] == f for f in LIB[::20])


def test_words_run_together():
    assert channel_cost("daftpunkaroundtheworld".split(), "around daft punk the world".split())[0] <= LIMIT
    assert channel_cost(["abc"], ["bca"])[0] > LIMIT


def test_swapped_first_letters_meet_whatever_the_end(spark):
    pairs = [("lumulaula ohlida second trio uladal", "holiday lumulaula second trio uladal"), ("fables lantern northern ocrfrorsklu", "corfroesklum fables lantern northern")]
    assert all(channel_cost(a.split(), b.split())[0] <= LIMIT for a, b in pairs)
    forms = sides(spark, [a for a, _ in pairs], [b for _, b in pairs])
    name = {r.f: r.form for r in forms.collect()}
    assert {(name[r.f], name[r.g]) for r in near_bags(forms, False).collect()} == set(pairs)


def test_many_pairs_are_weighed_at_once_as_one_by_one(monkeypatch):
    rnd = random.Random(7)
    lib = LIB[:40] + ["of the sapphire phone", "ann bell without a trio", "7 bell 77 moon", "ann b bell cedar harbour", "x" * 30 + " ann bell", "ann bell " + " ".join(WORDS[:7])]
    bags = sorted({typed(rnd, f) for f in lib for _ in range(5)} | {f + "*" for f in lib[:20]} | set(lib))
    pairs = np.array([x << 32 | y for x in range(len(bags)) for y in range(x)])
    want = {(int(p >> 32), int(p & 0xFFFFFFFF)): channel_cost(bags[p >> 32].split(" "), bags[p & 0xFFFFFFFF].split(" ")) for p in pairs}
    asked = []
    monkeypatch.setattr(blocking, "channel_cost", lambda a, b: asked.append(1) or channel_cost(a, b))
    got = blocking._weighed(blocking._Words(pa.array(bags)), pairs, bags)
    assert got == {k: v for k, v in want.items() if v[0] <= LIMIT} and len(got) > 500
    assert len(asked) < len(pairs) / 4


def test_rows_of_a_bucket_travel_in_one_piece():
    bags = pa.array(["ann bell", "", "été à deux", "ann bell"])
    batch = blocking._spread(np.array([7, 7, 9, 8]), bags, np.arange(4, dtype=np.uint64), np.array([1, 2, 3, 1]), 2, 512)
    assert batch.column(0).to_pylist() == [0, 1]
    rows = blocking._unpacked(pa.chunked_array([batch.column(1)]))
    assert sorted(zip(*rows.to_pydict().values())) == [(7, "", 2), (7, "ann bell", 1), (8, "ann bell", 1), (9, "été à deux", 3)]
