"""Problem 2: requests typed by people, linked if they mean the same recording.

Method: noisy-channel attribution. Every distinct writing (a bag of words and a version) is ranked by how often it was
typed; the frequent ones are the candidate canonical forms, and so is the writing itself. A writing's candidates share
blocking keys with it. The channel model gives the likelihood of typing the candidate as the writing (typos, initials, short
forms, words run together), once more for repetitions; with the frequency as prior each writing is attached to its candidate of
maximum posterior, or stays a name of its own, and attachments are followed to their end. A supposed typo that turns one
common word into another is no typo.

Defined cases: null, empty or blank artist and title name no recording, nor does one field alone unless it holds both;
identical requests are linked; a repeated request_id counts once; ties of the posterior go to the smaller form; texts of any
length are parsed whole; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.blocking import BLOCK, LEFT, RIGHT, near_bags
from crateflow.llm.recordings import bag, full_forms, parse
from crateflow.session import written

#: Cost of being a name of its own that happens to be near another one, more than any single writing may cost; how far repetitions of a
#: writing count as typed anew, as people also send a request twice.
OWN, REPEAT = 9.0, 0.15
#: A word seen in this many writings is a word of its own, unless the other one is this many times as frequent.
KNOWN, RATIO = 6, 10
_BOTH = re.compile(r"\s[-–—|~·/]+\s|:\s|\sby\b:?\s|\"\S", re.I)
_BY = re.compile(r"\sby\b:?\s", re.I)


def read_request(artist: str | None, title: str | None, nicknames: dict[str, str]) -> tuple[str, str] | None:
    """(bag of words, version) of a request, or None if it names no recording."""
    a, t = (artist or "").strip(), (title or "").strip()
    if not a and not t:
        return None
    if not a or not t:
        one = a or t
        if not _BOTH.search(one):
            return None
        body, marks = parse(one)
        body = _BY.sub(" ", body)
    else:
        (x, m1), (y, m2) = parse(a), parse(t)
        if not x or not y:
            return None
        body, marks = x + " | " + y, tuple(sorted({*m1, *m2}))
    tokens = bag(body, nicknames=nicknames)
    return (" ".join(tokens), "; ".join(marks)) if len(tokens) > 1 else None


def writings(requests: DataFrame, nickname: DataFrame, key: str, artist: str, title: str) -> DataFrame:
    """(id, form, version) of every request that names a recording. ``nickname`` is a fixed small table."""
    nicks = full_forms(nickname.select("short_form", "full_form").collect())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            got = [read_request(a, t, nicks) for a, t in zip(r.column(1).to_pylist(), r.column(2).to_pylist(), strict=True)]
            ok = [i for i, g in enumerate(got) if g]
            yield pa.RecordBatch.from_arrays([r.column(0).take(pa.array(ok, pa.int64())), pa.array([got[i][0] for i in ok], pa.string()), pa.array([got[i][1] for i in ok], pa.string())], ["id", "form", "version"])

    rows = requests.select(F.col(key).cast("long").alias("id"), F.col(artist).cast("string").alias("a"), F.col(title).cast("string").alias("t")).where("id IS NOT NULL")
    return rows.mapInArrow(read, "id bigint, form string, version string")


def weighed_pairs(forms: DataFrame, block: int = BLOCK) -> DataFrame:
    """(f, g, cost) of forms that may be writings of one recording; a typo between two common words rules a pair out."""
    near = written(near_bags(forms.withColumn("role", F.lit(LEFT + RIGHT)), True, block), "variant-pairs")
    count = forms.select(F.explode(F.split("form", " ")).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= KNOWN)
    typed = near.select("f", "g", F.explode("typos").alias("t")).select("f", "g", "t.x", "t.y")
    nx, ny = count.select(F.col("w").alias("x"), F.col("n").alias("nx")), count.select(F.col("w").alias("y"), F.col("n").alias("ny"))
    real = typed.join(nx, "x").join(ny, "y").where(F.greatest("nx", "ny") < RATIO * F.least("nx", "ny")).select("f", "g").distinct()
    return near.select("f", "g", "cost").join(real, ["f", "g"], "left_anti")


def attach(forms: DataFrame, near: DataFrame) -> DataFrame:
    """(f, root): every form with the end of its chain of attachments.

    Each form points to its candidate of maximum posterior. Where two point to each other, the one more often typed, or else
    the smaller, points nowhere; as the posterior grows along chains there are no longer circles. Each round doubles the
    length that is followed; the loop ends when nothing moves.
    """
    n = forms.select("f", "n")
    ends = near.join(n, "f").join(n.select(F.col("f").alias("g"), F.col("n").alias("m")), "g").select("f", "g", "n", "m", "cost")
    # the form itself is a candidate: typed so often, is it rather a name of its own?
    arcs = ends.select(F.col("f").alias("child"), F.col("g").alias("parent"), F.col("n").alias("mine"), F.col("m").alias("theirs"), "cost").unionByName(ends.select(F.col("g").alias("child"), F.col("f").alias("parent"), F.col("m").alias("mine"), F.col("n").alias("theirs"), "cost"))
    typed = F.log("theirs") - F.col("cost") * (1 + REPEAT * F.log("mine"))
    arcs = arcs.where(typed >= F.log("mine") - OWN)
    leads = (F.col("mine") > F.col("theirs")) | ((F.col("mine") == F.col("theirs")) & (F.col("child") < F.col("parent")))
    pick = F.max_by(F.struct("parent", leads.alias("leads")), F.struct(F.round(F.log("theirs") - F.col("cost"), 9), F.col("theirs"), -F.col("parent")))
    best = written(arcs.groupBy("child").agg(pick.alias("p")).select("child", "p.parent", "p.leads"), "variant-links")
    back = best.select(F.col("child").alias("parent"), F.col("parent").alias("back"))
    links = written(best.join(back, "parent", "left").where("NOT (coalesce(back = child, false) AND leads)").select("child", "parent"), "variant-links")
    while True:
        over = links.select(F.col("child").alias("parent"), F.col("parent").alias("next"))
        step = written(links.join(over, "parent", "left").select("child", F.coalesce("next", "parent").alias("parent"), F.col("next").isNotNull().alias("moved")), "variant-links")
        links = step.select("child", "parent")
        if step.where("moved").limit(1).count() == 0:
            break
    return forms.join(links.select(F.col("child").alias("f"), "parent"), "f", "left").select("f", F.coalesce("parent", "f").alias("root"))


def linked(requests: DataFrame, nickname: DataFrame, key: str = "request_id", artist: str = "artist", title: str = "title") -> DataFrame:
    """(id, form, version, root): requests with equal root mean the same recording."""
    rows = written(writings(requests, nickname, key, artist, title), "variant-rows")
    forms = written(rows.groupBy("form", "version").agg(F.count("*").alias("n")).select(F.xxhash64("form", "version").alias("f"), "form", "version", "n"), "variant-forms")
    near = weighed_pairs(forms)
    roots = attach(forms, near)
    return rows.withColumn("f", F.xxhash64("form", "version")).join(roots, "f").select("id", "form", "version", "root")


def same_recording_pairs(requests: DataFrame, nickname: DataFrame) -> DataFrame:
    """Every pair (a, b), a < b, of requests that mean the same recording; the pairs are the asked result."""
    rows = linked(requests, nickname).select("id", "root").distinct()
    return rows.select(F.col("id").alias("a"), "root").join(rows.select(F.col("id").alias("b"), "root"), "root").where("a < b").select("a", "b").distinct()
