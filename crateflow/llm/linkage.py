"""Problem 4: clips and tracks matched without a common key, each match with a confidence.

Method: label-model linkage. Candidates are found by bags of words (equal ones, and those that blocking keys and the
channel model bring together) and by titles that stand alone. Heuristic matching functions vote on each candidate: wording,
duration, uploader, shared words, rivals, the place of the artist. A generative model of the votes with a hidden class learns by expectation maximisation how accurate each
function is and along which tree the functions depend on each other; its posterior is the confidence. Votes have few values,
so the model needs only the counts of vote patterns: their number is bounded by the product of the value counts, whatever
the size of the data.

Defined cases: a clip without title, or a track without artist or title, has no match; null, zero and negative durations
abstain; clips found again are matched each time; rows written twice count once; among a clip's candidates the most
confident wins, then the likeliest wording, the nearest duration and the smaller key; texts of any length are parsed whole;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crateflow.llm.blocking import BLOCK, LEFT, RIGHT, near_bags
from crateflow.llm.recordings import ARTICLES, full_forms, parse, words
from crateflow.session import plain_unions, written

#: Seconds of a band of durations, more than the largest gap that speaks for a match.
BAND = 16
#: Votes: name -> number of values. Value tables below are the prior pseudo-counts (share given no match, given match).
VOTES = {"wording": 5, "duration": 5, "uploader": 3, "shared": 3, "rivals": 2, "placed": 2}
PRIOR = {
    "wording": ([0.08, 0.15, 0.22, 0.25, 0.30], [0.65, 0.15, 0.10, 0.05, 0.05]),
    "duration": ([0.12, 0.08, 0.10, 0.10, 0.60], [0.70, 0.12, 0.08, 0.0995, 0.0005]),
    "uploader": ([0.15, 0.60, 0.25], [0.38, 0.60, 0.02]),
    "shared": ([0.50, 0.30, 0.20], [0.15, 0.35, 0.50]),
    "rivals": ([0.40, 0.60], [0.90, 0.10]),
    "placed": ([0.80, 0.20], [0.80, 0.20]),
}
PSEUDO = 40.0
#: Weight of a prior as a share of all candidates, where a vote is known to be near certain.
FIRM = {"duration": 0.5}
CONFIDENT = 0.5

_LABEL = re.compile(r"^\s*\[[^\]]*\]\s*")
_SPLIT = re.compile(r"\s[-–—|~·:]+\s|\S:\s|\s//\s|\sby\b:?\s|\S\s+[\"“]\S", re.I)
_BY = re.compile(r"\sby\b:?\s", re.I)
_DIGIT = re.compile(r"\d")
_HOSTS = ("topic", "official", "channel", "tv", "music", "vevo")
_HOST = re.compile(r"\s*(?:-\s*topic|official|channel|tv|music|vevo)\s*$", re.I)


@lru_cache(maxsize=1 << 15)
def _host(h: str) -> tuple[str, bool]:
    """Name of an uploader without its channel suffix, and whether it had one."""
    if h.isascii() and not h.rstrip().lower().endswith(_HOSTS):
        return h.strip(), False
    name, n = _HOST.subn("", h)
    return name.strip(), n > 0


def read_clip(title: str | None, uploader: str | None, channel: str | None, nicks: dict[str, str]) -> tuple[list[str], str, str, bool, str]:
    """(possible bags, version, uploader's letters, is the uploader an artist's own channel, bag of a title that stands alone)."""
    if not title:
        return [], "", "", False, ""
    body, marks = parse(_LABEL.sub("", title) if title.lstrip()[:1] == "[" else title)
    if not body:
        return [], "", "", False, ""
    tokens = words(_BY.sub(" ", body + " ") if "by" in body or "BY" in body or "By" in body else body, nicks)
    if body.endswith(("…", "...")) and tokens:
        tokens[-1] += "*"
    body_words = set(tokens) - ARTICLES
    name, own = _host(uploader) if uploader else ("", False)
    other = _host(channel)[0] if channel else ""
    alone = ""
    bags = [" ".join(sorted(body_words))]
    if " - " not in body and " | " not in body and not _SPLIT.search(body):  # only a title: the artist is who uploaded it
        alone = bags[0]
        hosts = [h for h in dict.fromkeys((name,) if own else (name, other)) if h]
        hosts = [h for h in hosts if not _DIGIT.search(h)] or hosts[:1]
        bags = [" ".join(sorted(body_words | (set(words(h, nicks)) - ARTICLES))) for h in hosts] or bags
    letters = "".join(words(name or other, nicks)) if name or other else ""
    return list(dict.fromkeys(bags)), "; ".join(marks), letters, own, alone


def _clip_rows(batches: Iterator[pa.RecordBatch], nicks: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for r in batches:
        got = [read_clip(*x, nicks) for x in zip(r.column(1).to_pylist(), r.column(2).to_pylist(), r.column(3).to_pylist(), strict=True)]
        at = [i for i, g in enumerate(got) for _ in g[0]]
        flat = [(b, *g[1:]) for g in got for b in g[0]]
        cols = list(zip(*flat, strict=True)) if flat else [[], [], [], [], []]
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([r.column(0).take(take), r.column(4).take(take), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.string())], ["clip", "seconds", "form", "version", "host", "own", "alone"])


def _track_rows(batches: Iterator[pa.RecordBatch], nicks: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for r in batches:
        forms, versions, names, titles = [], [], [], []
        for a, t in zip(r.column(1).to_pylist(), r.column(2).to_pylist(), strict=True):
            (x, m1), (y, m2) = parse(a), parse(t)
            name, title = words(x, nicks), words(y, nicks)
            forms.append(" ".join(sorted({*name, *title} - ARTICLES)))
            titles.append(" ".join(sorted(set(title) - ARTICLES)))
            versions.append("; ".join(sorted({*m1, *m2})) if m1 or m2 else "")
            names.append("".join(name))
        yield pa.RecordBatch.from_arrays([r.column(0), r.column(3), r.column(4), pa.array(forms, pa.string()), pa.array(versions, pa.string()), pa.array(names, pa.string()), pa.array(titles, pa.string())], ["track_key", "short", "long", "form", "version", "name", "alone"])


def _near_forms(forms: DataFrame, block: int = BLOCK) -> DataFrame:
    """(f, g, cost): clip forms with library forms within the channel limit, equal ones included; ``forms`` has f, form, version and role."""
    same = forms.where(F.col("role") == LEFT + RIGHT).select("f", F.col("f").alias("g"), F.lit(0.0).alias("cost"))
    return near_bags(forms, False, block, typed=False).unionByName(same)


def candidates(clips: DataFrame, tracks: DataFrame, nickname: DataFrame, block: int = BLOCK) -> DataFrame:
    """(clip, track_key, cost, words, uploader, placed, gap): possible matches; gap is the difference in seconds or null.

    The cost is null where only the title stands in the clip. ``nickname`` is a fixed small table. Titles alone meet tracks of
    about their duration only, if the clip has one, so a common title doesn't meet all its tracks.
    """
    plain_unions(clips.sparkSession)
    nicks = full_forms(nickname.select("short_form", "full_form").collect())
    seconds = F.when(F.col("duration") > 0, F.col("duration").cast("double"))
    lib = tracks.select("track_key", "artist", "title", seconds.alias("s")).where("track_key IS NOT NULL AND trim(artist) <> '' AND trim(title) <> ''").groupBy("track_key", "artist", "title").agg(F.min("s").alias("short"), F.max("s").alias("long"))
    lib = lib.mapInArrow(partial(_track_rows, nicks=nicks), "track_key string, short double, long double, form string, version string, name string, alone string").where("instr(form, ' ') > 0")
    lib = written(lib.withColumn("g", F.xxhash64("form", "version")), "linkage-tracks")
    mine = clips.select(F.col("result_id").alias("clip"), "title", "uploader", "channel", seconds.alias("seconds"))
    mine = mine.mapInArrow(partial(_clip_rows, nicks=nicks), "clip bigint, seconds double, form string, version string, host string, own boolean, alone string")
    mine = written(mine.withColumn("f", F.xxhash64("form", "version")), "linkage-clips")
    sides = mine.where("instr(form, ' ') > 0").select("f", "form", "version", F.lit(LEFT).alias("role")).unionByName(lib.select(F.col("g").alias("f"), "form", "version", F.lit(RIGHT).alias("role")))
    forms = written(sides.groupBy("f", "form", "version").agg(F.bit_or("role").alias("role")), "linkage-forms")
    carried, side = ["clip", "seconds", "host", "own", "alone"], ["track_key", "short", "long", "name"]
    # votes on the uploader and the duration are cast as soon as clip and track meet, so no text is carried on
    names = F.col("host").contains(F.col("name")) | ((F.length("host") > 4) & F.col("name").contains(F.col("host")))
    uploader = F.when(names, 0).when(F.col("own") & (F.levenshtein(F.substring("host", 1, 64), F.substring("name", 1, 64)) > 6), 2).otherwise(1)
    gap = F.when(F.col("seconds").isNotNull() & F.col("long").isNotNull(), F.greatest(F.col("seconds") - F.col("long"), F.col("short") - F.col("seconds"), F.lit(0.0)))
    placed = lambda cost: F.when(cost.isNotNull() & (F.col("alone") != ""), 1).otherwise(0)
    met = lambda df, cost, form: df.select("clip", "track_key", cost.alias("cost"), F.size(F.split(form, " ")).alias("words"), uploader.alias("uploader"), placed(cost).alias("placed"), gap.alias("gap"))
    worded = met(mine.select(*carried, "f", "form").join(_near_forms(forms, block), "f").join(lib.select("g", *side), "g"), F.col("cost"), "form")
    band = lambda c: F.floor(F.col(c) / BAND)
    asking = mine.where("alone <> ''").select(*carried, "version", F.explode(F.when(F.col("seconds").isNull(), F.array(F.lit(-9).cast("long"))).otherwise(F.sequence(band("seconds") - 1, band("seconds") + 1))).alias("band"))
    # a track stands in each band of its durations, or, without one, among those that any clip may be
    bands = F.array_append(F.when(F.col("long").isNull(), F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.array(band("short"), band("long")))), F.lit(-9).cast("long"))
    titled = lib.where("alone <> ''").select("alone", "version", *side, F.explode(bands).alias("band"))
    title = met(asking.join(titled, ["alone", "version", "band"]), F.lit(None).cast("double"), "alone")
    # one shuffle by clip serves the grouping here and the window over a clip's candidates
    return worded.unionByName(title).repartition("clip").groupBy("clip", "track_key").agg(F.min("cost").alias("cost"), F.max("words").alias("words"), F.min("uploader").alias("uploader"), F.max("placed").alias("placed"), F.min("gap").alias("gap"))


def votes(found: DataFrame) -> DataFrame:
    """The candidate's votes, each a small number; a rival is another candidate whose wording is no worse."""
    wording = F.when(F.col("cost").isNull(), 4).when(F.col("cost") == 0, 0).when(F.col("cost") <= 2.3, 1).when(F.col("cost") <= 4.5, 2).otherwise(3)
    length = F.when(F.col("gap").isNull(), 3).when(F.col("gap") <= 3, 0).when(F.col("gap") <= 6, 1).when(F.col("gap") <= 15, 2).otherwise(4)
    shared = F.when(F.col("words") <= 3, 0).when(F.col("words") == 4, 1).otherwise(2)
    rivals = F.when(F.count("*").over(Window.partitionBy("clip").orderBy(F.coalesce("cost", F.lit(99.0)))) > 1, 1).otherwise(0)
    return found.withColumns({"wording": wording, "duration": length, "shared": shared, "rivals": rivals})


class LabelModel:
    """Hidden class with tree-shaped dependencies between the votes, fitted on pattern counts."""

    def __init__(self, sizes: dict[str, int] = VOTES, prior=PRIOR, pseudo: float = PSEUDO):
        self.names, self.sizes = list(sizes), list(sizes.values())
        self.prior = [np.array(prior[n]) for n in self.names]
        self.pseudo = pseudo
        self.share = 0.7
        self.parent: list[int | None] = [None] * len(self.names)
        self.tables = [p.copy() for p in self.prior]

    def _log(self, x: np.ndarray) -> np.ndarray:
        out = np.log(np.array([1 - self.share, self.share]))[None, :].repeat(len(x), 0)
        for j, t in enumerate(self.tables):
            p = self.parent[j]
            out += np.log(t[:, x[:, j]] if p is None else t[:, x[:, p], x[:, j]]).T
        return out

    def posterior(self, x: np.ndarray) -> np.ndarray:
        g = self._log(x)
        g = np.exp(g - g.max(1, keepdims=True))
        return g[:, 1] / g.sum(1)

    def _tree(self, x: np.ndarray, w: np.ndarray) -> None:
        """Maximum spanning tree over the mutual information of votes given the class."""
        k = len(self.names)
        info = np.zeros((k, k))
        for i in range(k):
            for j in range(i):
                for c in (0, 1):
                    t = np.zeros((self.sizes[i], self.sizes[j]))
                    np.add.at(t, (x[:, i], x[:, j]), w[:, c])
                    n = t.sum()
                    if n > 0:
                        p = t / n
                        e = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
                        info[i, j] += n / w.sum() * (p[p > 0] * np.log(p[p > 0] / e[p > 0])).sum()
                info[j, i] = info[i, j]
        inside, self.parent = {0}, [None] * k
        while len(inside) < k:
            i, j = max(((i, j) for i in inside for j in range(k) if j not in inside), key=lambda e: info[e])
            self.parent[j] = i
            inside.add(j)

    def _tables(self, x: np.ndarray, w: np.ndarray) -> None:
        self.share = float((w[:, 1].sum() + self.pseudo / 2) / (w.sum() + self.pseudo))
        for j, p in enumerate(self.parent):
            if p is None:
                t = np.zeros((2, self.sizes[j]))
                for c in (0, 1):
                    np.add.at(t[c], x[:, j], w[:, c])
                t += (self.pseudo + FIRM.get(self.names[j], 0) * w.sum()) * self.prior[j]
            else:
                t = np.zeros((2, self.sizes[p], self.sizes[j]))
                for c in (0, 1):
                    np.add.at(t[c], (x[:, p], x[:, j]), w[:, c])
                t += (self.pseudo + FIRM.get(self.names[j], 0) * t.sum(-1, keepdims=True)) * self.prior[j][:, None, :]
            self.tables[j] = t / t.sum(-1, keepdims=True)

    def fit(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> LabelModel:
        if not len(patterns):
            return self
        for at in range(rounds):
            r = self.posterior(patterns)
            w = np.stack([1 - r, r], 1) * counts[:, None]
            if at == rounds // 3:
                self._tree(patterns, w)
            self._tables(patterns, w)
        return self


def matches(clips: DataFrame, tracks: DataFrame, nickname: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """(clip, track_key, confidence): each clip's most confident track."""
    voted = written(votes(candidates(clips, tracks, nickname)), "linkage-votes")
    names = list(VOTES)
    # vote patterns: at most the product of the value counts, 900
    seen = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    x = np.array([[r[n] for n in names] for r in seen], dtype=int).reshape(-1, len(names))
    model = LabelModel().fit(x, np.array([r["n"] for r in seen], dtype=float))
    belief = [(*map(int, p), float(q)) for p, q in zip(x, model.posterior(x), strict=True)] if len(x) else []
    table = clips.sparkSession.createDataFrame(belief, ", ".join(f"{n} int" for n in names) + ", confidence double")
    scored = voted.join(F.broadcast(table), names)
    best = Window.partitionBy("clip").orderBy(F.desc("confidence"), F.col("cost").asc_nulls_last(), F.col("gap").asc_nulls_last(), "track_key")
    return scored.withColumn("place", F.row_number().over(best)).where((F.col("place") == 1) & (F.col("confidence") >= confident)).select("clip", "track_key", F.round("confidence", 6).alias("confidence"))

