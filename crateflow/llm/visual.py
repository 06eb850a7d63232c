"""Problem 1: one written form for texts that look the same in print but differ in their characters.

Method: every text is mapped to what a reader sees (width folded, look-alike letters of other scripts
written as the Latin letter, every kind of space one plain space, invisible characters gone). The mapped
values are grouped in SQL under the accent- and case-sensitive Unicode collation, so precomposed and
combining accents fall into one class, while case, accents and spelling keep classes apart. Each class
gets one deterministic member as its canonical form, which is joined back to all members.

Defined cases: a null stays null and is in no class; an empty or blank text maps to the empty string;
repeated rows get the same canonical form; ties for the canonical form go to the text that equals its own
mapped form, then to the one of fewest characters (composed marks), then to the smallest in byte order; texts of any length are mapped whole; an empty table gives
an empty result; other columns of the inputs are never read.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.session import written

#: Letters of other scripts that print like a Latin letter, in natural order.
LOOKALIKE = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Ӏ": "I", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ѵ": "v", "һ": "h", "ү": "y", "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    # Armenian
    "Օ": "O", "Տ": "S", "Ս": "U", "Լ": "L", "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q",
    # Latin and signs
    "ɡ": "g", "ɑ": "a", "‐": "-", "‑": "-", "‒": "-", "−": "-", "﹣": "-",
}
#: One character that prints as several.
LIGATURE = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "ǉ": "lj", "ǌ": "nj", "ǆ": "dž"}
#: Characters that leave no mark: formats and joiners, soft hyphen, grapheme joiner, fillers, variation selectors, controls other than white space.
INVISIBLE = r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}]+"
SPACES = r"[\p{Z}\t\n\x{0B}\f\r\x{85}]+"


#: Code points of the scripts whose letters with marks are derived from the letters above, and of number forms.
MARKED_LETTERS = (range(0x0370, 0x0588), range(0x1F00, 0x2000))
NUMBER_FORMS = range(0x2160, 0x2180)


def _width_table() -> dict[str, str]:
    """Full- and half-width forms and their usual form, by Unicode's own compatibility rule."""
    out = {}
    for c in map(chr, range(0xFF01, 0xFFEF)):
        k = unicodedata.normalize("NFKC", c)
        if k != c and len(k) == 1:
            out[c] = k
    return out


def _tables() -> tuple[dict[str, str], dict[str, str]]:
    """(one character to one, one character to several).

    A letter whose base prints like a Latin one maps to the Latin letter with the same marks, wherever Unicode composes that;
    number forms (a Roman four) map to their letters.
    """
    one, several = _width_table() | LOOKALIKE, dict(LIGATURE)
    for c in (chr(o) for r in MARKED_LETTERS for o in r):
        d = unicodedata.normalize("NFD", c)
        if len(d) > 1 and d[0] in LOOKALIKE:
            k = unicodedata.normalize("NFC", LOOKALIKE[d[0]] + d[1:])
            if len(k) == 1:
                one[c] = k
    for c in map(chr, NUMBER_FORMS):
        k = unicodedata.normalize("NFKC", c)
        if k.isascii():
            (one if len(k) == 1 else several)[c] = k
    return one, several


ONE, SEVERAL = _tables()
PLAIN_INVISIBLE = r"[\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}]+"
PLAIN_SPACES = r"[ \t\n\x{0B}\f\r]+"


def visible(c: Column) -> Column:
    """What a reader sees of a text; null stays null."""
    ascii_ = F.trim(F.regexp_replace(F.regexp_replace(c, PLAIN_INVISIBLE, ""), PLAIN_SPACES, " "))
    full = F.translate(F.regexp_replace(c, INVISIBLE, ""), "".join(ONE), "".join(ONE.values()))
    rare = full
    for k, v in SEVERAL.items():
        rare = F.replace(rare, F.lit(k), F.lit(v))
    full = F.when(full.rlike("[" + "".join(SEVERAL) + "]"), rare).otherwise(full)
    full = F.trim(F.regexp_replace(full, SPACES, " "))
    return F.when(F.length(c) == F.octet_length(c), ascii_).otherwise(full)


_CLASSES = """
SELECT seen_a, seen_t, min(struct(off, length(a) + length(t) AS letters, a, t)) AS best
FROM (SELECT seen_a COLLATE UNICODE AS seen_a, seen_t COLLATE UNICODE AS seen_t, off, a, t FROM {members})
GROUP BY seen_a, seen_t
"""
_BACK = """
SELECT m.a, m.t, c.best.a AS canon_a, c.best.t AS canon_t, m.library, m.track_key
FROM {members} m JOIN {classes} c
ON m.seen_a COLLATE UNICODE = c.seen_a AND m.seen_t COLLATE UNICODE = c.seen_t
"""


def canonical_pairs(feed: DataFrame, library: DataFrame) -> DataFrame:
    """Distinct (artist, title) writings of both tables with their class's canonical member.

    ``feed`` and ``library`` have columns a and t; ``library`` also track_key. Result: a, t, canon_a,
    canon_t, library (is it a library writing), track_key. Hot artists do no harm: the keys hold the title, and
    equal rows collapse in the map-side aggregation before anything is shuffled.
    """
    spark = feed.sparkSession
    both = (
        feed.select("a", "t", F.lit(False).alias("library"), F.lit(None).cast("string").alias("track_key"))
        .unionByName(library.select("a", "t", F.lit(True).alias("library"), "track_key"))
        .where("a IS NOT NULL AND t IS NOT NULL")
        .distinct()
        .withColumn("seen_a", visible(F.col("a")))
        .withColumn("seen_t", visible(F.col("t")))
        .withColumn("off", (F.col("a") != F.col("seen_a")).cast("int") + (F.col("t") != F.col("seen_t")).cast("int"))
    )
    both = written(both, "print-members")
    classes = spark.sql(_CLASSES, members=both)
    return spark.sql(_BACK, members=both, classes=classes)


def same_in_print(candidate: DataFrame, tracks: DataFrame) -> DataFrame:
    """(row_ord, track_key) of candidate rows that print like a track but are written with other characters."""
    feed = candidate.select(F.col("row_ord"), F.col("artist").alias("a"), F.col("title").alias("t"))
    lib = tracks.select(F.col("artist").alias("a"), F.col("title").alias("t"), "track_key")
    pairs = canonical_pairs(feed, lib)
    mine = pairs.where("NOT library").select("a", "t", "canon_a", "canon_t")
    theirs = pairs.where("library").select(F.col("a").alias("lib_a"), F.col("t").alias("lib_t"), "canon_a", "canon_t", "track_key")
    met = mine.join(theirs, ["canon_a", "canon_t"]).where("a <> lib_a OR t <> lib_t").select("a", "t", "track_key").distinct()
    return feed.join(met, ["a", "t"]).select("row_ord", "track_key").distinct()


def canonical_forms(df: DataFrame, keep: list[str], artist: str = "artist", title: str = "title") -> DataFrame:
    """``keep`` columns with canonical_artist and canonical_title; rows that lack one of the two keep null there."""
    rows = df.select(*keep, F.col(artist).alias("a"), F.col(title).alias("t"))
    none = rows.select("a", "t", F.lit(None).cast("string").alias("track_key")).limit(0)
    pairs = canonical_pairs(rows, none).select("a", "t", F.col("canon_a").alias("canonical_artist"), F.col("canon_t").alias("canonical_title"))
    return rows.join(pairs, ["a", "t"], "left").select(*keep, "canonical_artist", "canonical_title")
