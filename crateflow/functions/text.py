"""Text functions as Column expressions; they stay in the JVM and in code generation, but for Unicode decompositions.

White space is Unicode's, as in the services whose keys have to be met.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entities decoded in this order.
ENTITIES = (("&#8211;", "–"), ("&#8212;", "—"), ("&#8220;", "“"), ("&#8221;", "”"), ("&#038;", "&"), ("&amp;", "&"))
#: Separators of artist and title, signs stripped from keys and file names, quotes stripped from edges.
DASHES, TILDE = "[–—‒\\-·]", "~"
KEY_SIGNS, FILE_SIGNS = "[()\\[\\]\"']", '[<>:"/\\\\|?*]'
EDGE_QUOTES = "^[\"“”‘’']+|[\"“”‘’']+$"
#: White space in Unicode's sense.
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
#: Notes of clips that say nothing of the recording, and ways to write a guest.
NOISE = ("official music video", "official video", "official audio", "lyric video", "lyrics", "lyric", "audio", "visualizer", "official visualizer", "official lyric video", "hq", "hd", "4k")
GUEST = re.compile(r"\b(?:feat\.?|ft\.?|featuring)\b")
_NOISE = re.compile(r"[(\[](?:" + "|".join(n.replace(" ", r"\s*") for n in NOISE) + r")[)\]]")


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def squeezed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def key_part(c: Column) -> Column:
    return squeezed(F.regexp_replace(F.lower(c), KEY_SIGNS, ""))


def track_key(artist: Column, title: Column) -> Column:
    """The usual key of an artist and a title; null if one is null."""
    return F.concat(key_part(artist), F.lit(" - "), key_part(title))


def file_key(artist: Column, title: Column) -> Column:
    """The usual key, null if artist or title is null or blank."""
    return F.when((stripped(artist) != "") & (stripped(title) != ""), track_key(artist, title))


def _decomposed(s: str) -> str:
    return s if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def clip_words(s: str) -> str:
    """Text for comparison: no marks, lower case, no notes of clips, one form of guests, letters and digits only."""
    s = GUEST.sub("feat", _NOISE.sub("", _decomposed(s).lower()))
    return " ".join(re.sub(r"[^a-z0-9\s]", " ", s).split())


def artist_words(s: str) -> str:
    """Artist for comparison: no marks, lower case, words only."""
    return " ".join(re.sub(r"[^\w\s]", " ", _decomposed(s).lower()).split())


def ascii_letters(s: str) -> str:
    """Letters and digits that survive every way to rename a file."""
    return "".join(c for c in _decomposed(s.lower()) if c.isascii() and c.isalnum())


def _on_distinct(f: Callable[[str], str]):
    """Arrow function that works on the distinct values of each batch; Spark has no decomposition of its own."""

    def run(s: pd.Series) -> pd.Series:
        codes, values = pd.factorize(s)
        out = pd.Series([f(v) for v in values] + [None], dtype=object)
        return out.take(codes).reset_index(drop=True)

    return F.pandas_udf(run, T.StringType())


match_text, artist_text, skeleton = _on_distinct(clip_words), _on_distinct(artist_words), _on_distinct(ascii_letters)


def cache_key(artist: Column, title: Column) -> Column:
    """Key of look-up caches; it keeps brackets, quotes and inner spaces."""
    return F.concat(F.lower(F.trim(artist)), F.lit("|"), F.lower(F.trim(title)))


def stable_id(source: Column, artist: Column, title: Column) -> Column:
    digest = F.sha1(F.concat(source, F.lit("|"), F.lower(artist), F.lit("|"), F.lower(title)).cast("binary"))
    return F.concat(F.substring(source, 1, 6), F.lit("_"), F.substring(digest, 1, 16))


def search_text(artist: Column, title: Column) -> Column:
    return F.concat(F.trim(artist), F.lit(" - "), F.trim(title))


def safe_filename(c: Column, most: int = 200) -> Column:
    return F.substring(squeezed(F.regexp_replace(c, FILE_SIGNS, "")), 1, most)


def decoded(c: Column) -> Column:
    """Entities decoded."""
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def cleaned(c: Column) -> Column:
    """Without quotes at the edges, then without white space there."""
    return stripped(F.regexp_replace(c, EDGE_QUOTES, ""))


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def redacted(c: Column) -> Column:
    return F.regexp_replace(c, "(api_key=)[^&]+", "$1***")


def masked(c: Column) -> Column:
    return F.concat(F.lit("********..."), F.right(c, F.lit(4)))


def resized(url: Column, old: int, new: int) -> Column:
    """Link to an image of another size."""
    return F.replace(url, F.lit(f"{old}x{old}"), F.lit(f"{new}x{new}"))


def is_png(data: Column) -> Column:
    """By the first bytes of a file."""
    return F.startswith(data, F.lit(b"\x89PNG"))


def last_part(c: Column, sep: str) -> Column:
    """What stands after the last separator, in lower case."""
    return F.element_at(F.split(F.lower(c), sep), -1)


def csv_set(c: Column) -> Column:
    """Distinct lower-case values of a comma list, in order, without blanks."""
    return F.array_distinct(F.filter(F.transform(F.split(F.lower(c), ","), lambda x: F.trim(x)), lambda x: x != ""))


def minutes_text(seconds: Column) -> Column:
    """M:SS."""
    s = seconds.cast("long")
    return F.concat(F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))


def fingerprint_hash(c: Column) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, 20)


def _pair(c: Column, sign: str) -> Column:
    parts = F.split(decoded(c), f"{SPACE}+{sign}{SPACE}+", 2)
    a, b = cleaned(F.get(parts, F.lit(0))), cleaned(F.get(parts, F.lit(1)))
    return F.when((F.size(parts) == 2) & (a != "") & (b != ""), F.struct(a.alias("artist"), b.alias("title")))


def dash_pair(title: Column, link: Column | None = None) -> Column:
    """Artist and title around the first dash with spaces, or null."""
    return _pair(title, DASHES)


def tilde_pair(title: Column, link: Column | None = None) -> Column:
    return _pair(title, TILDE)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_pair(title: Column, link: Column) -> Column:
    """Artist from the part of the link's last segment before the title's slug."""
    seg = F.element_at(F.split(F.regexp_replace(link, "/+$", ""), "/"), -1)
    t = cleaned(decoded(title))
    s = slug(t)
    artist = F.initcap(F.replace(F.substring(seg, F.lit(1), F.length(seg) - F.length(s) - 1), F.lit("-"), F.lit(" ")))
    fits = (s != "") & F.endswith(seg, F.concat(F.lit("-"), s)) & (F.length(seg) > F.length(s) + 1)
    return F.when(fits, F.struct(artist.alias("artist"), t.alias("title")))


#: Parsers by the names that feeds give; callers may add their own.
PARSERS: dict[str, Callable[[Column, Column], Column]] = {"dash": dash_pair, "tilde": tilde_pair, "dash_quoted": dash_pair, "pitchfork": slug_pair}


def parsed_by(name: Column, title: Column, link: Column) -> Column:
    """Parser chosen by a column; unknown names give null."""
    out = F.lit(None).cast("struct<artist:string,title:string>")
    for k, f in PARSERS.items():
        out = F.when(name == k, f(title, link)).otherwise(out)
    return out
