"""Similarity of names in Arrow batches, and the composite score of a match."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.functions.numbers import duration_score
from crateflow.functions.text import match_text


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Share of characters kept by insertions and deletions alone, in percent."""
    n = len(a) + len(b)
    return 100.0 * 2 * _common(a, b) / n if n else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_x or not only_y):
        return 100.0
    p, q = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    return max([ratio(p, q), *([ratio(both, p), ratio(both, q)] if both else [])])


def _arrow(f):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) / 100 for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(run, T.DoubleType())


token_set = _arrow(token_set_ratio)
token_sort = _arrow(token_sort_ratio)


#: Phrases of a title that speak for an official upload.
OFFICIAL = ("official audio", "official video", "official music video", "official visualizer", "official lyric video")
#: Words of a clip's title that rule it out, and those that lower its score, unless they are asked for.
REJECTED = (
    "full album", "full ep", "full mixtape", "complete album", "all songs", "playlist", "reaction", "review", "explained", "breakdown", "tutorial", "how to play", "guitar lesson", "drum cover",
    "first time listening", "first time hearing", "karaoke", "instrumental", "backing track", "minus one", "nightcore", "daycore", "8d audio", "8d", "bass boosted", "top 10", "top 20", "best of", "greatest hits", "compilation", "megamix",
)
LOWERED = {"live": 0.7, "cover": 0.3, "remix": 0.6, "acoustic": 0.7, "slowed": 0.3, "reverb": 0.4, "sped up": 0.3, "speed up": 0.3, "lofi": 0.4, "lo-fi": 0.4, "extended": 0.6, "extended mix": 0.5}
#: Shares of artist and title, and of the signals with and without a clip's own artist and track fields.
ARTIST_SHARE, TITLE_SHARE = 0.45, 0.55
TOPIC = " - Topic"


def keyword_factor(found: Column, wanted: Column, reject=REJECTED, lower=LOWERED) -> Column:
    """0 if a rejected word stands in the found text and not in the wanted one, else the smallest factor of a whole word, else 1.

    A word that stands anywhere in the wanted text, even inside another word, is asked for.
    """
    f, w = F.lower(found), F.lower(wanted)
    bad = F.exists(F.array(*map(F.lit, reject)), lambda k: f.contains(k) & ~w.contains(k))
    cuts = [F.when(f.rlike(rf"(?U)\b\Q{k}\E\b") & ~w.contains(k), p).otherwise(1.0) for k, p in lower.items()]
    return F.when(bad, 0.0).otherwise(F.least(F.lit(1.0), *cuts, F.lit(1.0)))


_BITS = {k: 1 << i for i, k in enumerate(dict.fromkeys((*REJECTED, *LOWERED)))}
#: Bits of the rejected words, and the factor of the bit of each word that lowers a score.
REJECTED_BITS, LOWERED_BITS = sum(_BITS[k] for k in REJECTED), {_BITS[k]: p for k, p in LOWERED.items()}


def _bits(held: dict[str, Column]) -> Column:
    out = F.lit(0).cast("long")
    for k, c in held.items():
        out = out.bitwiseOR(F.when(c, F.lit(_BITS[k])).otherwise(F.lit(0)).cast("long"))
    return out


def found_bits(found: Column) -> Column:
    """Bits of the words in a clip's text that ``keyword_factor`` looks for, as if none were asked for."""
    f = F.lower(found)
    return _bits({k: f.contains(k) for k in REJECTED} | {k: f.rlike(rf"(?U)\b\Q{k}\E\b") for k in LOWERED})


def wanted_bits(wanted: Column) -> Column:
    """Bits of these words that stand anywhere in the wanted text."""
    w = F.lower(wanted)
    return _bits({k: w.contains(k) for k in _BITS})


def says_official(title: Column) -> Column:
    return F.exists(F.array(*map(F.lit, OFFICIAL)), lambda k: F.contains(F.lower(F.coalesce(title, F.lit(""))), k))


def named_share(artist: Column, title: Column, names: list[Column], found: Column) -> Column:
    """Likeness of an expected artist to any of the names and of an expected title to the found one; all are match texts."""
    like = lambda a, b: F.coalesce(token_set(a, b), F.lit(0.0))
    return ARTIST_SHARE * F.greatest(F.lit(0.0), *[like(artist, n) for n in names]) + TITLE_SHARE * F.coalesce(token_sort(title, found), F.lit(0.0))


def structured_share(artist: Column, title: Column, own_artist: Column, own_track: Column) -> Column:
    """Likeness to a clip's own artist and track, null if it lacks one; all are match texts."""
    both = ARTIST_SHARE * token_set(artist, own_artist) + TITLE_SHARE * token_set(title, own_track)
    return F.when((own_artist != "") & (own_track != ""), both)


def channel_trust(artist: Column, channel: Column, uploader: Column, title: Column, followers: Column | None = None) -> Column:
    """Trust in a clip's source; ``artist`` is a match text, the others are plain and may be null."""
    names = [F.coalesce(c, F.lit("")) for c in (channel, uploader)]
    like = lambda c: F.coalesce(token_set(artist, match_text(c)), F.lit(0.0))
    topic = [n.endswith(TOPIC) & (like(F.replace(n, F.lit(TOPIC), F.lit(""))) > 0.8) for n in names]
    near = F.greatest(*map(like, names))
    base = F.when(near > 0.85, 0.9).when(near > 0.7, 0.7).otherwise(0.5)
    if followers is not None:
        base = F.greatest(base, F.when(followers > 1_000_000, 0.8).when(followers > 100_000, 0.7).when(followers > 10_000, 0.6).otherwise(0.0))
    return F.when(topic[0] | topic[1], 1.0).otherwise(F.when(says_official(title), F.least(F.lit(1.0), base + 0.1)).otherwise(base))


def composite(fuzzy: Column, structured: Column, channel: Column, seconds: Column, factor: Column) -> Column:
    """One score of text, structured fields, channel, duration and key words."""
    d = duration_score(seconds)
    rich = 0.40 * structured + 0.25 * fuzzy + 0.20 * channel + 0.10 * d + 0.05
    plain = 0.50 * fuzzy + 0.25 * channel + 0.15 * d + 0.10 * factor
    score = F.when(F.coalesce(structured, F.lit(0.0)) > 0.7, rich).otherwise(plain) * factor
    return F.when((factor == 0) | ((seconds > 0) & (d == 0)), 0.0).otherwise(score)
