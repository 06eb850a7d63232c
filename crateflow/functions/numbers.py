"""Scores, classes, vectors and dates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sectors of the valence-arousal plane from 0 degrees on, each 45 degrees wide.
MOODS = ("Energetic", "Excited", "Intense", "Angry", "Melancholic", "Sad", "Calm", "Relaxed")
ENERGY = ("very_low", "low", "medium", "high", "very_high")
#: Fixed values: (name, first hour, end hour); a part of the day may run over midnight.
DAYPARTS = (("Dawn", 5, 9), ("Day", 9, 17), ("Dusk", 17, 22), ("Night", 22, 5))


def rescaled(x: Column) -> Column:
    """1..9 to -1..1."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (x - 5) / 4))


def mood(valence: Column, arousal: Column) -> Column:
    deg = F.degrees(F.atan2(arousal, valence))
    deg = F.when(deg < 0, deg + 360).otherwise(deg)
    return F.element_at(F.array(*map(F.lit, MOODS)), F.floor(((deg + 22.5) % 360) / 45).cast("int") + 1)


def mood_confidence(valence: Column, arousal: Column) -> Column:
    c = 0.65 + 0.30 * F.least(F.lit(1.0), F.sqrt(valence * valence + arousal * arousal))
    c = c + F.when((F.abs(valence) > 0.7) | (F.abs(arousal) > 0.7), 0.05).otherwise(0.0)
    return F.round(F.least(F.lit(0.98), c), 3)


def energy_level(arousal: Column) -> Column:
    out = F.lit(ENERGY[4])
    for name, cut in reversed(list(zip(ENERGY, (-0.6, -0.2, 0.2, 0.6)))):
        out = F.when(arousal < cut, name).otherwise(out)
    return F.when(arousal.isNotNull(), out)


def energy_ordinal(level: Column) -> Column:
    return F.nullif(F.array_position(F.array(*map(F.lit, ENERGY)), level), F.lit(0)).cast("int")


def duration_score(seconds: Column) -> Column:
    s = seconds
    return (
        F.when(s.isNull() | (s <= 0), 0.5).when((s < 60) | (s > 600), 0.0).when((s >= 120) & (s <= 330), 1.0).when((s < 120) | (s <= 480), 0.8).otherwise(0.5)
    )


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector at length one, null if its length is zero."""
    n = F.sqrt(dot(v, v))
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n))


def day_type(ts: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ("weekday",) * 4 + ("friday", "saturday", "sunday"))), F.weekday(ts) + 1)


def daypart(hour: Column) -> Column:
    """The first part of the day that holds the hour."""
    out = F.lit(None).cast("string")
    for name, a, b in reversed(DAYPARTS):
        out = F.when((hour >= a) & (hour < b) if a < b else (hour >= a) | (hour < b), name).otherwise(out)
    return out


def hours_between(a: Column, b: Column) -> Column:
    """Hours from a up to b, over midnight if b is not later."""
    return F.when(a < b, F.sequence(a, b - 1)).otherwise(F.concat(F.sequence(a, F.lit(23)), F.when(b > 0, F.sequence(F.lit(0), b - 1)).otherwise(F.array().cast("array<int>"))))


def age_days(at: Column, now: Column) -> Column:
    return (now - at) / F.lit(86400.0)


def epoch(text: Column) -> Column:
    """Epoch seconds of a number, an ISO time with offset or Z, or a plain UTC time; 0.0 of anything else."""
    stamp = lambda f: F.unix_micros(F.try_to_timestamp(text, F.lit(f))) / F.lit(1e6)
    return F.coalesce(F.expr("try_cast(1 as double)") * text.try_cast("double"), stamp("yyyy-MM-dd'T'HH:mm:ssXXX"), stamp("yyyy-MM-dd'T'HH:mm:ssX"), stamp("yyyy-MM-dd HH:mm:ss"), F.lit(0.0))


def iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ssXXX")


def rate_class(count: Column, age: Column, expected: Column, grace: float, high: float = 1.2, middle: float = 0.6) -> Column:
    """HEAVY, MEDIUM or LIGHT by rate against what is expected; HEAVY below ``grace`` days."""
    rate = count / F.greatest(F.lit(1.0), age)
    return F.when(age < grace, "HEAVY").when(rate >= expected * high, "HEAVY").when(rate >= expected * middle, "MEDIUM").otherwise("LIGHT")


def step_class(x: Column, steps: list[tuple[str, float]], last: str) -> Column:
    """Name of the first step that x doesn't exceed."""
    out = F.lit(last)
    for name, top in reversed(steps):
        out = F.when(x <= top, name).otherwise(out)
    return F.when(x.isNotNull(), out)
