"""Verdicts on uploads, downloads, stations and counters as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateflow.operators.relations import first_reason

#: Codecs of usable files, the least size of a download, statuses whose files may be deleted.
CODECS = ("mp3", "aac", "flac", "vorbis", "opus", "pcm_s16le")
LEAST_BYTES = 10_240
DELETABLE = ("corrupted", "truncated", "invalid")


def error_lines(c: Column, words: str, most: int) -> Column:
    """The first lines that hold one of the words, joined by semicolons."""
    return F.array_join(F.slice(F.filter(F.split(c, "\n"), lambda x: x.rlike(words)), 1, most), "; ")


def same_upload(size: Column, md5: Column, sha256: Column, remote_size: Column, unique_id: Column, remote_md5: Column, remote_sha256: Column) -> Column:
    """Whether all that a service tells fits the file: size, a unique id of 32 characters, explicit hashes; case is ignored."""
    differs = lambda c: F.coalesce(c, F.lit(False))
    bad = (
        differs((remote_size != 0) & (remote_size != size)) | differs((F.length(unique_id) == 32) & (F.lower(unique_id) != F.lower(md5)))
        | differs((remote_md5 != "") & (F.lower(remote_md5) != F.lower(md5))) | differs((remote_sha256 != "") & (F.lower(remote_sha256) != F.lower(sha256)))
    )
    return ~bad


def download_problem(size: Column, codec: Column, seconds: Column, log: Column) -> Column:
    """What is wrong with a download, empty if nothing: size, stream, codec, duration, errors while decoding, in this order."""
    errors = error_lines(F.coalesce(log, F.lit("")), "(?i)error|corrupt", 3)
    reason = first_reason(
        (size < LEAST_BYTES, "File too small (< 10KB)"), (codec.isNull(), "No audio stream found"), (~codec.isin(*CODECS), F.concat(F.lit("Unexpected audio codec: "), codec)),
        (F.coalesce(seconds, F.lit(0.0)) <= 0, "Invalid duration (0 or negative)"), (errors != "", F.concat(F.lit("Decode errors: "), errors)),
    )
    return F.coalesce(reason, F.lit(""))


def separation_level(live: Column, title_minutes: int, artist_minutes: int) -> Column:
    """How well a station's one window covers the wanted ones."""
    return F.when(live.isNull(), "WARN").when(live < title_minutes, "WARN").when(live < artist_minutes, "INFO").otherwise("OK")


def not_enforceable(rules: dict) -> str:
    """Rules in force that a station can't keep by itself."""
    return ", ".join(f"{k}={v}" for k, v in rules.items() if v)


def alert(count: Column, most: int) -> Column:
    return F.when(count > most, "ALERT").otherwise("ok")
