"""Readers of the engine's relations: feeds, charts, listings, probes, tags, caches and stores.

Each reader takes files in the shape a service returns and gives a relation with a fixed schema; missing files are empty
relations where the reader is optional. Schemas are explicit, so nothing is inferred and only needed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from crateflow.functions import text

CANDIDATE = "id string, artist string, title string, cover string, search string, source string, src_ord int, row_ord bigint"
TAG_CHART = "tag string, ord int, name string, artist struct<name:string>, image array<struct<size:string,text:string>>"
FEED = "url string, parser string, link_must_contain string, label string, enabled boolean, `limit` int"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def optional_json(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """JSON rows, none if the file is missing; broken rows are dropped."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", not lines).option("mode", "DROPMALFORMED").json(path)


def as_candidates(df: DataFrame, source: str | F.Column, src_ord: int, order: list) -> DataFrame:
    """Canonical rows of a source: trimmed, blank artists and titles dropped, with id, search text and ordinals."""
    a, t = F.trim("artist"), F.trim("title")
    src = F.lit(source) if isinstance(source, str) else source
    out = df.where((a != "") & (t != "")).select(a.alias("artist"), t.alias("title"), "cover", src.alias("source"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    rank = F.struct(*[F.col(f"_o{i}") for i in range(len(order))])
    return out.select(text.stable_id(F.col("source"), F.col("artist"), F.col("title")).alias("id"), "artist", "title", "cover", text.search_text(F.col("artist"), F.col("title")).alias("search"), "source", F.lit(src_ord).alias("src_ord"), rank.alias("ord"))


def chart(spark: SparkSession, path: str) -> DataFrame:
    """Popular chart: artist, title, cover of each entry."""
    df = optional_json(spark, path, "ord int, artist string, title string, thumb_url_large string")
    return as_candidates(df.withColumnRenamed("thumb_url_large", "cover"), "chart", 0, ["ord"])


def feeds(entries: DataFrame, specs: DataFrame) -> DataFrame:
    """Feed entries: the first ``limit`` entries of each enabled feed, then those whose link fits, parsed by the feed's parser."""
    spec = specs.where("url IS NOT NULL AND coalesce(enabled, true)").select("label", F.coalesce("parser", F.lit("dash")).alias("parser"), F.coalesce("link_must_contain", F.lit("")).alias("must"), F.coalesce("limit", F.lit(30)).alias("most"))
    e = entries.join(spec, "label").withColumn("_rn", F.row_number().over(Window.partitionBy("label").orderBy("entry_ord"))).where("_rn <= most AND title IS NOT NULL AND instr(coalesce(link, ''), must) > 0 OR (_rn <= most AND title IS NOT NULL AND must = '')")
    e = e.withColumn("p", text.parsed_by(F.col("parser"), F.col("title"), F.col("link"))).where("p IS NOT NULL").select("label", "entry_ord", "p.artist", "p.title", F.lit(None).cast("string").alias("cover"))
    return as_candidates(e, F.col("label"), 1, ["entry_ord"])


def best_image(images) -> F.Column:
    """Text of the first large image."""
    return F.get(F.filter(images, lambda i: i["size"].isin("extralarge", "large") & (F.coalesce(i["text"], F.lit("")) != "")), F.lit(0))["text"]


def tag_charts(df: DataFrame, per_tag: int = 20) -> DataFrame:
    """Top entries of each tag."""
    top = df.withColumn("_rn", F.row_number().over(Window.partitionBy("tag").orderBy("ord"))).where(F.col("_rn") <= per_tag)
    return as_candidates(top.select("tag", "ord", F.col("artist.name").alias("artist"), F.col("name").alias("title"), best_image(F.col("image")).alias("cover")), F.concat(F.lit("tag:"), "tag"), 2, ["tag", "ord"])


def personal(similar: DataFrame, seeds: DataFrame, top_tracks: DataFrame, per_seed: int = 2, per_artist: int = 2, least: float = 0.35) -> DataFrame:
    """Tracks of artists similar to the seeds: good enough, not seeds themselves, each artist from its first seed."""
    key = lambda c: F.lower(F.trim(c))
    s = similar.where(F.coalesce(F.col("match").try_cast("double"), F.lit(0.0)) >= least).withColumn("k", key("name"))
    s = s.join(seeds.select(key("artist").alias("k")).distinct(), "k", "left_anti").join(seeds.select(F.col("artist").alias("seed"), F.col("ord").alias("seed_ord")), "seed")
    s = s.withColumn("_rn", F.row_number().over(Window.partitionBy("seed").orderBy("ord"))).where(F.col("_rn") <= per_seed)
    s = s.groupBy("k").agg(F.min(F.struct("seed_ord", "ord")).alias("o"), F.min_by("name", F.struct("seed_ord", "ord")).alias("name"))
    t = top_tracks.withColumn("_rn", F.row_number().over(Window.partitionBy("artist").orderBy("ord"))).where(F.col("_rn") <= per_artist)
    t = t.withColumn("k", key("artist")).join(s.select("k", "o", F.col("name").alias("shown")), "k")
    return as_candidates(t.select("o", "ord", F.col("shown").alias("artist"), F.col("name").alias("title"), best_image(F.col("image")).alias("cover")), "personal", 3, ["o", "ord"])


def probe_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a line for each probed candidate; bad lines are skipped."""
    return optional_json(spark, path, "queue_id string, source_rank int, title string, uploader string, channel string, channel_follower_count bigint, duration double, artist string, track string, webpage_url string, extractor_key string")


def tag_frames(df: DataFrame) -> DataFrame:
    """Features from tag frames (path, frames): missing or unreadable values keep their defaults."""
    f = lambda k: F.try_element_at("frames", F.lit(k))
    num = lambda k, kind, d: F.coalesce(f(k).try_cast(kind), F.lit(d)).alias(k.lower())
    return df.select("path", num("BPM", "int", 0), F.coalesce(f("MOOD"), F.lit("")).alias("mood"), num("DURATION", "int", 0), f("VALENCE").try_cast("double").alias("valence"), f("AROUSAL").try_cast("double").alias("arousal"), F.coalesce(f("LASTFM_TAGS"), F.lit("")).alias("lastfm_tags"))


def identity(df: DataFrame) -> DataFrame:
    """Artist and title from tags, else from an "A - T" file name, else Unknown."""
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]+$", "")
    parts = F.split(name, " - ", 2)
    pick = lambda spellings: F.coalesce(*[F.nullif(F.trim(F.try_element_at("frames", F.lit(k))), F.lit("")) for k in spellings])
    return df.select("path", F.coalesce(pick(["artist", "ARTIST", "album_artist", "ALBUM_ARTIST"]), F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(0)))), F.lit("Unknown")).alias("artist"), F.coalesce(pick(["title", "TITLE"]), F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(1)))), name).alias("title"))


def mood_of_file(df: DataFrame) -> DataFrame:
    """Mood from custom fields, the mood column or a "Mood:" line."""
    c = lambda k: F.nullif(F.try_element_at("custom_fields", F.lit(k)), F.lit(""))
    return df.withColumn("mood", F.coalesce(c("mood"), c("MOOD"), F.nullif("mood", F.lit("")), F.nullif(F.trim(F.regexp_extract(F.coalesce("text", F.lit("")), r"(?m)^Mood:(.*)$", 1)), F.lit(""))))


def library_paths(df: DataFrame, suffixes: tuple[str, ...] = ("mp3", "flac", "m4a", "ogg", "opus", "wav", "aac")) -> DataFrame:
    """Artist, album and file of .../artist/album/file paths with known suffixes, each path once."""
    p = F.split("path", "/")
    ok = F.lower(F.substring_index("path", ".", -1)).isin(*suffixes)
    return df.where(ok).select("path", F.element_at(p, -3).alias("artist"), F.element_at(p, -2).alias("album"), F.element_at(p, -1).alias("file")).distinct()


QUEUE = "id string, artist string, title string, cover string, search string, source string"
FILE = "id bigint, artist string, title string, path string, art string, unique_id string, mtime bigint, uploaded_at bigint, playlists array<struct<id:bigint,name:string>>, custom_fields map<string,string>, mood string, text string"
PLAY = "played_at bigint, song struct<id:string,unique_id:string,artist:string,title:string>"
STATION = "id bigint, backend_config struct<duplicate_prevention_time_range:int,autodj_queue_length:int>, backend_type string"


def queue(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Queued candidates, one or a list of them a line, or one list in a file; anything else is an empty queue."""
    return optional_json(spark, path, QUEUE, lines).where("coalesce(artist, title, search) IS NOT NULL")


def station_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a station's library listing, with their playlists."""
    return optional_json(spark, path, FILE)


def station_history(spark: SparkSession, path: str, most: int = 500) -> DataFrame:
    """The newest plays of a station, as many as its service gives."""
    plays = optional_json(spark, path, PLAY).select("played_at", "song.*")
    return plays.orderBy(F.desc("played_at"), "unique_id", "id").limit(most)


def station_config(spark: SparkSession, path: str) -> DataFrame:
    """A station's settings, one row."""
    return optional_json(spark, path, STATION, lines=False)


def statistics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Numbers of a run; none if it left no file."""
    return optional_json(spark, path, schema, lines=False)


def covers(wanted: DataFrame, hits: DataFrame, old: int = 100, new: int = 600) -> DataFrame:
    """The first hit's image of each wanted artist and title, in a larger size, or null."""
    k = [F.lower(F.trim("artist")).alias("ka"), F.lower(F.trim("title")).alias("kt")]
    first = hits.select(*k, "ord", "url").groupBy("ka", "kt").agg(F.min_by("url", "ord").alias("url"))
    return wanted.select("*", *k).join(first, ["ka", "kt"], "left").drop("ka", "kt").withColumn("cover", text.resized(F.col("url"), old, new)).drop("url")


def genre_labels(spark: SparkSession, path: str | None = None, count: int = 400) -> DataFrame:
    """(place, label) of a model's classes; placeholder names if there is no list."""
    if path and exists(spark, path):
        return spark.read.text(path).select(F.posexplode(F.from_json("value", "array<string>")).alias("place", "label"))
    return spark.range(count).select(F.col("id").cast("int").alias("place"), F.concat(F.lit("genre_"), F.col("id").cast("string")).alias("label"))


class RecordsReader(DataSourceReader):
    """Splits a list of records into partitions; connectors override ``fetch``."""

    def __init__(self, options: dict[str, Any], fields: list[str]):
        self.options, self.fields = options, fields

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(int(self.options.get("partitions", 2)))]

    def fetch(self, part: int, parts: int) -> Iterator[dict]:
        """Lines that start in the part's share of the file's bytes; the file is opened where Python sees it."""
        import json
        import os

        path = self.options["path"]
        size = os.path.getsize(path)
        start, end = size * part // parts, size * (part + 1) // parts
        with open(path, "rb") as f:
            if start:
                f.seek(start - 1)
                f.readline()  # the line that the part before reads
            while f.tell() < end and (line := f.readline()):
                try:
                    row = json.loads(line)
                except ValueError:
                    continue
                if isinstance(row, dict):
                    yield row

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for r in self.fetch(partition.value, int(self.options.get("partitions", 2))):
            yield tuple(r.get(k) for k in self.fields)


class RecordsSource(DataSource):
    """Pluggable connector: format("records") over files of one JSON object a line."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def schema(self) -> str:
        return "artist string, title string, cover string"

    def reader(self, schema) -> DataSourceReader:
        return RecordsReader(dict(self.options), [f.name for f in schema.fields])
