"""Queries of the engine's own operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crateflow.functions import fuzzy, numbers, text
from crateflow.operators import relations as rel
from crateflow.operators import vectors
from crateflow.operators.closest import best_tracks
from crateflow.operators.packed import split_packed
from crateflow.session import table
from crateflow.streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
#: A fixed "now" of the queries, in epoch seconds.
NOW = 1_750_000_000.0
BLOCKED = ["reggae", "gospel", "seen live", "indie rock"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def key_part_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[()\\[\\]\"'']', '', 'g'), '{text.SPACE}+', ' ', 'g'))"


def _key_sql(a: str = "artist", t: str = "title") -> str:
    return f"{key_part_sql(a)} || ' - ' || {key_part_sql(t)}"


def decoded_sql(x: str) -> str:
    for k, v in text.ENTITIES:
        x = f"replace({x}, '{k}', '{v}')"
    return x


def cleaned_sql(x: str) -> str:
    quotes = text.EDGE_QUOTES.replace("'", "''")
    return f"regexp_replace(regexp_replace({x}, '{quotes}', '', 'g'), '^{text.SPACE}+|{text.SPACE}+$', '', 'g')"


def _pair_sql(sign: str) -> str:
    return f"""
WITH s AS (SELECT result_id, regexp_extract({decoded_sql('title')}, '(?s)^(.*?){text.SPACE}+{sign}{text.SPACE}+(.*)$', ['a', 't']) AS p FROM search_result WHERE title IS NOT NULL),
c AS (SELECT result_id, {cleaned_sql('p.a')} AS artist, {cleaned_sql('p.t')} AS title FROM s)
SELECT result_id, artist, title FROM c WHERE artist <> '' AND title <> ''"""


@query()
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tag of lastfm_tags with its place."""
    return split_packed(table(spark, sf_dir, "track_features"), "feature_id", "lastfm_tags", "tag_ord", "tag")


# keys and texts


@query(f"SELECT track_id, {_key_sql()} AS norm_key FROM tracks")
def q_norm_key(spark, sf_dir):
    return table(spark, sf_dir, "tracks").select("track_id", text.track_key(F.col("artist"), F.col("title")).alias("norm_key"))


@query("SELECT row_ord, substr(source, 1, 6) || '_' || substr(sha1(source || '|' || lower(artist) || '|' || lower(title)), 1, 16) AS stable_id FROM candidate")
def q_stable_id(spark, sf_dir):
    return table(spark, sf_dir, "candidate").select("row_ord", text.stable_id(F.col("source"), F.col("artist"), F.col("title")).alias("stable_id"))


@query("SELECT lookup_id, lower(trim(artist)) || '|' || lower(trim(title)) AS cache_key FROM genre_result")
def q_cache_key(spark, sf_dir):
    return table(spark, sf_dir, "genre_result").select("lookup_id", text.cache_key(F.col("artist"), F.col("title")).alias("cache_key"))


@query(r"""SELECT result_id, substr(trim(regexp_replace(regexp_replace(title, '[<>:"/\\|?*]', '', 'g'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g')), 1, 200) AS safe_name FROM search_result""")
def q_safe_filename(spark, sf_dir):
    return table(spark, sf_dir, "search_result").select("result_id", text.safe_filename(F.col("title")).alias("safe_name"))


@query(_pair_sql("[–—‒\\-·]"))
def q_parse_dash(spark, sf_dir):
    p = table(spark, sf_dir, "search_result").select("result_id", text.dash_pair(F.col("title")).alias("p"))
    return p.where("p IS NOT NULL").select("result_id", "p.artist", "p.title")


@query(_pair_sql(text.TILDE))
def q_parse_tilde(spark, sf_dir):
    p = table(spark, sf_dir, "search_result").select("result_id", text.parsed_by(F.lit("tilde"), F.col("title"), F.col("url")).alias("p"))
    return p.where("p IS NOT NULL").select("result_id", "p.artist", "p.title")


@query(r"""
WITH s AS (SELECT track_id, title, trim(regexp_replace(lower(artist || ' ' || title), '[^a-z0-9]+', '-', 'g'), '-') AS seg, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM tracks)
SELECT track_id, replace(substr(seg, 1, length(seg) - length(slug) - 1), '-', ' ') AS artist_words FROM s WHERE slug <> '' AND ends_with(seg, '-' || slug) AND length(seg) > length(slug) + 1""")
def q_slug_parse(spark, sf_dir):
    t = table(spark, sf_dir, "tracks").select("track_id", "title", F.concat(F.lit("https://site.example/review/"), text.slug(F.concat_ws(" ", "artist", "title")), F.lit("/")).alias("link"))
    p = t.where("title IS NOT NULL").select("track_id", text.slug_pair(F.col("title"), F.col("link")).alias("p")).where("p IS NOT NULL")
    return p.select("track_id", F.lower("p.artist").alias("artist_words"))


@query(r"""SELECT doc_id, length(regexp_replace(text, '<[^>]*>', '', 'g')) AS plain_chars, md5(regexp_replace(text, '<[^>]*>', '', 'g')) AS plain_md5 FROM documents WHERE text IS NOT NULL""")
def q_html_strip(spark, sf_dir):
    plain = text.without_tags(F.col("text"))
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.length(plain).cast("long").alias("plain_chars"), F.md5(plain.cast("binary")).alias("plain_md5"))


@query(r"""SELECT result_id, regexp_replace(url || '?api_key=' || source || '&v=1', '(api_key=)[^&]+', '\1***') AS redacted, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS last_segment, '********...' || right(url, 4) AS masked FROM search_result""")
def q_url_parts(spark, sf_dir):
    full = F.concat("url", F.lit("?api_key="), "source", F.lit("&v=1"))
    return table(spark, sf_dir, "search_result").select("result_id", text.redacted(full).alias("redacted"), F.parse_url("url", F.lit("HOST")).alias("host"), F.substring_index("url", "/", -1).alias("last_segment"), text.masked(F.col("url")).alias("masked"))


@query("SELECT doc_id, md5(text) AS md5_hex, sha256(text) AS sha256_hex, substr(sha1(text), 1, 20) AS short_hash FROM documents WHERE text IS NOT NULL")
def q_hashes(spark, sf_dir):
    b = F.col("text").cast("binary")
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.md5(b).alias("md5_hex"), F.sha2(b, 256).alias("sha256_hex"), text.fingerprint_hash(F.col("text")).alias("short_hash"))


@query("SELECT DISTINCT feature_id, lower(split_part(genre_top, '---', -1)) AS leaf FROM track_features WHERE genre_top IS NOT NULL")
def q_genre_leaf(spark, sf_dir):
    return table(spark, sf_dir, "track_features").where("genre_top IS NOT NULL").select("feature_id", text.last_part(F.col("genre_top"), "---").alias("leaf")).distinct()


@query("SELECT track_id, (duration_sec // 60)::VARCHAR || ':' || lpad((duration_sec % 60)::VARCHAR, 2, '0') AS clock FROM audio_fingerprints WHERE duration_sec IS NOT NULL")
def q_minutes(spark, sf_dir):
    return table(spark, sf_dir, "audio_fingerprints").where("duration_sec IS NOT NULL").select("track_id", text.minutes_text(F.col("duration_sec")).alias("clock"))


# deduplication, heads, caps and sources

_CAND = f"candidate WHERE artist IS NOT NULL AND title IS NOT NULL AND trim(artist) <> '' AND trim(title) <> ''"


def _candidates(spark, sf_dir):
    c = table(spark, sf_dir, "candidate").where("trim(artist) <> '' AND trim(title) <> ''")
    return c.withColumn("norm_key", text.track_key(F.col("artist"), F.col("title")))


@query(f"SELECT row_ord, norm_key FROM (SELECT row_ord, norm_key, row_number() OVER (PARTITION BY norm_key ORDER BY src_ord, row_ord) AS rn FROM (SELECT *, {_key_sql()} AS norm_key FROM {_CAND})) WHERE rn = 1")
def q_dedup_first(spark, sf_dir):
    return rel.keep_first(_candidates(spark, sf_dir), ["norm_key"], ["src_ord", "row_ord"]).select("row_ord", "norm_key")


@query(f"SELECT row_ord, norm_key FROM (SELECT row_ord, src_ord, norm_key, row_number() OVER (PARTITION BY norm_key ORDER BY src_ord, row_ord) AS rn FROM (SELECT *, {_key_sql()} AS norm_key FROM {_CAND})) WHERE rn = 1 ORDER BY src_ord, row_ord LIMIT 30")
def q_dedup_cap(spark, sf_dir):
    first = rel.keep_first(_candidates(spark, sf_dir), ["norm_key"], ["src_ord", "row_ord"])
    return rel.capped(first, ["src_ord", "row_ord"], 30).select("row_ord", "norm_key")


@query("SELECT source, row_ord FROM (SELECT source, row_ord, row_number() OVER (PARTITION BY source ORDER BY row_ord) AS rn FROM candidate) WHERE rn <= 5")
def q_group_head(spark, sf_dir):
    return rel.head_of_groups(table(spark, sf_dir, "candidate"), ["source"], ["row_ord"], 5).select("source", "row_ord")


@query(f"SELECT row_ord FROM (SELECT row_ord, row_number() OVER (PARTITION BY safe ORDER BY row_ord) AS rn FROM (SELECT row_ord, lower(artist || ' ' || title) AS safe FROM {_CAND})) WHERE rn > 1")
def q_collision(spark, sf_dir):
    c = table(spark, sf_dir, "candidate").where("trim(artist) <> '' AND trim(title) <> ''").withColumn("safe", F.lower(F.concat_ws(" ", "artist", "title")))
    return rel.later_claims(c, ["safe"], ["row_ord"]).select("row_ord")


@query("SELECT coalesce(source, 'all') AS source, count(*) AS n, count(DISTINCT id) AS items FROM (SELECT coalesce(source, 'none') AS source, id FROM candidate) GROUP BY GROUPING SETS ((source), ())")
def q_source_contrib(spark, sf_dir):
    c = table(spark, sf_dir, "candidate").select(F.coalesce("source", F.lit("none")).alias("source"), "id")
    per = c.groupingSets([[F.col("source")], []], "source").agg(F.count("*").alias("n"), F.countDistinct("id").alias("items"))
    return per.select(F.coalesce("source", F.lit("all")).alias("source"), "n", "items")


@query("SELECT src_ord, count(*) AS n, count(title) AS titled FROM (SELECT 0 AS src_ord, artist, title FROM candidate UNION ALL SELECT 1, artist, title FROM redownload UNION ALL SELECT 2, artist, title FROM tracks) GROUP BY 1")
def q_union_sources(spark, sf_dir):
    frames = [table(spark, sf_dir, n).select("artist", "title") for n in ("candidate", "redownload", "tracks")]
    return rel.sources_union(frames).groupBy("src_ord").agg(F.count("*").alias("n"), F.count("title").alias("titled"))


# joins


@query(f"SELECT row_ord FROM (SELECT row_ord, {_key_sql()} AS k FROM {_CAND}) c WHERE NOT EXISTS (SELECT 1 FROM tracks t WHERE t.track_key = c.k)")
def q_library_anti(spark, sf_dir):
    return rel.not_in(_candidates(spark, sf_dir).withColumnRenamed("norm_key", "track_key"), table(spark, sf_dir, "tracks"), "track_key").select("row_ord")


@query("SELECT profile_id FROM taste_profile p WHERE EXISTS (SELECT 1 FROM tracks t WHERE lower(trim(t.artist)) = lower(trim(p.artist)))")
def q_prune_semi(spark, sf_dir):
    a = F.lower(F.trim("artist")).alias("a")
    return rel.only_in(table(spark, sf_dir, "taste_profile").select("profile_id", a), table(spark, sf_dir, "tracks").select(a), "a").select("profile_id")


@query("""
WITH f AS (SELECT lower(fingerprint_hash) AS h, track_id FROM audio_fingerprints), first AS (SELECT h, min(track_id) AS first_id, count(*) AS class_rows FROM f WHERE h IS NOT NULL GROUP BY h)
SELECT track_id, h, first_id, class_rows FROM f JOIN first USING (h)""")
def q_fp_classes(spark, sf_dir):
    f = table(spark, sf_dir, "audio_fingerprints").select(F.lower("fingerprint_hash").alias("h"), "track_id")
    return rel.duplicate_classes(f, "h", "track_id", ["track_id"]).select("track_id", "h", F.col("class_key").alias("first_id"), "class_rows")


@query("""
WITH one AS (SELECT track_id, min(lower(fingerprint_hash)) AS h FROM audio_fingerprints GROUP BY 1), lib AS (SELECT h, min(track_id) AS known FROM one JOIN (SELECT track_id FROM tracks WHERE batch_no = 0) USING (track_id) GROUP BY h)
SELECT t.track_id, coalesce(lib.known, -1) AS known FROM tracks t LEFT JOIN one USING (track_id) LEFT JOIN lib USING (h) WHERE t.batch_no > 0""")
def q_fp_lookup(spark, sf_dir):
    one = table(spark, sf_dir, "audio_fingerprints").groupBy("track_id").agg(F.min(F.lower("fingerprint_hash")).alias("h"))
    t = table(spark, sf_dir, "tracks").select("track_id", "batch_no").join(one, "track_id", "left")
    return rel.looked_up(t.where("batch_no > 0"), t.where("batch_no = 0 AND h IS NOT NULL"), "h", ["track_id"], "track_id", "known").select("track_id", F.coalesce("known", F.lit(-1)).alias("known"))


_SKELETON = "regexp_replace(lower(strip_accents(title)), '[^a-z0-9]', '', 'g')"


@query(f"""
WITH s AS (SELECT track_id, {_SKELETON} AS k FROM tracks), u AS (SELECT k, min(track_id) AS only_id FROM s WHERE k <> '' GROUP BY k HAVING count(*) = 1)
SELECT result_id, only_id FROM (SELECT result_id, {_SKELETON} AS k FROM search_result WHERE title IS NOT NULL) JOIN u USING (k)""")
def q_unique_match(spark, sf_dir):
    """Files are renamed on their way, so only what survives renaming is compared."""
    skeleton = text.skeleton(F.col("title")).alias("k")
    lib = table(spark, sf_dir, "tracks").select("track_id", skeleton).where("k <> ''")
    clips = table(spark, sf_dir, "search_result").where("title IS NOT NULL").select("result_id", skeleton)
    return rel.unique_match(clips, lib, "k", "track_id").where("track_id IS NOT NULL").select("result_id", F.col("track_id").alias("only_id"))


@query(f"""
WITH c AS (SELECT lookup_id, lower(trim(artist)) || '|' || lower(trim(title)) AS k, epoch(fetched_at) AS got FROM genre_result), fresh AS (SELECT DISTINCT k FROM c WHERE {NOW} - got <= 100 * 86400)
SELECT request_id, fresh.k IS NOT NULL AS hit FROM (SELECT request_id, lower(trim(artist)) || '|' || lower(trim(title)) AS k FROM redownload) r LEFT JOIN fresh USING (k)""")
def q_ttl_cache(spark, sf_dir):
    key = text.cache_key(F.col("artist"), F.col("title")).alias("k")
    cache = table(spark, sf_dir, "genre_result").select(key, "tags", (F.unix_micros(F.col("fetched_at").cast("timestamp")) / 1e6).alias("at"))
    asked = table(spark, sf_dir, "redownload").select("request_id", key)
    return rel.cached_or(asked, cache, "k", "tags", "at", NOW, 100 * 86400.0).select("request_id", "hit")


# tags and arrays

_TAGS = "list_filter(list_transform(tags, lambda x: lower(trim(x))), lambda x: x IS NOT NULL AND x <> '')"


@query(f"SELECT DISTINCT lookup_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS tags FROM (SELECT lookup_id, {_TAGS} AS l FROM genre_result WHERE tags IS NOT NULL)")
def q_tag_union(spark, sf_dir):
    g = table(spark, sf_dir, "genre_result").where("tags IS NOT NULL")
    return g.select("lookup_id", F.array_join(rel.ordered_distinct(F.col("tags")), "|").alias("tags")).distinct()


@query(f"SELECT DISTINCT lookup_id, list_filter(l, lambda x: list_contains({BLOCKED}, x))[1] AS first_blocked, len(list_distinct(l)) AS n_tags FROM (SELECT lookup_id, {_TAGS} AS l FROM genre_result WHERE tags IS NOT NULL)")
def q_blocklist(spark, sf_dir):
    g = table(spark, sf_dir, "genre_result").where("tags IS NOT NULL").withColumn("l", rel.ordered_distinct(F.col("tags")))
    return g.select("lookup_id", rel.first_blocked(F.col("l"), BLOCKED).alias("first_blocked"), F.size("l").cast("long").alias("n_tags")).distinct()


@query(f"SELECT DISTINCT lookup_id, l[1] AS top_tag, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:3], '|') AS head FROM (SELECT lookup_id, {_TAGS} AS l FROM genre_result WHERE tags IS NOT NULL)")
def q_top_tags(spark, sf_dir):
    g = table(spark, sf_dir, "genre_result").where("tags IS NOT NULL").withColumn("l", rel.ordered_distinct(F.col("tags")))
    return g.select("lookup_id", F.get("l", F.lit(0)).alias("top_tag"), F.array_join(F.slice("l", 1, 3), "|").alias("head")).distinct()


@query("""
WITH g AS (SELECT DISTINCT lookup_id, sources_hit AS s FROM genre_result WHERE sources_hit IS NOT NULL)
SELECT lookup_id, array_to_string(list_sort(list_filter(['lastfm', 'discogs', 'musicbrainz'], lambda x: NOT list_contains(s, x))), '|') AS missing, len(list_filter(list_distinct(s), lambda x: x NOT IN ('lastfm', 'discogs', 'musicbrainz'))) AS extra FROM g""")
def q_set_difference(spark, sf_dir):
    want = F.array(F.lit("lastfm"), F.lit("discogs"), F.lit("musicbrainz"))
    g = table(spark, sf_dir, "genre_result").where("sources_hit IS NOT NULL").select("lookup_id", "sources_hit").distinct()
    return g.select("lookup_id", F.array_join(F.array_sort(F.array_except(want, "sources_hit")), "|").alias("missing"), F.size(F.array_except("sources_hit", want)).cast("long").alias("extra"))


@query("SELECT DISTINCT feature_id, len(list_distinct(list_filter(list_transform(string_split(lower(lastfm_tags), ','), lambda x: trim(x, ' ')), lambda x: x <> ''))) AS n FROM track_features WHERE lastfm_tags IS NOT NULL")
def q_csv_tags(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("lastfm_tags IS NOT NULL")
    return t.select("feature_id", F.size(text.csv_set(F.col("lastfm_tags"))).cast("long").alias("n")).distinct()


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def q_json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k bigint, missing string"))
    return e.select("event_id", "p.k", "p.missing")


# filters with reasons

_REASON = "CASE WHEN duration > 0 AND duration < 120 THEN 'too short' WHEN duration > 330 THEN 'too long' WHEN bpm < 60 THEN 'too slow' WHEN bpm > 170 THEN 'too fast' END"


@query(f"SELECT DISTINCT feature_id, {_REASON} AS reason FROM track_features")
def q_reject_reason(spark, sf_dir):
    d, b = F.col("duration"), F.col("bpm")
    reason = rel.first_reason(((d > 0) & (d < 120), "too short"), (d > 330, "too long"), (b < 60, "too slow"), (b > 170, "too fast"))
    return table(spark, sf_dir, "track_features").select("feature_id", reason.alias("reason")).distinct()


#: Limits of the signals and what the genre and tag signals look for.
LOUD, SOLO, TENSE, DARK, BAD_GENRES, BAD_TAGS = 0.45, 0.9, 0.3, -0.2, ("night house", "slow wave"), ("trip hop", "ambient")


@query(f"""
WITH s AS (SELECT DISTINCT feature_id, coalesce(mood_aggressive, 0) AS m, coalesce(genre_top, '') AS g, coalesce(mood_aggressive, 0) > {LOUD} AS a, coalesce(arousal, 0) > {TENSE} AND coalesce(valence, 0) < {DARK} AS b, lower(split_part(coalesce(genre_top, ''), '---', -1)) IN {BAD_GENRES} AS c,
  len(list_filter(string_split(lower(coalesce(lastfm_tags, '')), ','), lambda x: trim(x, ' ') IN {BAD_TAGS})) > 0 AS d FROM track_features),
n AS (SELECT *, concat_ws(', ', CASE WHEN a THEN 'aggressive_ml' END, CASE WHEN b THEN 'arousal_valence' END, CASE WHEN c THEN 'genre_blocked' END, CASE WHEN d THEN 'lastfm_tags' END) AS signals, a::INT + b::INT + c::INT + d::INT AS k FROM s)
SELECT feature_id, signals, CASE WHEN NOT (m > 0 OR g <> '') THEN '' WHEN m > {SOLO} THEN 'aggressive_solo (' || printf('%.2f', m) || ')' WHEN k >= 2 THEN k || ' signals: ' || signals ELSE '' END AS reason FROM n""")
def q_multisignal(spark, sf_dir):
    """Four signals, of which two reject, or one alone if it is very strong; rows without any measurement pass."""
    t, v = table(spark, sf_dir, "track_features"), lambda c: F.coalesce(c, F.lit(0.0))
    tags = F.coalesce(text.csv_set(F.col("lastfm_tags")), F.array().cast("array<string>"))
    sig = {"aggressive_ml": v("mood_aggressive") > LOUD, "arousal_valence": (v("arousal") > TENSE) & (v("valence") < DARK), "genre_blocked": F.coalesce(text.last_part(F.col("genre_top"), "---"), F.lit("")).isin(*BAD_GENRES), "lastfm_tags": F.arrays_overlap(tags, F.array(*map(F.lit, BAD_TAGS)))}
    t = t.withColumn("found", F.array_compact(F.array(*[F.when(c, k) for k, c in sig.items()])))
    signals = F.array_join("found", ", ")
    gate = (v("mood_aggressive") > 0) | (F.coalesce("genre_top", F.lit("")) != "")
    reason = F.when(~gate, "").when(v("mood_aggressive") > SOLO, F.format_string("aggressive_solo (%.2f)", "mood_aggressive")).when(F.size("found") >= 2, F.concat(F.size("found").cast("string"), F.lit(" signals: "), signals)).otherwise("")
    return t.select("feature_id", signals.alias("signals"), reason.alias("reason")).distinct()


@query("SELECT result_id, CASE WHEN duration IS NULL OR duration <= 0 THEN 0.5 WHEN duration < 60 OR duration > 600 THEN 0.0 WHEN duration BETWEEN 120 AND 330 THEN 1.0 WHEN duration < 120 OR duration <= 480 THEN 0.8 ELSE 0.5 END::DOUBLE AS duration_score FROM search_result")
def q_duration_score(spark, sf_dir):
    return table(spark, sf_dir, "search_result").select("result_id", numbers.duration_score(F.col("duration")).alias("duration_score"))


_WANTED = "lower(coalesce(uploader, ''))"
_FACTOR = f"""
SELECT result_id, CASE WHEN len(list_filter({list(fuzzy.REJECTED)}, lambda k: contains(lower(title), k) AND NOT contains({_WANTED}, k))) > 0 THEN 0.0 ELSE least(1.0, {", ".join(f"CASE WHEN regexp_matches(lower(title), '(^|[^\\pL\\pN_]){k}($|[^\\pL\\pN_])') AND NOT contains({_WANTED}, '{k}') THEN {p} ELSE 1.0 END" for k, p in fuzzy.LOWERED.items())}) END::DOUBLE AS factor FROM search_result WHERE title IS NOT NULL"""


@query(_FACTOR)
def q_keyword_penalty(spark, sf_dir):
    """Words that rule a clip out or lower it, unless its uploader's name holds them."""
    s = table(spark, sf_dir, "search_result").where("title IS NOT NULL")
    return s.select("result_id", fuzzy.keyword_factor(F.col("title"), F.coalesce("uploader", F.lit(""))).alias("factor"))


@query("SELECT title, arg_max(result_id, (score, -result_id)) AS best_id, max(score) AS best_score FROM search_result WHERE title IS NOT NULL AND score >= 0.6 GROUP BY title")
def q_best_match(spark, sf_dir):
    s = table(spark, sf_dir, "search_result").where("title IS NOT NULL AND score >= 0.6")
    return s.groupBy("title").agg(F.max_by("result_id", F.struct("score", -F.col("result_id"))).alias("best_id"), F.max("score").alias("best_score"))


@query()
def q_fuzzy_match(spark, sf_dir):
    """The track of the best composite score of each clip, among those with which it shares a word of the artist and one of the title."""
    t = table(spark, sf_dir, "tracks").where("artist IS NOT NULL AND title IS NOT NULL").groupBy("artist", "title").agg(F.min("track_id").alias("track_id"))
    best = best_tracks(t, table(spark, sf_dir, "search_result").select("result_id", "title", "uploader", "channel", "duration"))
    return best.select("result_id", "track_id", F.round("score", 6).alias("score"))


# classes from numbers

_DEG = "CASE WHEN degrees(atan2(arousal, valence)) < 0 THEN degrees(atan2(arousal, valence)) + 360 ELSE degrees(atan2(arousal, valence)) END"
_MOOD = f"list_extract({list(numbers.MOODS)}, CAST(floor((({_DEG}) + 22.5) % 360 / 45) AS INT) + 1)"


@query(f"SELECT DISTINCT feature_id, {_MOOD} AS sector, round(least(0.98, 0.65 + 0.30 * least(1.0, sqrt(valence * valence + arousal * arousal)) + CASE WHEN abs(valence) > 0.7 OR abs(arousal) > 0.7 THEN 0.05 ELSE 0 END), 3) AS confidence FROM track_features WHERE valence IS NOT NULL AND arousal IS NOT NULL")
def q_mood(spark, sf_dir):
    v, a = F.col("valence"), F.col("arousal")
    return table(spark, sf_dir, "track_features").where("valence IS NOT NULL AND arousal IS NOT NULL").select("feature_id", numbers.mood(v, a).alias("sector"), numbers.mood_confidence(v, a).alias("confidence")).distinct()


@query(f"SELECT sector, count(*) AS n FROM (SELECT {_MOOD} AS sector FROM track_features WHERE valence IS NOT NULL AND arousal IS NOT NULL) GROUP BY 1")
def q_mood_hist(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("valence IS NOT NULL AND arousal IS NOT NULL")
    return t.groupBy(numbers.mood(F.col("valence"), F.col("arousal")).alias("sector")).agg(F.count("*").alias("n"))


_ENERGY = "CASE WHEN arousal < -0.6 THEN 'very_low' WHEN arousal < -0.2 THEN 'low' WHEN arousal < 0.2 THEN 'medium' WHEN arousal < 0.6 THEN 'high' WHEN arousal IS NOT NULL THEN 'very_high' END"


@query(f"SELECT DISTINCT feature_id, {_ENERGY} AS energy, greatest(-1.0, least(1.0, (bpm / 20.0 - 5) / 4)) AS rescaled FROM track_features WHERE bpm IS NOT NULL")
def q_energy(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("bpm IS NOT NULL")
    return t.select("feature_id", numbers.energy_level(F.col("arousal")).alias("energy"), numbers.rescaled(F.col("bpm") / 20.0).alias("rescaled")).distinct()


@query("SELECT artist, genre_top, model_mean FROM (SELECT artist, genre_top, model_mean, row_number() OVER (PARTITION BY artist ORDER BY model_mean DESC, genre_top) AS rn FROM (SELECT artist, genre_top, round(avg(genre_top_prob), 6) AS model_mean FROM track_features WHERE genre_top IS NOT NULL AND artist IS NOT NULL AND genre_top_prob IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1")
def q_argmax_class(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("genre_top IS NOT NULL AND artist IS NOT NULL AND genre_top_prob IS NOT NULL")
    mean = t.groupBy("artist", "genre_top").agg(F.round(F.avg("genre_top_prob"), 6).alias("model_mean"))
    best = mean.groupBy("artist").agg(F.min(F.struct((-F.col("model_mean")).alias("s"), "genre_top", "model_mean")).alias("b"))
    return best.select("artist", "b.genre_top", "b.model_mean")


@query("SELECT artist, round(avg(m) + 1e-9, 5) AS ensemble FROM (SELECT artist, origin, avg(valence) AS m FROM track_features WHERE valence IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def q_ensemble_mean(spark, sf_dir):
    per = table(spark, sf_dir, "track_features").where("valence IS NOT NULL").groupBy("artist", "origin").agg(F.avg("valence").alias("m"))
    return per.groupBy("artist").agg(F.round(F.avg("m") + 1e-9, 5).alias("ensemble"))


# dates


@query("SELECT event_id, CASE WHEN hour(ts) >= 5 AND hour(ts) < 9 THEN 'Dawn' WHEN hour(ts) >= 9 AND hour(ts) < 17 THEN 'Day' WHEN hour(ts) >= 17 AND hour(ts) < 22 THEN 'Dusk' ELSE 'Night' END AS part, CASE isodow(ts) WHEN 5 THEN 'friday' WHEN 6 THEN 'saturday' WHEN 7 THEN 'sunday' ELSE 'weekday' END AS day_type FROM events")
def q_hour_daypart(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", numbers.daypart(F.hour("ts")).alias("part"), numbers.day_type(F.col("ts")).alias("day_type"))


@query("SELECT event_id, (event_id % 4 <> 3)::INT * floor(epoch(ts))::DOUBLE AS at FROM events")
def q_played_at(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("t"))
    shown = F.when(F.col("event_id") % 4 == 0, F.unix_seconds("t").cast("string")).when(F.col("event_id") % 4 == 1, F.date_format("t", "yyyy-MM-dd'T'HH:mm:ssXXX")).when(F.col("event_id") % 4 == 2, F.date_format("t", "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    return e.select("event_id", numbers.epoch(shown).alias("at"))


@query("SELECT event_id, user_id, gap_min FROM (SELECT event_id, user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 60000000.0 AS gap_min FROM events) WHERE gap_min < 60")
def q_separation_gap(spark, sf_dir):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = (at - F.lag(at).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))) / 60000000.0
    return table(spark, sf_dir, "events").select("event_id", "user_id", gap.alias("gap_min")).where("gap_min < 60")


@query("""
WITH t AS (SELECT DISTINCT feature_id, artist, bpm, list_position(['very_low', 'low', 'medium', 'high', 'very_high'], energy_level) AS e FROM track_features WHERE artist IS NOT NULL AND energy_level IS NOT NULL AND bpm IS NOT NULL)
SELECT feature_id, coalesce(abs(e - lag(e) OVER w) <= 1, true) AS smooth, coalesce(abs(bpm - lag(bpm) OVER w) <= 25, true) AS steady FROM t WINDOW w AS (PARTITION BY artist ORDER BY feature_id)""")
def q_smooth_order(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("artist IS NOT NULL AND energy_level IS NOT NULL AND bpm IS NOT NULL").select("feature_id", "artist", "bpm", numbers.energy_ordinal(F.col("energy_level")).alias("e")).distinct()
    w = Window.partitionBy("artist").orderBy("feature_id")
    near = lambda c, n: F.coalesce(F.abs(F.col(c) - F.lag(c).over(w)) <= n, F.lit(True))
    return t.select("feature_id", near("e", 1).alias("smooth"), near("bpm", 25).alias("steady"))


@query("""
WITH p(name, a, b) AS (VALUES ('Dawn', 5, 9), ('Day', 9, 17), ('Dusk', 17, 22), ('Night', 22, 5)), d AS (SELECT unnest(generate_series(1, 7)) AS day)
SELECT name, day, a * 100 AS from_hhmm, CASE WHEN a < b THEN b * 100 ELSE 2400 END AS to_hhmm FROM p, d UNION ALL SELECT name, day % 7 + 1, 0, b * 100 FROM p, d WHERE a > b""")
def q_schedule(spark, sf_dir):
    """Weekly schedule of the parts of the day; one that runs over midnight has two rows."""
    p = spark.createDataFrame(numbers.DAYPARTS, "name string, a int, b int").withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(7))))
    first = p.select("name", "day", (F.col("a") * 100).alias("from_hhmm"), F.when(F.col("a") < F.col("b"), F.col("b") * 100).otherwise(2400).alias("to_hhmm"))
    second = p.where("a > b").select("name", (F.col("day") % 7 + 1).alias("day"), F.lit(0).alias("from_hhmm"), (F.col("b") * 100).alias("to_hhmm"))
    return first.unionByName(second)


# aggregates and reports


@query("SELECT source, count(*) AS total, count(*) FILTER (duration IS NULL OR duration <= 0) AS no_duration, count(*) FILTER (score >= 0.6) AS good, round(100.0 * count(*) FILTER (score >= 0.6) / count(*), 1) AS good_share FROM search_result GROUP BY source")
def q_status_counts(spark, sf_dir):
    s = table(spark, sf_dir, "search_result")
    good = F.count_if(F.col("score") >= 0.6)
    return s.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("duration").isNull() | (F.col("duration") <= 0)).alias("no_duration"), good.alias("good"), F.round(100.0 * good / F.count("*"), 1).alias("good_share"))


@query("PIVOT (SELECT event_type, user_id % 7 AS g FROM events) ON event_type IN ('click', 'view', 'purchase') USING count(*) GROUP BY g")
def q_outcome_pivot(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 7).alias("g"))
    return e.groupBy("g").pivot("event_type", ["click", "view", "purchase"]).agg(F.count(F.lit(1))).fillna(0)


@query(f"""
WITH t AS (SELECT ({NOW} - uploaded_at) / 86400.0 AS age, coalesce(play_count, 0) AS plays FROM tracks WHERE deleted_at IS NULL)
SELECT CASE WHEN sum(age) FILTER (age >= 1) < 30 THEN 0.65 ELSE greatest(0.2, least(3.0, sum(plays) FILTER (age >= 1) / sum(age) FILTER (age >= 1))) END::DOUBLE AS expected FROM t""")
def q_expected_rate(spark, sf_dir):
    t = table(spark, sf_dir, "tracks").where("deleted_at IS NULL").select(numbers.age_days(F.col("uploaded_at"), F.lit(NOW)).alias("age"), F.coalesce("play_count", F.lit(0)).alias("plays")).where("age >= 1")
    s = t.agg(F.sum("plays").alias("p"), F.sum("age").alias("a"))
    return s.select(F.when(F.col("a") < 30, 0.65).otherwise(F.greatest(F.lit(0.2), F.least(F.lit(3.0), F.col("p") / F.col("a")))).alias("expected"))


_AGE = f"CASE WHEN age <= 250 THEN 'fresh' WHEN age <= 500 THEN 'current' WHEN age <= 750 THEN 'fading' ELSE 'old' END"


@query(f"SELECT name, count(age) AS n FROM (VALUES ('fresh'), ('current'), ('fading'), ('old'), ('none')) d(name) LEFT JOIN (SELECT ({NOW} - uploaded_at) / 86400.0 AS age, {_AGE.replace('age', f'(({NOW} - uploaded_at) / 86400.0)')} AS cls FROM tracks WHERE uploaded_at IS NOT NULL) ON cls = name GROUP BY name")
def q_age_hist(spark, sf_dir):
    """Rows per age class, classes without rows included."""
    age = numbers.age_days(F.col("uploaded_at"), F.lit(NOW))
    n = table(spark, sf_dir, "tracks").where("uploaded_at IS NOT NULL").groupBy(numbers.step_class(age, [("fresh", 250), ("current", 500), ("fading", 750)], "old").alias("name")).agg(F.count("*").alias("n"))
    dim = spark.createDataFrame([(c,) for c in ("fresh", "current", "fading", "old", "none")], "name string")
    return dim.join(n, "name", "left").fillna(0, ["n"])


@query(f"SELECT track_id, CASE WHEN age < 200 THEN 'HEAVY' WHEN rate >= 0.02 * 1.2 THEN 'HEAVY' WHEN rate >= 0.02 * 0.6 THEN 'MEDIUM' ELSE 'LIGHT' END AS rate_class FROM (SELECT track_id, ({NOW} - uploaded_at) / 86400.0 AS age, coalesce(play_count, 0) / greatest(1.0, ({NOW} - uploaded_at) / 86400.0) AS rate FROM tracks)")
def q_rate_class(spark, sf_dir):
    age = numbers.age_days(F.col("uploaded_at"), F.lit(NOW))
    return table(spark, sf_dir, "tracks").select("track_id", numbers.rate_class(F.coalesce("play_count", F.lit(0)), age, F.lit(0.02), 200).alias("rate_class"))


@query("SELECT strftime(day, '%Y-%m-%d') AS day, n FROM (SELECT day, n, row_number() OVER (ORDER BY day DESC) AS rn FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)) WHERE rn <= 30")
def q_ring_buffer(spark, sf_dir):
    """The last 30 days: one row a day, cut by per-task heaps."""
    days = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return rel.capped(days, [F.desc("day")], 30).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


@query("SELECT user_id, count(*) AS plays, max(epoch_us(ts)) / 1000000.0 AS cursor FROM events WHERE epoch_us(ts) / 1000000.0 > 1704500000 GROUP BY user_id")
def q_play_sync(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0)
    return rel.after_cursor(e, "at", 1704500000.0).groupBy("user_id").agg(F.count("*").alias("plays"), F.max("at").alias("cursor"))


@query("SELECT t.track_id, coalesce(play_count, 0) + coalesce(n, 0) AS play_count FROM tracks t LEFT JOIN (SELECT user_id AS track_id, count(*) AS n FROM events GROUP BY 1) USING (track_id)")
def q_counter_update(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("track_id"))
    return rel.counted(table(spark, sf_dir, "tracks").select("track_id", "play_count"), e, "track_id", "play_count")


@query("""
WITH o AS (SELECT track_key, min(artist) AS artist, max(uploaded_at) AS uploaded_at FROM tracks WHERE batch_no = 0 GROUP BY 1), n AS (SELECT track_key, arg_max(artist, (uploaded_at, track_id)) AS artist, arg_max(uploaded_at, (uploaded_at, track_id)) AS uploaded_at FROM tracks WHERE batch_no > 0 GROUP BY 1)
SELECT track_key, coalesce(o.artist, n.artist) AS artist, coalesce(n.uploaded_at, o.uploaded_at) AS uploaded_at FROM o FULL JOIN n USING (track_key)""")
def q_upsert(spark, sf_dir):
    t = table(spark, sf_dir, "tracks")
    old = t.where("batch_no = 0").groupBy("track_key").agg(F.min("artist").alias("artist"), F.max("uploaded_at").alias("uploaded_at"))
    return rel.upserted(old, t.where("batch_no > 0"), "track_key", ["artist"], ["uploaded_at"], ["uploaded_at", "track_id"])


@query(f"SELECT track_id, CASE WHEN r.k IS NOT NULL THEN {NOW} ELSE deleted_at END AS deleted_at, coalesce(CASE WHEN r.k IS NULL THEN azuracast_file_id END, -1) AS azuracast_file_id FROM tracks LEFT JOIN (SELECT DISTINCT track_key AS k FROM audio_fingerprints WHERE duration_sec < 150) r ON r.k = track_key")
def q_soft_delete(spark, sf_dir):
    gone = table(spark, sf_dir, "audio_fingerprints").where("duration_sec < 150")
    t = table(spark, sf_dir, "tracks").select("track_id", "track_key", "deleted_at", "azuracast_file_id")
    return rel.soft_deleted(t, gone, "track_key", "deleted_at", NOW, ["azuracast_file_id"]).drop("track_key").fillna(-1, ["azuracast_file_id"])


@query("SELECT track_id FROM tracks WHERE azuracast_file_id IS NOT NULL AND deleted_at IS NULL AND mood IS NULL")
def q_active_without_mood(spark, sf_dir):
    return table(spark, sf_dir, "tracks").where("azuracast_file_id IS NOT NULL AND deleted_at IS NULL AND mood IS NULL").select("track_id")


@query("""
SELECT 'no title' AS problem, count(*) AS n FROM search_result WHERE title IS NULL UNION ALL SELECT 'no duration', count(*) FROM search_result WHERE duration IS NULL OR duration <= 0
UNION ALL SELECT 'score out of range', count(*) FROM search_result WHERE score NOT BETWEEN 0 AND 1 UNION ALL SELECT 'no uploader', count(*) FROM search_result WHERE uploader IS NULL OR trim(uploader) = ''""")
def q_validation(spark, sf_dir):
    """Rows that break each rule, in one scan."""
    rules = {"no title": "title IS NULL", "no duration": "duration IS NULL OR duration <= 0", "score out of range": "score NOT BETWEEN 0 AND 1", "no uploader": "uploader IS NULL OR trim(uploader) = ''"}
    one = table(spark, sf_dir, "search_result").agg(*[F.count_if(F.expr(c)).alias(k) for k, c in rules.items()])
    return one.select(F.explode(F.create_map(*[x for k in rules for x in (F.lit(k), F.col(f"`{k}`"))])).alias("problem", "n"))


@query("SELECT 'tracks ' || count(*) || chr(10) || 'deleted ' || count(deleted_at) || chr(10) || 'plays ' || coalesce(sum(play_count), 0)::BIGINT AS message FROM tracks")
def q_recap(spark, sf_dir):
    c = table(spark, sf_dir, "tracks").agg(F.count("*").alias("a"), F.count("deleted_at").alias("b"), F.coalesce(F.sum("play_count"), F.lit(0)).alias("c"))
    return c.select(F.concat_ws("\n", F.concat(F.lit("tracks "), "a"), F.concat(F.lit("deleted "), "b"), F.concat(F.lit("plays "), "c")).alias("message"))


@query("SELECT origin, count(duration) AS n, min(duration) AS least, quantile_cont(duration, 0.05) AS p5, quantile_cont(duration, 0.5) AS median, quantile_cont(duration, 0.95) AS p95, max(duration) AS most FROM track_features WHERE duration > 0 GROUP BY origin")
def q_percentiles(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("duration > 0")
    return rel.exact_percentiles(t, ["origin"], "duration", {"p5": 0.05, "median": 0.5, "p95": 0.95})


# samples and orders


@query("SELECT profile_id FROM (SELECT profile_id, row_number() OVER (PARTITION BY artist ORDER BY depth, album, path, profile_id) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY artist, album ORDER BY path, profile_id) AS depth FROM (SELECT profile_id, artist, path, split_part(path, '/', 4) AS album FROM taste_profile WHERE artist IS NOT NULL AND path IS NOT NULL))) WHERE turn <= 2")
def q_round_robin(spark, sf_dir):
    t = table(spark, sf_dir, "taste_profile").where("artist IS NOT NULL AND path IS NOT NULL").select("profile_id", "artist", "path", F.get(F.split("path", "/"), F.lit(3)).alias("album"))
    return rel.round_robin(t, "artist", "album", ["path", "profile_id"], 2).select("profile_id")


@query("WITH r AS (SELECT track_id, row_number() OVER (ORDER BY track_id) - 1 AS i, count(*) OVER () AS n FROM tracks) SELECT track_id FROM r WHERE i % greatest(1, n // 50) = 0 AND i < greatest(1, n // 50) * 50")
def q_stride(spark, sf_dir):
    return rel.strided(table(spark, sf_dir, "tracks").select("track_id"), ["track_id"], 50)


@query("WITH a AS (SELECT DISTINCT artist FROM tracks WHERE artist IS NOT NULL), r AS (SELECT artist, row_number() OVER (ORDER BY artist) - 1 AS i, count(*) OVER () AS n FROM a) SELECT artist FROM r WHERE ((i - 7) % n + n) % n < 5")
def q_seed_rotation(spark, sf_dir):
    return rel.rotated(table(spark, sf_dir, "tracks").select("artist").where("artist IS NOT NULL").distinct(), ["artist"], 7, 5)[0]


# vectors

_DOT = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query(f"SELECT b.vec_id, round({_DOT}, 6) AS similarity FROM embeddings a, embeddings b WHERE a.vec_id = (SELECT min(vec_id) FROM embeddings) AND b.vec_id <> a.vec_id ORDER BY {_DOT} DESC, b.vec_id LIMIT 10")
def q_nearest(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    seed = e.agg(F.min("vec_id")).collect()[0][0]
    return vectors.nearest(e, "vec_id", "embedding", seed, 10).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(f"WITH s AS (SELECT b.vec_id, b.label, {_DOT} AS d FROM embeddings a, embeddings b WHERE a.vec_id = (SELECT min(vec_id) FROM embeddings) AND b.vec_id <> a.vec_id ORDER BY d DESC, b.vec_id LIMIT 40) SELECT vec_id, round(d, 6) AS similarity FROM s WHERE label = 1 ORDER BY d DESC, vec_id LIMIT 10")
def q_nearest_overfetch(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    seed = e.agg(F.min("vec_id")).collect()[0][0]
    return vectors.nearest(e, "vec_id", "embedding", seed, 10, e.where("label = 1"), overfetch=True).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query()
def q_walk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return vectors.walk(e, "vec_id", "embedding", e.agg(F.min("vec_id")).collect()[0][0], 8)


_TASTE = f"SELECT vec_id, round(avg(d), 6) AS score FROM (SELECT b.vec_id, {_DOT} AS d, row_number() OVER (PARTITION BY b.vec_id ORDER BY {_DOT} DESC) AS rn FROM embeddings a, embeddings b WHERE a.label = 0 AND b.label <> 0) WHERE rn <= 5 GROUP BY 1"


@query(_TASTE)
def q_taste_score(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return vectors.best_mean(e.where("label <> 0"), e.where("label = 0"), "vec_id", "embedding", 5).select("vec_id", F.round("score", 6).alias("score"))


@query(f"SELECT vec_id, score FROM ({_TASTE}) WHERE score < 0.2")
def q_off_taste(spark, sf_dir):
    return q_taste_score(spark, sf_dir).where("score < 0.2")


@query("SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS length, round(embedding[1]::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS first FROM embeddings")
def q_unit_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(F.sqrt(numbers.dot(F.col("embedding"), F.col("embedding"))), 5).alias("length"), F.round(F.get(numbers.unit(F.col("embedding")), F.lit(0)), 5).alias("first"))


# streams


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def s_tumbling(spark, sf_dir):
    return streams.tumbling_counts(spark, sf_dir)


@query("SELECT s AS slide_start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) GROUP BY 1")
def s_sliding(spark, sf_dir):
    return streams.sliding_counts(spark, sf_dir)


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events), i AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM i GROUP BY user_id, s""")
def s_session(spark, sf_dir):
    return streams.sessions(spark, sf_dir)


@query("SELECT user_id, event_type, count(*) AS first_rows FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY 1, 2")
def s_dedup(spark, sf_dir):
    return streams.first_per_day(spark, sf_dir)


@query("SELECT user_id, count(*) AS plays, max(ts) AS last_ts FROM events GROUP BY 1")
def s_play_counts(spark, sf_dir):
    return streams.play_counts(spark, sf_dir)


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, count(*) AS n, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1")
def s_lifecycle(spark, sf_dir):
    return streams.lifecycle(spark, sf_dir)


# dimensions, status rules, quotas and membership changes

#: The moods that each part of the day asks for.
MOODS_OF_PART = (
    ("Dawn", ("Calm", "Relaxed")),
    ("Day", ("Energetic", "Excited", "Relaxed", "Melancholic")),
    ("Dusk", ("Relaxed", "Melancholic", "Sad", "Angry")),
    ("Night", ("Calm", "Sad", "Melancholic", "Intense", "Angry")),
)


def parts_of_moods(spark: SparkSession) -> DataFrame:
    """(mood, part, place): the parts of the day that take a mood, in the day's order; a dimension of a few rows."""
    d = spark.createDataFrame([(i, p, list(ms)) for i, (p, ms) in enumerate(MOODS_OF_PART)], "ord int, part string, moods array<string>").select("ord", "part", F.explode("moods").alias("mood"))
    return d.withColumn("place", F.row_number().over(Window.partitionBy("mood").orderBy("ord"))).select("mood", "part", "place")


_PARTS_SQL = "SELECT mood, part, row_number() OVER (PARTITION BY mood ORDER BY ord) AS place FROM (VALUES " + ", ".join(f"({i}, '{p}', '{m}')" for i, (p, ms) in enumerate(MOODS_OF_PART) for m in ms) + ") v(ord, part, mood)"


@query("WITH p(name, a, b) AS (VALUES ('Dawn', 5, 9), ('Day', 9, 17), ('Dusk', 17, 22), ('Night', 22, 5)) SELECT name, count(*) AS n, count(DISTINCT user_id) AS users FROM events JOIN p ON (a < b AND hour(ts) >= a AND hour(ts) < b) OR (a > b AND (hour(ts) >= a OR hour(ts) < b)) GROUP BY name")
def q_hour_join(spark, sf_dir):
    """Range join with wrap-around as an equi-join on a dimension of 24 hours, so nothing is compared row by row."""
    p = spark.createDataFrame(numbers.DAYPARTS, "name string, a int, b int")
    hours = p.select("name", F.explode(F.when(F.col("a") < F.col("b"), F.sequence("a", F.col("b") - 1)).otherwise(F.concat(F.sequence("a", F.lit(23)), F.sequence(F.lit(0), F.col("b") - 1)))).alias("h"))
    e = table(spark, sf_dir, "events").select("user_id", F.hour("ts").alias("h"))
    return e.join(F.broadcast(hours), "h").groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query(f"SELECT part, place, count(*) AS n FROM (SELECT DISTINCT feature_id, mood FROM track_features) JOIN ({_PARTS_SQL}) USING (mood) GROUP BY 1, 2")
def q_mood_daypart(spark, sf_dir):
    """Many-to-many dimension join that keeps the order of each list."""
    t = table(spark, sf_dir, "track_features").select("feature_id", "mood").distinct()
    return t.join(F.broadcast(parts_of_moods(spark)), "mood").groupBy("part", "place").agg(F.count("*").alias("n"))


@query("SELECT status, count(*) AS n, round(avg(duration), 3) AS mean FROM (SELECT duration, CASE WHEN duration IS NULL THEN 'unknown' WHEN duration <= 0 THEN 'invalid' WHEN duration < 60 THEN 'truncated' WHEN duration > 600 THEN 'oversized' ELSE 'ok' END AS status FROM search_result) GROUP BY status")
def q_probe_status(spark, sf_dir):
    d = F.col("duration")
    status = F.coalesce(rel.first_reason((d.isNull(), "unknown"), (d <= 0, "invalid"), (d < 60, "truncated"), (d > 600, "oversized")), F.lit("ok"))
    return table(spark, sf_dir, "search_result").groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.round(F.avg("duration"), 3).alias("mean"))


@query("SELECT source, result_id, CASE WHEN rn <= 6 THEN 'kept' ELSE 'carried' END AS state FROM (SELECT source, result_id, row_number() OVER (PARTITION BY source ORDER BY coalesce(score, -1) DESC, result_id) AS rn FROM search_result) WHERE rn <= 30")
def q_ranked_quota(spark, sf_dir):
    """The best six of each source are kept, the next 24 carried over; missing scores rank last."""
    top = rel.head_of_groups(table(spark, sf_dir, "search_result").withColumn("s", F.coalesce("score", F.lit(-1.0))), ["source"], [F.desc("s"), "result_id"], 30)
    rn = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("s"), "result_id"))
    return top.select("source", "result_id", F.when(rn <= 6, "kept").otherwise("carried").alias("state"))


@query(f"WITH s AS ({_TASTE}), l AS (SELECT label, score FROM s JOIN embeddings USING (vec_id)) SELECT round(quantile_cont(score, 0.05) FILTER (label = 1) - max(score) FILTER (label = 2), 5) AS margin FROM l")
def q_margin(spark, sf_dir):
    """Distance of the low end of one class from the high end of another."""
    s = vectors.best_mean(table(spark, sf_dir, "embeddings").where("label <> 0"), table(spark, sf_dir, "embeddings").where("label = 0"), "vec_id", "embedding", 5)
    s = s.join(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id").select("label", F.round("score", 6).alias("score"))
    return s.agg(F.round(F.percentile(F.when(F.col("label") == 1, F.col("score")), 0.05) - F.max(F.when(F.col("label") == 2, F.col("score"))), 5).alias("margin"))


@query("""
WITH a AS (SELECT track_key, min(mood) AS mood, min(bpm) AS bpm FROM track_features WHERE origin = 'analysis' GROUP BY 1), i AS (SELECT track_key, min(mood) AS mood, min(bpm) AS bpm FROM track_features WHERE origin = 'id3' GROUP BY 1)
SELECT track_key, coalesce(i.mood, a.mood) AS mood, coalesce(i.bpm, a.bpm) AS bpm, i.track_key IS NULL AS computed FROM a LEFT JOIN i USING (track_key)""")
def q_reuse_or_compute(spark, sf_dir):
    """Values read back from a file where there are any, else those computed."""
    t = table(spark, sf_dir, "track_features")
    one = lambda o: t.where(F.col("origin") == o).groupBy("track_key").agg(F.min("mood").alias("mood"), F.min("bpm").alias("bpm"))
    back = one("id3").select("track_key", F.col("mood").alias("m"), F.col("bpm").alias("b"), F.lit(True).alias("had"))
    j = one("analysis").join(back, "track_key", "left")
    return j.select("track_key", F.coalesce("m", "mood").alias("mood"), F.coalesce("b", "bpm").alias("bpm"), F.col("had").isNull().alias("computed"))


@query(f"""
WITH g AS (SELECT lookup_id, artist, list_sort(list_distinct({_TAGS})) AS l FROM (SELECT DISTINCT lookup_id, artist, tags FROM genre_result WHERE tags IS NOT NULL AND artist IS NOT NULL)),
w AS (SELECT lookup_id, l, coalesce(lag(l) OVER (PARTITION BY artist ORDER BY lookup_id), []::VARCHAR[]) AS p FROM g)
SELECT lookup_id, len(list_filter(l, lambda x: NOT list_contains(p, x))) AS added, len(list_filter(p, lambda x: NOT list_contains(l, x))) AS removed, l = p AS same FROM w""")
def q_membership_change(spark, sf_dir):
    """Tags added and removed since the artist's previous look-up; equal sets need no write."""
    g = table(spark, sf_dir, "genre_result").where("tags IS NOT NULL AND artist IS NOT NULL").select("lookup_id", "artist", "tags").distinct()
    g = g.select("lookup_id", "artist", F.array_sort(rel.ordered_distinct(F.col("tags"))).alias("l"))
    p = F.coalesce(F.lag("l").over(Window.partitionBy("artist").orderBy("lookup_id")), F.array().cast("array<string>"))
    return g.withColumn("p", p).select("lookup_id", F.size(F.array_except("l", "p")).cast("long").alias("added"), F.size(F.array_except("p", "l")).cast("long").alias("removed"), (F.col("l") == F.col("p")).alias("same"))


@query(r"SELECT host, count(*) AS n, count(*) FILTER (safe) AS allowed FROM (SELECT split_part(split_part(u, '://', 2), '/', 1) AS host, starts_with(u, 'https://') OR regexp_matches(u, '^http://(localhost|127\.0\.0\.1)(:[0-9]+)?/') AS safe FROM (SELECT CASE WHEN result_id % 3 = 0 THEN replace(url, 'https://', 'http://') ELSE url END AS u FROM search_result WHERE url IS NOT NULL)) GROUP BY host")
def q_url_policy(spark, sf_dir):
    """Encrypted links, or plain ones to this machine only."""
    s = table(spark, sf_dir, "search_result").where("url IS NOT NULL").select(F.when(F.col("result_id") % 3 == 0, F.replace("url", F.lit("https://"), F.lit("http://"))).otherwise(F.col("url")).alias("u"))
    safe = F.col("u").startswith("https://") | F.col("u").rlike(r"^http://(localhost|127\.0\.0\.1)(:[0-9]+)?/")
    return s.groupBy(F.parse_url("u", F.lit("HOST")).alias("host")).agg(F.count("*").alias("n"), F.count_if(safe).alias("allowed"))


@query("SELECT coalesce(origin, 'all') AS origin, coalesce(mood, 'all') AS mood, count(*) AS n FROM (SELECT coalesce(origin, 'none') AS origin, coalesce(mood, 'none') AS mood FROM track_features) GROUP BY CUBE (origin, mood)")
def q_cube(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").select(F.coalesce("origin", F.lit("none")).alias("origin"), F.coalesce("mood", F.lit("none")).alias("mood"))
    return t.cube("origin", "mood").agg(F.count("*").alias("n")).select(F.coalesce("origin", F.lit("all")).alias("origin"), F.coalesce("mood", F.lit("all")).alias("mood"), "n")


@query("SELECT k, count(*) AS n FROM (SELECT lower(trim(search)) AS k FROM redownload r WHERE search IS NOT NULL AND NOT EXISTS (SELECT 1 FROM candidate c WHERE lower(trim(c.search)) = lower(trim(r.search)))) GROUP BY k")
def q_queue_append(spark, sf_dir):
    """Requests whose search text isn't queued yet."""
    k = F.lower(F.trim("search")).alias("k")
    new = rel.not_in(table(spark, sf_dir, "redownload").where("search IS NOT NULL").select(k), table(spark, sf_dir, "candidate").where("search IS NOT NULL").select(k), "k")
    return new.groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS customer, count(*) AS orders, sum(n)::BIGINT AS lines, round(sum(o_totalprice), 2) AS total FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1")
def q_library_lines(spark, sf_dir):
    """Lines are counted before the join, so only one row an order is shuffled."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").join(lines, "o_orderkey").groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("orders"), F.sum("n").alias("lines"), F.round(F.sum("o_totalprice"), 2).alias("total"))
