"""Queries over the library's store, listings, playlists, tags, audits and state, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from crateflow.functions import numbers, text
from crateflow.operators import audits, state, tags, vectors
from crateflow.operators import relations as rel
from crateflow.plans.catalogue import _CAND, _PARTS_SQL, _TAGS, BLOCKED, NOW, _key_sql, cleaned_sql, decoded_sql, parts_of_moods, query
from crateflow.session import scratch_path, table
from crateflow.sources import readers, sinks

# names and texts


@query("SELECT track_id, trim(regexp_replace(regexp_replace(lower(strip_accents(artist)), '[^\\pL\\pN_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS artist_text FROM tracks")
def q_artist_text(spark, sf_dir):
    return table(spark, sf_dir, "tracks").select("track_id", text.artist_text(F.col("artist")).alias("artist_text"))


_NOISE_SQL = "[(\\[](" + "|".join(n.replace(" ", "\\s*") for n in text.NOISE) + ")[)\\]]"


@query(f"SELECT result_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(title)), '{_NOISE_SQL}', '', 'g'), '\\b(feat\\.?|ft\\.?|featuring)\\b', 'feat', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS clip_text FROM search_result")
def q_match_text(spark, sf_dir):
    return table(spark, sf_dir, "search_result").select("result_id", text.match_text(F.col("title")).alias("clip_text"))


@query(f"SELECT row_ord, CASE WHEN trim(artist) <> '' AND trim(title) <> '' THEN {_key_sql()} END AS file_key FROM candidate")
def q_file_key(spark, sf_dir):
    return table(spark, sf_dir, "candidate").select("row_ord", text.file_key(F.col("artist"), F.col("title")).alias("file_key"))


@query("SELECT row_ord, replace(cover, '100x100', '600x600') AS large, 'source_' || coalesce(source, 'unknown') AS bucket FROM candidate")
def q_cover_and_bucket(spark, sf_dir):
    c = table(spark, sf_dir, "candidate")
    return c.select("row_ord", text.resized(F.col("cover"), 100, 600).alias("large"), F.concat(F.lit("source_"), F.coalesce("source", F.lit("unknown"))).alias("bucket"))


@query(r"SELECT doc_id, array_to_string(list_filter(string_split(lower(text), chr(10)), lambda l: regexp_matches(l, 'error|warn|fail'))[1:3], '; ') AS errors FROM documents WHERE text IS NOT NULL")
def q_error_lines(spark, sf_dir):
    """The first three lines that tell of an error."""
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", audits.error_lines(F.lower("text"), "error|warn|fail", 3).alias("errors"))


# predicates

_COOL = 400


@query(f"SELECT row_ord FROM (SELECT row_ord, {_key_sql()} AS k FROM {_CAND}) c WHERE EXISTS (SELECT 1 FROM tracks t WHERE t.track_key = c.k AND t.deleted_at IS NOT NULL AND {NOW} - t.deleted_at < {_COOL} * 86400)")
def q_cooldown(spark, sf_dir):
    """Candidates whose track was deleted too short a time ago."""
    c = table(spark, sf_dir, "candidate").select("row_ord", text.file_key(F.col("artist"), F.col("title")).alias("track_key"))
    gone = table(spark, sf_dir, "tracks").where(state.in_cooldown(F.col("deleted_at"), NOW, _COOL))
    return rel.only_in(c, gone, "track_key").select("row_ord")


@query(f"""
SELECT DISTINCT lookup_id, CASE WHEN len({_TAGS}) = 0 THEN 'no tags' WHEN len(list_filter({_TAGS}, lambda x: list_contains({BLOCKED}, x))) > 0 THEN 'blocked: ' || list_filter({_TAGS}, lambda x: list_contains({BLOCKED}, x))[1] END AS reason FROM (SELECT lookup_id, coalesce(tags, []) AS tags FROM genre_result)""")
def q_tag_gate(spark, sf_dir):
    """Tags are asked for; then the first blocked one rejects."""
    g = table(spark, sf_dir, "genre_result").select("lookup_id", rel.ordered_distinct(F.coalesce("tags", F.array().cast("array<string>"))).alias("l"))
    bad = rel.first_blocked(F.col("l"), BLOCKED)
    return g.select("lookup_id", rel.first_reason((F.size("l") == 0, "no tags"), (bad.isNotNull(), F.concat(F.lit("blocked: "), bad))).alias("reason")).distinct()


@query("""
SELECT DISTINCT feature_id, CASE WHEN duration > 0 AND duration <= 120 THEN 'too short' WHEN duration >= 330 THEN 'too long' WHEN voice_probability > 0.7 THEN 'speech' WHEN bpm > 0 AND bpm < 60 THEN 'too slow' WHEN bpm > 170 THEN 'too fast' WHEN mood_confidence < 0.3 THEN 'unsure' END AS reason FROM track_features""")
def q_audio_gate(spark, sf_dir):
    """Ordered reasons: inclusive bounds of the duration, unless it is unknown, speech, tempo, confidence."""
    d, b, v, m = (F.col(c) for c in ("duration", "bpm", "voice_probability", "mood_confidence"))
    reason = rel.first_reason(((d > 0) & (d <= 120), "too short"), (d >= 330, "too long"), (v > 0.7, "speech"), ((b > 0) & (b < 60), "too slow"), (b > 170, "too fast"), (m < 0.3, "unsure"))
    return table(spark, sf_dir, "track_features").select("feature_id", reason.alias("reason")).distinct()


@query("SELECT row_ord FROM candidate WHERE coalesce(trim(cover), '') = '' AND trim(artist) <> '' AND trim(title) <> ''")
def q_missing_art(spark, sf_dir):
    return table(spark, sf_dir, "candidate").where("coalesce(trim(cover), '') = '' AND trim(artist) <> '' AND trim(title) <> ''").select("row_ord")


_LOCAL = "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, strlen(text) AS size FROM documents WHERE text IS NOT NULL"
_REMOTE = f"""SELECT doc_id, md5, sha256, size, CASE doc_id % 4 WHEN 0 THEN upper(md5) WHEN 1 THEN 'short' WHEN 2 THEN md5(md5) END AS unique_id, CASE WHEN doc_id % 5 = 0 THEN size + 1 WHEN doc_id % 5 < 3 THEN size END AS r_size,
CASE WHEN doc_id % 7 = 0 THEN md5(sha256) WHEN doc_id % 7 = 1 THEN upper(md5) END AS r_md5, CASE WHEN doc_id % 11 = 0 THEN sha256(md5) WHEN doc_id % 11 < 4 THEN sha256 END AS r_sha FROM ({_LOCAL})"""


@query(f"""SELECT doc_id, NOT (coalesce(r_size <> 0 AND r_size <> size, false) OR coalesce(length(unique_id) = 32 AND lower(unique_id) <> md5, false) OR coalesce(lower(r_md5) <> md5, false) OR coalesce(lower(r_sha) <> sha256, false)) AS intact FROM ({_REMOTE})""")
def q_upload_integrity(spark, sf_dir):
    """What a service tells of an uploaded file against the file; what it doesn't tell passes."""
    b = F.col("text").cast("binary")
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.md5(b).alias("md5"), F.sha2(b, 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"))
    m = lambda n: F.col("doc_id") % n
    hashed = lambda c: F.col(c).cast("binary")
    d = d.withColumns({
        "unique_id": F.when(m(4) == 0, F.upper("md5")).when(m(4) == 1, "short").when(m(4) == 2, F.md5(hashed("md5"))), "r_size": F.when(m(5) == 0, F.col("size") + 1).when(m(5) < 3, F.col("size")),
        "r_md5": F.when(m(7) == 0, F.md5(hashed("sha256"))).when(m(7) == 1, F.upper("md5")), "r_sha": F.when(m(11) == 0, F.sha2(hashed("md5"), 256)).when(m(11) < 4, F.col("sha256")),
    })
    ok = audits.same_upload(F.col("size"), F.col("md5"), F.col("sha256"), F.col("r_size"), F.col("unique_id"), F.col("r_md5"), F.col("r_sha"))
    return d.select("doc_id", ok.alias("intact"))


_CODEC = "CASE result_id % 8 WHEN 0 THEN 'mp3' WHEN 1 THEN 'aac' WHEN 2 THEN 'flac' WHEN 3 THEN 'vorbis' WHEN 4 THEN 'opus' WHEN 5 THEN 'pcm_s16le' WHEN 6 THEN 'wmav2' END"
_ERR = "CASE WHEN result_id % 9 = 0 THEN 'ok' || chr(10) || 'Error one' || chr(10) || 'stream corrupt' END"


@query(f"""
SELECT result_id, CASE WHEN size < 10240 THEN 'File too small (< 10KB)' WHEN codec IS NULL THEN 'No audio stream found' WHEN codec NOT IN ('mp3', 'aac', 'flac', 'vorbis', 'opus', 'pcm_s16le') THEN 'Unexpected audio codec: ' || codec WHEN coalesce(duration, 0) <= 0 THEN 'Invalid duration (0 or negative)' WHEN err IS NOT NULL THEN 'Decode errors: Error one; stream corrupt' ELSE '' END AS problem
FROM (SELECT result_id, duration, result_id % 40000 AS size, {_CODEC} AS codec, {_ERR} AS err FROM search_result)""")
def q_download_validity(spark, sf_dir):
    s = table(spark, sf_dir, "search_result").select("result_id", "duration", (F.col("result_id") % 40000).alias("size"), F.expr(_CODEC).alias("codec"), F.expr(_ERR.replace("chr(10)", "char(10)")).alias("err"))
    return s.select("result_id", audits.download_problem(F.col("size"), F.col("codec"), F.col("duration"), F.col("err")).alias("problem"))


@query("""
WITH s AS (SELECT result_id, CASE WHEN duration IS NULL THEN 'download_failed' WHEN duration <= 0 THEN 'invalid' WHEN duration < 120 THEN 'truncated' WHEN duration > 600 THEN 'corrupted' ELSE 'ok' END AS status FROM search_result)
SELECT status, result_id, CASE WHEN status <> 'download_failed' THEN 'delete:' || result_id END AS action FROM s WHERE status <> 'ok'""")
def q_deletable(spark, sf_dir):
    """Rows of an audit that aren't in order, and the deletions that may follow from them; a failed download deletes nothing."""
    d = F.col("duration")
    status = F.coalesce(rel.first_reason((d.isNull(), "download_failed"), (d <= 0, "invalid"), (d < 120, "truncated"), (d > 600, "corrupted")), F.lit("ok"))
    bad = table(spark, sf_dir, "search_result").select(status.alias("status"), "result_id").where("status <> 'ok'")
    return bad.select("status", "result_id", F.when(F.col("status").isin(*audits.DELETABLE), F.concat(F.lit("delete:"), F.col("result_id").cast("string"))).alias("action"))


@query("""
SELECT user_id AS station, live, CASE WHEN live IS NULL THEN 'WARN' WHEN live < 60 THEN 'WARN' WHEN live < 120 THEN 'INFO' ELSE 'OK' END AS level, 'mood_min_separation=2, energy_smooth_transition=True' AS not_enforceable
FROM (SELECT user_id, CASE WHEN user_id % 9 > 0 THEN count(*) % 200 END AS live FROM events GROUP BY user_id)""")
def q_separation_audit(spark, sf_dir):
    """A station's live window against the wanted ones, and the rules that it can't keep."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("station")).agg(F.count("*").alias("n"))
    e = e.select("station", F.when(F.col("station") % 9 > 0, F.col("n") % 200).alias("live"))
    rules = {"mood_min_separation": 2, "genre_min_separation": 0, "tempo_max_variance": None, "energy_smooth_transition": True}
    return e.select("station", "live", audits.separation_level(F.col("live"), 60, 120).alias("level"), F.lit(audits.not_enforceable(rules)).alias("not_enforceable"))


@query("SELECT origin, CASE WHEN n > 0 THEN 'ALERT' ELSE 'ok' END AS no_tempo, CASE WHEN m > 2 THEN 'ALERT' ELSE 'ok' END AS no_voice FROM (SELECT origin, count(*) FILTER (bpm IS NULL) AS n, count(*) FILTER (voice_probability IS NULL) AS m FROM track_features GROUP BY origin)")
def q_alerts(spark, sf_dir):
    """Counters above their limits."""
    t = table(spark, sf_dir, "track_features").groupBy("origin").agg(F.count_if(F.col("bpm").isNull()).alias("n"), F.count_if(F.col("voice_probability").isNull()).alias("m"))
    return t.select("origin", audits.alert(F.col("n"), 0).alias("no_tempo"), audits.alert(F.col("m"), 2).alias("no_voice"))


_OFF = "(SELECT hour, NOT hour BETWEEN 9 AND 16 AS enabled FROM (SELECT unnest(range(24)) AS hour))"


@query(f"SELECT hour AS missing_hour FROM {_OFF} WHERE NOT enabled")
def q_missing_hours(spark, sf_dir):
    """Hours that no enabled part of the day covers."""
    p = spark.createDataFrame([(*d, d[0] != "Day") for d in numbers.DAYPARTS], "name string, a int, b int, enabled boolean")
    hours = p.where("enabled").select(F.explode(numbers.hours_between(F.col("a"), F.col("b"))).alias("missing_hour"))
    return spark.range(24).select(F.col("id").cast("int").alias("missing_hour")).join(hours, "missing_hour", "left_anti")


@query("SELECT mood, count(*) AS n FROM (SELECT DISTINCT feature_id, mood FROM track_features) WHERE mood IN ('Calm', 'Relaxed', 'Energetic', 'Excited', 'Sad') GROUP BY mood")
def q_enabled_moods(spark, sf_dir):
    """Rows of enabled moods only; unknown names are none."""
    dim = spark.createDataFrame([(m, m not in ("Intense", "Angry", "Melancholic")) for m in numbers.MOODS], "mood string, enabled boolean")
    t = table(spark, sf_dir, "track_features").select("feature_id", "mood").distinct()
    return t.join(F.broadcast(dim.where("enabled")), "mood").groupBy("mood").agg(F.count("*").alias("n"))


# listings, playlists and the store

_FILES = f"SELECT track_id AS file_id, artist, title, CASE WHEN track_id % 3 > 0 THEN uploaded_at ELSE 0 END AS uploaded_at, CASE WHEN track_id % 2 = 0 THEN {NOW} - 86400 END AS mtime FROM tracks WHERE batch_no > 0"


@query(f"""
WITH s AS (SELECT azuracast_file_id AS file_id, min(track_key) AS track_key, min(uploaded_at) AS up, max(play_count) AS plays FROM tracks WHERE azuracast_file_id IS NOT NULL GROUP BY 1), f AS ({_FILES})
SELECT file_id, coalesce(s.track_key, CASE WHEN trim(artist) <> '' AND trim(title) <> '' THEN {_key_sql()} END) AS track_key, coalesce(s.up, nullif(uploaded_at, 0), nullif(mtime, 0), {NOW}) AS uploaded_at, coalesce(plays, 0) AS play_count, s.file_id IS NULL AS registered FROM f LEFT JOIN s USING (file_id)""")
def q_listing_join(spark, sf_dir):
    """Files of a listing with their stored row; those without one take what the listing says and are registered."""
    t = table(spark, sf_dir, "tracks")
    store = t.where("azuracast_file_id IS NOT NULL").groupBy(F.col("azuracast_file_id").alias("file_id")).agg(F.min("track_key").alias("key"), F.min("uploaded_at").alias("up"), F.max("play_count").alias("plays"), F.lit(True).alias("held"))
    files = t.where("batch_no > 0").select(F.col("track_id").alias("file_id"), "artist", "title", F.when(F.col("track_id") % 3 > 0, F.col("uploaded_at")).otherwise(0.0).alias("uploaded_at"), F.when(F.col("track_id") % 2 == 0, NOW - 86400).alias("mtime"))
    j = files.join(store, "file_id", "left")
    some = lambda c: F.nullif(F.col(c), F.lit(0.0))
    return j.select("file_id", F.coalesce("key", text.file_key(F.col("artist"), F.col("title"))).alias("track_key"), F.coalesce("up", some("uploaded_at"), some("mtime"), F.lit(NOW)).alias("uploaded_at"), F.coalesce("plays", F.lit(0)).alias("play_count"), F.col("held").isNull().alias("registered"))


@query("WITH m AS (SELECT name, 10 + row_number() OVER (ORDER BY name) AS id FROM (VALUES ('Dawn'), ('Dusk'), ('Night')) v(name)), p AS (SELECT DISTINCT lookup_id, unnest(['Dawn', 'Day', 'Night', '', NULL]) AS name FROM genre_result WHERE lookup_id % 2 = 0) SELECT lookup_id, array_to_string(list_sort(list(id)), ',') AS ids FROM p JOIN m USING (name) GROUP BY lookup_id")
def q_playlist_ids(spark, sf_dir):
    """Names to ids; blank names and names that the map lacks are dropped."""
    ids = spark.createDataFrame([("Dawn", 11), ("Dusk", 12), ("Night", 13)], "name string, id int")
    lists = F.array(*[F.struct(F.lit(n).cast("string").alias("name")) for n in ("Dawn", "Day", "Night", "", None)])
    g = table(spark, sf_dir, "genre_result").where("lookup_id % 2 = 0").select("lookup_id").distinct().withColumn("playlists", lists)
    names = g.select("lookup_id", F.explode(rel.names_of(F.col("playlists"))).alias("name"))
    return names.join(F.broadcast(ids), "name").groupBy("lookup_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("ids"))


@query("SELECT name, CASE WHEN name IN ('Day', 'Night') THEN 'skipped' ELSE 'create' END AS op FROM (VALUES ('Dawn'), ('Day'), ('Dusk'), ('Night')) v(name) UNION ALL SELECT name, 'delete' FROM (VALUES ('Day'), ('Night'), ('Old')) v(name)")
def q_playlist_actions(spark, sf_dir):
    """Only missing playlists are created; a full clean-up deletes every existing one."""
    want = spark.createDataFrame([(d[0],) for d in numbers.DAYPARTS], "name string")
    there = spark.createDataFrame([("Day",), ("Night",), ("Old",)], "name string")
    return rel.create_missing(want, there, "name").unionByName(sinks.actions(there, "delete", "name").select(F.col("key").alias("name"), "op"))


_MOOD_OF = "CASE WHEN feature_id % 13 = 0 THEN NULL WHEN feature_id % 11 = 0 THEN 'Groovy' ELSE mood END"


@query(f"""
WITH t AS (SELECT DISTINCT feature_id, {_MOOD_OF} AS mood FROM track_features), d AS ({_PARTS_SQL}), p AS (SELECT mood, string_agg(part, '|' ORDER BY place) AS parts FROM d WHERE part IN ('Dawn', 'Night') GROUP BY mood)
SELECT feature_id, CASE WHEN mood IS NULL OR mood = '' THEN 'no_mood' WHEN parts IS NULL THEN 'failed' ELSE 'assigned' END AS outcome, parts FROM t LEFT JOIN p USING (mood)""")
def q_assignment(spark, sf_dir):
    """Tracks to the existing playlists of their mood, with the outcome of each."""
    t = table(spark, sf_dir, "track_features").select("feature_id", F.expr(_MOOD_OF).alias("mood")).distinct()
    there = spark.createDataFrame([("Dawn",), ("Night",)], "part string")
    parts = parts_of_moods(spark).join(F.broadcast(there), "part").groupBy("mood").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "part"))), lambda x: x["part"]), "|").alias("parts"))
    j = t.join(F.broadcast(parts), "mood", "left")
    return j.select("feature_id", F.when(F.coalesce("mood", F.lit("")) == "", "no_mood").when(F.col("parts").isNull(), "failed").otherwise("assigned").alias("outcome"), "parts")


@query("""
WITH n AS (SELECT track_key, arg_max(mood, (feature_id, mood)) AS mood FROM track_features WHERE mood IS NOT NULL GROUP BY 1)
SELECT track_id, coalesce(t.mood, n.mood) AS mood, t.mood IS NULL AND n.mood IS NOT NULL AS updated FROM tracks t LEFT JOIN n USING (track_key) WHERE azuracast_file_id IS NOT NULL AND deleted_at IS NULL""")
def q_fill_moods(spark, sf_dir):
    """Active tracks without a mood take the one of their newest features; tracks that have one keep it."""
    t = table(spark, sf_dir, "tracks").where("azuracast_file_id IS NOT NULL AND deleted_at IS NULL").select("track_id", "track_key", "mood")
    new = table(spark, sf_dir, "track_features").where("mood IS NOT NULL").select("track_key", "mood", F.col("feature_id").alias("ord"))
    lacking = t.where("mood IS NULL")
    filled = state.updated_by_key(lacking, new, "track_key", ["mood"])
    return t.where("mood IS NOT NULL").select("track_id", "mood", F.lit(False).alias("updated")).unionByName(filled.select("track_id", "mood", F.col("mood").isNotNull().alias("updated")))


@query("SELECT status, coalesce(list_value, 'none') AS playlist, count(*) AS n FROM (SELECT CASE WHEN score >= 0.6 THEN 'ok' ELSE 'low' END AS status, unnest(CASE WHEN score >= 0.6 THEN ['a', source] ELSE ['b'] END) AS list_value FROM search_result) GROUP BY 1, 2")
def q_outcome_distribution(spark, sf_dir):
    ok = F.col("score") >= 0.6
    s = table(spark, sf_dir, "search_result").select(F.when(ok, "ok").otherwise("low").alias("status"), F.explode(F.when(ok, F.array(F.lit("a"), "source")).otherwise(F.array(F.lit("b")))).alias("playlist"))
    return s.groupBy("status", F.coalesce("playlist", F.lit("none")).alias("playlist")).agg(F.count("*").alias("n"))


@query("SELECT coalesce(nullif(fingerprint_hash, ''), track_id::VARCHAR) AS unique_id, count(*) AS plays FROM audio_fingerprints GROUP BY 1")
def q_plays_by_id(spark, sf_dir):
    """Plays by unique id, by plain id where that is missing or empty."""
    f = table(spark, sf_dir, "audio_fingerprints")
    return f.groupBy(F.coalesce(F.nullif("fingerprint_hash", F.lit("")), F.col("track_id").cast("string")).alias("unique_id")).agg(F.count("*").alias("plays"))


@query("SELECT DISTINCT track_key FROM (SELECT track_key FROM tracks WHERE azuracast_file_id IS NOT NULL AND deleted_at IS NULL UNION ALL SELECT track_key FROM track_features)")
def q_valid_keys(spark, sf_dir):
    """Keys of active and of pending tracks."""
    active = table(spark, sf_dir, "tracks").where("azuracast_file_id IS NOT NULL AND deleted_at IS NULL").select("track_key")
    return active.unionByName(table(spark, sf_dir, "track_features").select("track_key")).distinct()


# tags

_G = "SELECT DISTINCT lookup_id, coalesce(tags, []) AS t, coalesce(sources_hit, []) AS s FROM genre_result"
_LOW = "list_filter(list_transform({}, lambda x: lower(trim(x))), lambda x: x IS NOT NULL AND x <> '')"


@query(f"""
WITH g AS (SELECT lookup_id, CASE WHEN list_contains(s, 'musicbrainz') THEN {_LOW.format('t')} ELSE [] END AS m, CASE WHEN list_contains(s, 'discogs') THEN {_LOW.format('list_reverse(t)')} ELSE [] END AS d, CASE WHEN list_contains(s, 'lastfm') THEN {_LOW.format("list_transform(t, lambda x: x || ' fm')")} ELSE [] END AS l, {_LOW.format('t[1:1]')} AS f FROM ({_G})),
u AS (SELECT lookup_id, m, list_filter(d, lambda x: NOT list_contains(m, x)) AS d, list_filter(l, lambda x: NOT list_contains(m, x) AND NOT list_contains(d, x)) AS l, f FROM g),
a AS (SELECT lookup_id, list_concat(list_concat(m, d), l) AS al, concat_ws('|', CASE WHEN len(m) > 0 THEN 'musicbrainz' END, CASE WHEN len(d) > 0 THEN 'discogs' END, CASE WHEN len(l) > 0 THEN 'lastfm' END) AS hits, f FROM u),
b AS (SELECT lookup_id, CASE WHEN len(al) = 0 THEN f ELSE al END AS al, CASE WHEN len(al) = 0 AND len(f) > 0 THEN 'lastfm-artist' ELSE hits END AS hits FROM a)
SELECT lookup_id, array_to_string(list_filter(al, lambda x, i: list_position(al, x) = i), '|') AS tags, hits FROM b""")
def q_tag_sources(spark, sf_dir):
    """Tags of all services in order, each once, with the services that added any; the artist's tags only if there are no others."""
    g = table(spark, sf_dir, "genre_result").select("lookup_id", F.coalesce("tags", F.array().cast("array<string>")).alias("t"), F.coalesce("sources_hit", F.array().cast("array<string>")).alias("s")).distinct()
    of = lambda n, c: F.when(F.array_contains("s", n), c).otherwise(F.array().cast("array<string>"))
    sources = [("musicbrainz", of("musicbrainz", F.col("t"))), ("discogs", of("discogs", F.reverse("t"))), ("lastfm", of("lastfm", F.transform("t", lambda x: F.concat(x, F.lit(" fm")))))]
    u = g.select("lookup_id", tags.united(sources, ("lastfm-artist", F.slice("t", 1, 1))).alias("u"))
    return u.select("lookup_id", F.array_join("u.tags", "|").alias("tags"), F.array_join("u.sources_hit", "|").alias("hits"))


@query(f"""
WITH g AS (SELECT lookup_id, {_LOW.format('t[1:2]')} AS a, {_LOW.format('t')} AS b FROM ({_G}))
SELECT lookup_id, array_to_string(list_concat(a, list_filter(list_filter(b, lambda x, i: list_position(b, x) = i), lambda x: NOT list_contains(a, x))), '|') AS names FROM g""")
def q_curated_tags(spark, sf_dir):
    g = table(spark, sf_dir, "genre_result").select("lookup_id", F.coalesce("tags", F.array().cast("array<string>")).alias("t"), F.coalesce("sources_hit", F.array().cast("array<string>")).alias("s")).distinct()
    return g.select("lookup_id", F.array_join(tags.curated_then_crowd(F.slice("t", 1, 2), F.col("t")), "|").alias("names"))


@query(f"""
WITH g AS (SELECT lookup_id, list_concat({_LOW.format('t')}, {_LOW.format('s')}) AS l FROM ({_G}))
SELECT lookup_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS names FROM g""")
def q_release_tags(spark, sf_dir):
    """Genres and styles of the first three of five releases: here each holds the same lists but the last two, which don't count."""
    g = table(spark, sf_dir, "genre_result").select("lookup_id", F.coalesce("tags", F.array().cast("array<string>")).alias("t"), F.coalesce("sources_hit", F.array().cast("array<string>")).alias("s")).distinct()
    one = F.struct(F.col("t").alias("genre"), F.col("s").alias("style"))
    late = F.struct(F.array(F.lit("late")).alias("genre"), F.array(F.lit("later")).alias("style"))
    return g.select("lookup_id", F.array_join(tags.of_releases(F.array(one, one, one, late, late)), "|").alias("names"))


@query(f"SELECT lookup_id, array_to_string(CASE WHEN lookup_id % 4 = 0 THEN [] ELSE list_transform(list_filter(t, lambda x: x IS NOT NULL), lambda x: lower(x)) END, '|') AS names FROM ({_G})")
def q_service_tags(spark, sf_dir):
    """Names in a service's JSON answer; one tag that is no list gives none."""
    g = table(spark, sf_dir, "genre_result").select("lookup_id", F.coalesce("tags", F.array().cast("array<string>")).alias("t"), F.coalesce("sources_hit", F.array().cast("array<string>")).alias("s")).distinct()
    names = F.transform("t", lambda x: F.struct(x.alias("name")))
    body = F.when(F.col("lookup_id") % 4 == 0, F.lit('{"toptags": {"tag": {"name": "single"}}}')).otherwise(F.to_json(F.struct(F.struct(names.alias("tag")).alias("toptags"))))
    return g.select("lookup_id", F.array_join(tags.of_top_tags(body), "|").alias("names"))


# state

_BASE = "SELECT track_key, coalesce(min(play_count), 0) AS play_count FROM tracks WHERE track_key IS NOT NULL GROUP BY 1"
_HIST = f"SELECT artist, title, epoch_us(ts) / 1000000.0 AS played_at, CASE WHEN trim(artist) <> '' AND trim(title) <> '' THEN {_key_sql()} END AS k FROM events JOIN tracks ON user_id = track_id"


@query(f"WITH b AS ({_BASE}), h AS (SELECT k AS track_key, count(*) AS n FROM ({_HIST}) GROUP BY 1) SELECT track_key, play_count + coalesce(n, 0) AS play_count FROM b LEFT JOIN h USING (track_key)")
def q_stored_sync(spark, sf_dir):
    """Two syncs of a stored cursor and its counts; the second history holds the first once more, which counts for nothing."""
    t = table(spark, sf_dir, "tracks")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("track_id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("played_at"))
    history = e.join(t.select("track_id", "artist", "title"), "track_id").select("artist", "title", "played_at")
    path = scratch_path(spark, "plays")
    state.PlayStore(spark, path).register(t.where("track_key IS NOT NULL").groupBy("track_key").agg(F.coalesce(F.min("play_count"), F.lit(0)).alias("play_count")))
    state.PlayStore(spark, path).sync(history.where("played_at < 1705000000"), NOW)
    return state.PlayStore(spark, path).sync(history, NOW).tracks()


@query("""
WITH e AS (SELECT user_id, event_type AS k, epoch_us(ts) AS us FROM events), u AS (SELECT user_id, max(us) AS uploaded_at FROM e WHERE k = 'purchase' GROUP BY 1)
SELECT u.user_id, uploaded_at, max(CASE WHEN k = 'click' THEN us END) AS deleted_at, count(*) FILTER (k = 'view') AS play_count FROM u LEFT JOIN e ON e.user_id = u.user_id AND e.us > u.uploaded_at AND k IN ('click', 'view') GROUP BY 1, 2""")
def q_lifecycle(spark, sf_dir):
    """Uploads reset a track's plays and deletion; here purchases upload, clicks delete and views play."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return state.lifecycles(e, "user_id", "at", "event_type", "purchase", "click", "view")


@query("""
WITH o AS (SELECT track_key, min(artist) AS artist, max(uploaded_at) AS up, max(play_count) AS plays, max(deleted_at) AS del FROM tracks WHERE batch_no = 0 GROUP BY 1), n AS (SELECT track_key, arg_max(artist, (uploaded_at, track_id)) AS artist, max(uploaded_at) AS up FROM tracks WHERE batch_no > 0 GROUP BY 1)
SELECT track_key, coalesce(o.artist, n.artist) AS artist, coalesce(n.up, o.up) AS uploaded_at, CASE WHEN n.track_key IS NOT NULL THEN 0 ELSE plays END AS play_count, CASE WHEN n.track_key IS NULL THEN del END AS deleted_at FROM o FULL JOIN n USING (track_key)""")
def q_reupload(spark, sf_dir):
    """Uploads of known keys keep the artist, take the new time and set plays and deletion back."""
    t = table(spark, sf_dir, "tracks")
    old = t.where("batch_no = 0").groupBy("track_key").agg(F.min("artist").alias("artist"), F.max("uploaded_at").alias("uploaded_at"), F.max("play_count").alias("play_count"), F.max("deleted_at").alias("deleted_at"))
    return rel.upserted(old, t.where("batch_no > 0"), "track_key", ["artist"], ["uploaded_at"], ["uploaded_at", "track_id"], {"play_count": F.lit(0).cast("long"), "deleted_at": F.lit(None).cast("double")})


@query(f"SELECT feature_id, round(({NOW} - max(file_mtime)) / 86400.0, 6) AS age FROM track_features WHERE file_mtime IS NOT NULL GROUP BY 1")
def q_file_age(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").where("file_mtime IS NOT NULL").groupBy("feature_id").agg(F.max("file_mtime").alias("m"))
    return t.select("feature_id", F.round(numbers.age_days(F.col("m"), F.lit(NOW)), 6).alias("age"))


# vectors and profiles

_OK = "len(embedding) = 64 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0"


@query(f"SELECT count(*) AS rows, count(DISTINCT profile_id) AS keys, 64 AS dimensions, 'float' AS kind, count(*) FILTER (coalesce({_OK}, false)) AS usable FROM taste_profile")
def q_store_info(spark, sf_dir):
    return vectors.store_info(table(spark, sf_dir, "taste_profile"), "profile_id", "embedding", 64)


@query("SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], list_transform(range(len(embedding)), lambda i: (i % 5 - 2)::DOUBLE)), 6) AS similarity FROM embeddings ORDER BY list_dot_product(embedding::DOUBLE[], list_transform(range(len(embedding)), lambda i: (i % 5 - 2)::DOUBLE)) DESC, vec_id LIMIT 12")
def q_text_query(spark, sf_dir):
    """The rows nearest to a vector from outside, as an encoder of texts gives it."""
    e = table(spark, sf_dir, "embeddings")
    dim = e.select(F.size("embedding")).first()[0]
    return vectors.nearest_to(e, "vec_id", "embedding", [float(i % 5 - 2) for i in range(dim)], 12).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("""
WITH s AS (SELECT b.vec_id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d, row_number() OVER (PARTITION BY b.vec_id ORDER BY list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC) AS rn FROM embeddings a, embeddings b WHERE a.label = 0 AND b.label = 1),
m AS (SELECT vec_id, avg(d) AS score FROM s WHERE rn <= 5 GROUP BY 1), t AS (SELECT DISTINCT user_id FROM events)
SELECT user_id, round(score, 6) AS score, CASE WHEN score IS NULL THEN 'pass' WHEN score < 0.3 THEN 'reject' ELSE 'pass' END AS verdict, coalesce(score < 0.3, false) AS logged FROM t LEFT JOIN m ON user_id = vec_id""")
def q_taste_check(spark, sf_dir):
    """A track without an embedding has no score and passes; low ones are rejected and logged."""
    e = table(spark, sf_dir, "embeddings")
    score = vectors.best_mean(e.where("label = 1"), e.where("label = 0"), "vec_id", "embedding", 5)
    t = table(spark, sf_dir, "events").select("user_id").distinct().join(score.withColumnRenamed("vec_id", "user_id"), "user_id", "left")
    low = F.coalesce(F.col("score") < 0.3, F.lit(False))
    return t.select("user_id", F.round("score", 6).alias("score"), F.when(low, "reject").otherwise("pass").alias("verdict"), low.alias("logged"))


@query("WITH s AS (SELECT DISTINCT path, artist, row_number() OVER (PARTITION BY artist ORDER BY path, profile_id) AS rn FROM taste_profile WHERE path IS NOT NULL AND artist IS NOT NULL) SELECT artist, path FROM s WHERE rn <= 3 AND NOT EXISTS (SELECT 1 FROM taste_profile p WHERE p.path = s.path AND p.profile_id % 4 = 0)")
def q_held_out(spark, sf_dir):
    """A sample of the library without what the profile was built on."""
    t = table(spark, sf_dir, "taste_profile").where("path IS NOT NULL AND artist IS NOT NULL").select("profile_id", "artist", "path")
    sample = rel.head_of_groups(t, ["artist"], ["path", "profile_id"], 3).select("artist", "path").distinct()
    return rel.not_in(sample, table(spark, sf_dir, "taste_profile").where("profile_id % 4 = 0"), "path")


@query(f"SELECT first_artist FROM (SELECT arg_min(artist, profile_id) AS first_artist FROM taste_profile WHERE artist IS NOT NULL GROUP BY trim(regexp_replace(regexp_replace(lower(strip_accents(artist)), '[^\\pL\\pN_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) HAVING trim(regexp_replace(regexp_replace(lower(strip_accents(min(artist))), '[^\\pL\\pN_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) <> '')")
def q_first_spelling(spark, sf_dir):
    """Distinct artists by their comparable name, in the spelling that came first."""
    t = table(spark, sf_dir, "taste_profile").where("artist IS NOT NULL").select("profile_id", "artist", text.artist_text(F.col("artist")).alias("k")).where("k <> ''")
    return t.groupBy("k").agg(F.min_by("artist", "profile_id").alias("first_artist")).select("first_artist")


@query("SELECT count(DISTINCT lower(artist)) AS artists, (SELECT count(DISTINCT t.track_key) FROM tracks t WHERE EXISTS (SELECT 1 FROM track_features f WHERE f.track_key = t.track_key)) AS embedded FROM taste_profile")
def q_profile_counts(spark, sf_dir):
    """Artists sampled, and tracks whose features are there already."""
    held = rel.only_in(table(spark, sf_dir, "tracks").select("track_key"), table(spark, sf_dir, "track_features"), "track_key").agg(F.countDistinct("track_key").alias("embedded"))
    # two frames of one row each
    return table(spark, sf_dir, "taste_profile").agg(F.countDistinct(F.lower("artist")).alias("artists")).crossJoin(held)


@query("SELECT result_id, rank FROM (SELECT result_id, row_number() OVER (ORDER BY score, result_id) AS rank FROM search_result WHERE score < 0.4) WHERE rank <= 40")
def q_purge_order(spark, sf_dir):
    """The lowest scores first, ties by key."""
    s = table(spark, sf_dir, "search_result").where("score < 0.4").select("result_id", "score")
    top = rel.capped(s, ["score", "result_id"], 40)
    return rel.global_ranks(top, ["score", "result_id"]).select("result_id", (F.col("rank") + 1).alias("rank"))


@query("SELECT key, value FROM (VALUES ('high', '3'), ('low', 'x')) v(key, value)")
def q_cursor_store(spark, sf_dir):
    """Named values written one after the other; the last of a name holds, an unreadable number is the default."""
    c = state.Cursors(spark, scratch_path(spark, "cursors"))
    for k, v in (("high", 1), ("low", "x"), ("high", int(c.number("low", 3.0)))):
        c.put(k, v)
    return c.table.read()


# readers and sinks: tables are written in the shape a service returns and read again


def _json(df, name):
    path = scratch_path(df.sparkSession, name)
    df.write.json(path)
    return path


def _id_sql(source):
    return f"'{source}'[1:6] || '_' || substr(sha1('{source}' || '|' || lower(trim(artist)) || '|' || lower(trim(title))), 1, 16)"


@query(f"SELECT {_id_sql('chart')} AS id, trim(artist) AS artist, trim(artist) || ' - ' || trim(title) AS search, count(*) AS n FROM tracks WHERE trim(artist) <> '' AND trim(title) <> '' GROUP BY 1, 2, 3")
def q_chart_reader(spark, sf_dir):
    t = table(spark, sf_dir, "tracks").select(F.col("track_id").alias("ord"), "artist", "title", F.lit("u").alias("thumb_url_large"))
    return readers.chart(spark, _json(t, "chart")).groupBy("id", "artist", "search").agg(F.count("*").alias("n"))


_ENTRY = f"regexp_extract({decoded_sql('title')}, '(?s)^(.*?){text.SPACE}+[–—‒\\-·]{text.SPACE}+(.*)$', ['a', 't'])"


@query(f"""
WITH e AS (SELECT row_ord, artist || ' – ' || title AS title, row_number() OVER (PARTITION BY source ORDER BY row_ord) AS rn FROM candidate WHERE source IS NOT NULL),
p AS (SELECT row_ord, {_ENTRY} AS p FROM e WHERE rn <= 30 AND title IS NOT NULL), c AS (SELECT row_ord, trim({cleaned_sql('p.a')}) AS artist, trim({cleaned_sql('p.t')}) AS title FROM p)
SELECT row_ord, artist, title FROM c WHERE artist <> '' AND title <> ''""")
def q_feed_reader(spark, sf_dir):
    """The first thirty entries of each feed, parsed by its parser."""
    c = table(spark, sf_dir, "candidate").where("source IS NOT NULL")
    entries = c.select(F.col("source").alias("label"), F.col("row_ord").alias("entry_ord"), F.concat("artist", F.lit(" – "), "title").alias("title"), F.lit("https://feed.example/x").alias("link"))
    spec = c.select(F.col("source").alias("label")).distinct().select("label", F.lit("u").alias("url"), F.lit("dash").alias("parser"), F.lit("feed").alias("link_must_contain"), F.lit(True).alias("enabled"), F.lit(30).alias("limit"))
    return readers.feeds(entries, spec).select(F.col("ord._o0").alias("row_ord"), "artist", "title")


@query("SELECT tag, trim(name) AS name, place FROM (SELECT source AS tag, title AS name, row_number() OVER (PARTITION BY source ORDER BY result_id) AS place FROM search_result WHERE source IS NOT NULL) WHERE place <= 20 AND trim(name) <> ''")
def q_tag_chart_reader(spark, sf_dir):
    s = table(spark, sf_dir, "search_result").where("source IS NOT NULL")
    s = s.select(F.col("source").alias("tag"), F.row_number().over(Window.partitionBy("source").orderBy("result_id")).alias("ord"), F.col("title").alias("name"), F.struct(F.lit("a").alias("name")).alias("artist"), F.array(F.struct(F.lit("large").alias("size"), F.lit("u").alias("text"))).alias("image"))
    got = readers.tag_charts(s)
    return got.select(F.col("ord._o0").alias("tag"), F.col("title").alias("name"), F.col("ord._o1").alias("place"))


@query("SELECT result_id % 3 AS source_rank, count(*) AS n, count(title) AS titled, round(sum(coalesce(duration, 0)), 3) AS seconds FROM search_result GROUP BY 1")
def q_probe_reader(spark, sf_dir):
    s = table(spark, sf_dir, "search_result").select(F.col("result_id").cast("string").alias("queue_id"), (F.col("result_id") % 3).alias("source_rank"), "title", "uploader", "channel", "duration", F.col("url").alias("webpage_url"))
    return readers.probe_lines(spark, _json(s, "probe")).groupBy(F.col("source_rank").cast("long").alias("source_rank")).agg(F.count("*").alias("n"), F.count("title").alias("titled"), F.round(F.sum(F.coalesce("duration", F.lit(0.0))), 3).alias("seconds"))


@query("SELECT track_id AS file_id, CASE WHEN track_id % 2 = 0 THEN 'Dawn|Night' ELSE 'Day' END AS names FROM tracks")
def q_listing_reader(spark, sf_dir):
    pl = lambda *ns: F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(n).alias("name")) for i, n in enumerate(ns)])
    t = table(spark, sf_dir, "tracks").select(F.col("track_id").alias("id"), "artist", "title", F.when(F.col("track_id") % 2 == 0, pl("Dawn", "Night", "Dawn", "")).otherwise(pl("Day", "", "", "Day")).alias("playlists"))
    return readers.station_files(spark, _json(t, "listing")).select(F.col("id").alias("file_id"), F.array_join(rel.names_of(F.col("playlists")), "|").alias("names"))


@query("SELECT event_id AS unique_id, epoch_us(ts) AS played_at FROM events ORDER BY epoch_us(ts) DESC, event_id::VARCHAR LIMIT 500")
def q_history_reader(spark, sf_dir):
    """The newest 500 plays, which is all that the service gives."""
    e = table(spark, sf_dir, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("played_at"), F.struct(F.col("event_id").cast("string").alias("unique_id"), F.lit("a").alias("artist"), F.lit("t").alias("title")).alias("song"))
    return readers.station_history(spark, _json(e, "history")).select(F.col("unique_id").cast("long").alias("unique_id"), "played_at")


@query("SELECT DISTINCT feature_id::VARCHAR AS path, coalesce(bpm, 0) AS bpm, coalesce(mood, '') AS mood, coalesce(duration, 0) AS duration, valence, coalesce(lastfm_tags, '') AS lastfm_tags FROM track_features WHERE origin = 'id3'")
def q_tag_frames(spark, sf_dir):
    """Features from a file's tag frames; missing ones have defaults."""
    t = table(spark, sf_dir, "track_features").where("origin = 'id3'")
    frame = lambda k, c: F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v"))
    some = F.filter(F.array(frame("BPM", "bpm"), frame("MOOD", "mood"), frame("DURATION", "duration"), frame("VALENCE", "valence"), frame("LASTFM_TAGS", "lastfm_tags")), lambda x: x["v"].isNotNull())
    got = readers.tag_frames(t.select(F.col("feature_id").cast("string").alias("path"), F.map_from_entries(some).alias("frames")))
    return got.select("path", "bpm", "mood", "duration", "valence", "lastfm_tags").distinct()


@query(r"SELECT DISTINCT path, split_part(path, '/', -3) AS artist, split_part(path, '/', -2) AS album, split_part(path, '/', -1) AS file FROM taste_profile WHERE regexp_matches(lower(path), '\.(mp3|flac|m4a|ogg|opus|wav|aac)$')")
def q_library_paths(spark, sf_dir):
    return readers.library_paths(table(spark, sf_dir, "taste_profile").where("path IS NOT NULL").select("path"))


@query(r"""
WITH n AS (SELECT result_id, uploader, regexp_replace(split_part(title || '.mp3', '/', -1), '\.[^.]+$', '') AS name FROM search_result WHERE title IS NOT NULL)
SELECT result_id, CASE WHEN trim(coalesce(uploader, ''), ' ') <> '' THEN trim(uploader, ' ') WHEN contains(name, ' - ') THEN trim(split_part(name, ' - ', 1), ' ') ELSE 'Unknown' END AS artist FROM n""")
def q_identity(spark, sf_dir):
    """Artist from a file's tags, else from its name."""
    s = table(spark, sf_dir, "search_result").where("title IS NOT NULL")
    frames = F.when(F.col("uploader").isNotNull(), F.create_map(F.lit("artist"), "uploader")).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    return readers.identity(s.select(F.concat_ws("/", F.col("result_id").cast("string"), F.concat("title", F.lit(".mp3"))).alias("path"), frames.alias("frames"))).select(F.substring_index("path", "/", 1).cast("long").alias("result_id"), "artist")


@query("SELECT DISTINCT feature_id, CASE WHEN coalesce(mood, '') = '' THEN 'Calm' ELSE mood END AS mood FROM track_features")
def q_mood_of_file(spark, sf_dir):
    t = table(spark, sf_dir, "track_features").select("feature_id", F.create_map(F.lit("genre"), F.lit("x")).alias("custom_fields"), "mood", F.lit("Comment\nMood: Calm\nend").alias("text"))
    return readers.mood_of_file(t).select("feature_id", "mood").distinct()


@query("SELECT count(*) AS n, count(artist) AS artists FROM candidate WHERE coalesce(artist, title, search) IS NOT NULL")
def q_queue_store(spark, sf_dir):
    """The queue written and read again; it stays as it is after failed uploads."""
    path = scratch_path(spark, "queue")
    sinks.write_queue(table(spark, sf_dir, "candidate"), path)
    return sinks.after_uploads(readers.queue(spark, path), 1).agg(F.count("*").alias("n"), F.count("artist").alias("artists"))


@query("SELECT count(DISTINCT lower(trim(artist)) || '|' || lower(trim(title))) AS keys FROM genre_result")
def q_tag_cache(spark, sf_dir):
    """Look-ups put into the cache batch by batch and written once."""
    g = table(spark, sf_dir, "genre_result").select(text.cache_key(F.col("artist"), F.col("title")).alias("k"), "tags", F.col("lookup_id").cast("double").alias("at")).where("k IS NOT NULL")
    one = g.groupBy("k").agg(F.max_by("tags", "at").alias("tags"), F.max("at").alias("at"))
    cache = sinks.TagCache(spark, scratch_path(spark, "cache"))
    cache.put(one.where("at % 2 = 0"))
    cache.put(one)
    cache.flush()
    return cache.table.read().agg(F.countDistinct("k").alias("keys"))


@query("SELECT row_ord, CASE WHEN h.k IS NOT NULL THEN replace(h.cover, '100x100', '600x600') END AS cover FROM (SELECT row_ord, lower(trim(artist)) AS a, lower(trim(title)) AS t FROM candidate) c LEFT JOIN (SELECT lower(trim(artist)) AS a, lower(trim(title)) AS t, true AS k, arg_min('https://i.example/' || track_id || '/100x100.jpg', track_id) AS cover FROM tracks GROUP BY 1, 2) h USING (a, t)")
def q_cover_lookup(spark, sf_dir):
    hits = table(spark, sf_dir, "tracks").select("artist", "title", F.col("track_id").alias("ord"), F.concat(F.lit("https://i.example/"), F.col("track_id").cast("string"), F.lit("/100x100.jpg")).alias("url"))
    return readers.covers(table(spark, sf_dir, "candidate").select("row_ord", "artist", "title"), hits).select("row_ord", "cover")


@query("SELECT range AS place, 'genre_' || range AS label FROM range(400)")
def q_genre_labels(spark, sf_dir):
    return readers.genre_labels(spark).select(F.col("place").cast("long").alias("place"), "label")
