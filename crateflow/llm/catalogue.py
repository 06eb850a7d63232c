"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.llm import bpe, intake, linkage, neighbours, packing, quality, terms, variants, visual
from crateflow.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.same_in_print(table(spark, sf_dir, "candidate"), table(spark, sf_dir, "tracks"))


def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate row with the canonical form of its artist and title."""
    return visual.canonical_forms(table(spark, sf_dir, "candidate"), ["row_ord"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = variants.same_recording_pairs(table(spark, sf_dir, "redownload"), table(spark, sf_dir, "nickname"))
    return pairs.select(F.col("a").alias("request_id_a"), F.col("b").alias("request_id_b"))


def p2_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request that names a recording with its parsed form and the form it is attributed to."""
    got = variants.linked(table(spark, sf_dir, "redownload"), table(spark, sf_dir, "nickname"))
    return got.select(F.col("id").alias("request_id"), "form", "version", F.col("root").alias("recording"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = neighbours.mutual_pairs(table(spark, sf_dir, "taste_profile"), "profile_id", "embedding")
    return pairs.select(F.col("a").alias("profile_id_a"), F.col("b").alias("profile_id_b"))


def p3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row whose id is divisible by 20, among all rows."""
    near = neighbours.nearest_rows(table(spark, sf_dir, "taste_profile"), "profile_id", "embedding", 5, queries="profile_id % 20 = 0", margin=0.6, ef=48)
    return near.select(F.col("a").alias("profile_id"), F.col("b").alias("neighbour_id"), F.col("place"), F.round("cosine", 4).alias("cosine"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = linkage.matches(table(spark, sf_dir, "search_result"), table(spark, sf_dir, "track_features"), table(spark, sf_dir, "nickname"))
    return got.select(F.col("clip").alias("result_id"), "track_key")


def p4_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every matched clip with its track and the confidence of the match."""
    got = linkage.matches(table(spark, sf_dir, "search_result"), table(spark, sf_dir, "track_features"), table(spark, sf_dir, "nickname"), 0.0)
    return got.withColumnRenamed("clip", "result_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(spark, table(spark, sf_dir, "genre_result"), table(spark, sf_dir, "track_features"))
    return counts.where("mark IS NOT NULL").select("field_name", "term", "mark")


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term with its occurrences, records and mark."""
    return terms.term_counts(spark, table(spark, sf_dir, "genre_result"), table(spark, sf_dir, "track_features"))


def p5_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after records were added, changed and deleted, and the same changes delivered again."""
    return terms.changed_counts(spark, table(spark, sf_dir, "genre_result"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = intake.repeated_tracks(table(spark, sf_dir, "tracks"), table(spark, sf_dir, "audio_fingerprints"))
    return got.where("batch_no BETWEEN 1 AND 10").select(F.col("a").alias("track_id_a"), F.col("b").alias("track_id_b"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.ByteBpe().encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of ids and whether decoding gives its text again."""
    coder = bpe.ByteBpe()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = coder.encode(docs, "doc_id", "text").select("doc_id", F.size("ids").cast("long").alias("n_ids"), coder.decode(F.col("ids")).alias("back"))
    return docs.join(back, "doc_id").select("doc_id", "n_ids", (F.coalesce("text", F.lit("")) == F.col("back")).alias("same"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of 2,048 tokens: every piece of every document with its container, start and size in tokens."""
    sizes = bpe.ByteBpe().count(table(spark, sf_dir, "documents"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "tokens")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios and rule outcomes of every document."""
    return quality.text_statistics(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_canonical": p1_canonical,
    "p2_found": p2_found,
    "p2_linked": p2_linked,
    "p3_found": p3_found,
    "p3_neighbours": p3_neighbours,
    "p4_found": p4_found,
    "p4_matches": p4_matches,
    "p5_found": p5_found,
    "p5_counts": p5_counts,
    "p5_changes": p5_changes,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p8_round_trip": p8_round_trip,
    "p9_containers": p9_containers,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}

_P5 = """
WITH raw AS (
  SELECT DISTINCT 'tags' AS field_name, lookup_id AS k, list_transform(tags, lambda x: trim(regexp_replace(lower(x), '\\s+', ' ', 'g'))) AS v FROM genre_result
  UNION ALL
  SELECT DISTINCT 'genre_top', feature_id, [trim(regexp_replace(lower(genre_top), '\\s+', ' ', 'g'))] FROM track_features
), cells AS (SELECT field_name, k, unnest(v) AS term FROM raw), ok AS (SELECT * FROM cells WHERE term IS NOT NULL AND term <> ''),
totals AS (SELECT field_name, count(DISTINCT k) AS total FROM ok GROUP BY 1),
counts AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT k) AS records FROM ok GROUP BY 1, 2),
marks AS (SELECT field_name, term, occurrences, records, CASE WHEN records < 5 THEN 'rare' WHEN records > total * 0.2 THEN 'common' END AS mark FROM counts JOIN totals USING (field_name))
"""


def _seen_sql(x: str, composed: bool = True) -> str:
    """SQL of what a reader sees; composing marks stands in for the collation."""
    q = lambda t: "'" + t.replace("'", "''") + "'"
    out = f"translate(regexp_replace({x}, '{visual.INVISIBLE}', '', 'g'), {q(''.join(visual.ONE))}, {q(''.join(visual.ONE.values()))})"
    for k, v in visual.SEVERAL.items():
        out = f"replace({out}, {q(k)}, {q(v)})"
    out = f"trim(regexp_replace({out}, '{visual.SPACES}', ' ', 'g'))"
    return f"nfc_normalize({out})" if composed else out


_P1_FOUND = f"""
WITH c AS (SELECT row_ord, artist, title, {_seen_sql("artist")} AS a, {_seen_sql("title")} AS t FROM candidate), l AS (SELECT DISTINCT track_key, artist, title, {_seen_sql("artist")} AS a, {_seen_sql("title")} AS t FROM tracks)
SELECT DISTINCT row_ord, track_key FROM c JOIN l USING (a, t) WHERE c.artist <> l.artist OR c.title <> l.title"""
_P1_CANONICAL = f"""
WITH c AS (SELECT row_ord, artist, title, {_seen_sql("artist")} AS a, {_seen_sql("title")} AS t, {_seen_sql("artist", False)} AS pa, {_seen_sql("title", False)} AS pt FROM candidate),
f AS (SELECT artist, title, a, t, row_number() OVER (PARTITION BY a, t ORDER BY (artist <> pa)::INT + (title <> pt)::INT, length(artist) + length(title), artist, title) AS rn FROM (SELECT DISTINCT artist, title, a, t, pa, pt FROM c WHERE artist IS NOT NULL AND title IS NOT NULL))
SELECT row_ord, f.artist AS canonical_artist, f.title AS canonical_title FROM c LEFT JOIN f ON f.rn = 1 AND f.a = c.a AND f.t = c.t"""
_P3_FOUND = """
WITH v AS (SELECT profile_id AS id, embedding::DOUBLE[64] AS e FROM taste_profile WHERE len(embedding) = 64 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT x.id AS a, y.id AS b, array_cosine_similarity(x.e, y.e) AS s FROM v x JOIN v y ON x.id <> y.id),
r AS (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS place FROM p WHERE s > 0.9)
SELECT l.a AS profile_id_a, l.b AS profile_id_b FROM r l JOIN r m ON l.a = m.b AND l.b = m.a WHERE l.a < l.b AND l.place <= 5 AND m.place <= 5 AND l.s >= 0.95"""
ORACLE: dict[str, str] = {
    "p1_found": _P1_FOUND,
    "p1_canonical": _P1_CANONICAL,
    "p3_found": _P3_FOUND,
    "p5_found": _P5 + "SELECT field_name, term, mark FROM marks WHERE mark IS NOT NULL",
    "p5_counts": _P5 + "SELECT field_name, term, occurrences, records, mark FROM marks",
    "p5_changes": _P5.replace("FROM genre_result", "FROM (SELECT lookup_id, CASE WHEN lookup_id % 3 = 0 THEN tags[2:] ELSE tags END AS tags FROM genre_result WHERE lookup_id % 7 <> 0)") + "SELECT field_name, term, occurrences, records, mark FROM marks WHERE field_name = 'tags'",
}
