"""Problem 5: frequency of every distinct term, kept up to date by signed deltas.

Method: records are never recounted. The store holds the last version of every record as rows (record, term, times). A batch
brings records as they are now, and keys of deleted ones; its rows are compared with the stored versions of the same records
only, which tells added, changed and deleted records from those delivered again. The differences alone are aggregated, map-side
first, into signed per-term changes of occurrences and records and appended as one generation. The counts are the sum over
generations; ``compact`` folds them and drops terms whose counts have come to zero.

Files are sized by the data: rows are spread by hash and adaptive execution joins small parts. A generation counts once its
counts are wholly written; an unfinished one is written over by the next try.

Defined cases: a term is the value in lower case, trimmed, with inner white space as one space; null, empty and blank values
are no terms; a record is one distinct id of a field, so repeated rows count once and a record whose rows differ has the
terms of all of them; a row without id is a record of its own per distinct content; a term repeated inside a record counts
each time as an occurrence and once as a record; an empty batch and a batch delivered again change nothing; a record that no
longer has terms is as good as deleted; deleting an unknown key changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.session import plain_unions, scratch_path, written
from crateflow.sources.sinks import finished_folders

RARE_BELOW = 5
COMMON_ABOVE = 0.20
_COUNTS = "field_name string, term string, occurrences bigint, records bigint"
_VERSIONS = "field_name string, rec string, term string, n bigint, gen bigint"


def term(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)[\s\p{Z}]+", " "))


def record_terms(batch: DataFrame, key: str, values: Column) -> DataFrame:
    """(rec, term, n) of a batch; a record without terms has one row with a null term. Equal rows collapse map-side."""
    rows = batch.select(F.col(key).cast("string").alias("k"), F.filter(F.transform(values, term), lambda x: x.isNotNull() & (x != "")).alias("v")).distinct()
    rec = F.coalesce(F.concat(F.lit("="), "k"), F.concat(F.lit("~"), F.sha2(F.to_json(F.struct("v")), 256)))
    rows = rows.where("k IS NOT NULL OR size(v) > 0").select(rec.alias("rec"), F.explode_outer("v").alias("term"))
    return rows.groupBy("rec", "term").agg(F.count("term").alias("n"))


class TermStore:
    """Persistent record versions and per-term counts of many fields, one folder per generation."""

    def __init__(self, spark: SparkSession, path: str):
        plain_unions(spark)
        self.spark, self.path = spark, path.rstrip("/")

    def _generations(self) -> list[int]:
        """Finished generations, from the last folded one on."""
        names = finished_folders(self.spark, f"{self.path}/counts")
        folded = max((int(n[:12]) for n in names if n.endswith("-all")), default=0)
        return sorted({int(n[:12]) for n in names if int(n[:12]) >= folded})

    def _read(self, kind: str, schema: str) -> DataFrame:
        done = set(self._generations())
        names = [n for n in finished_folders(self.spark, f"{self.path}/{kind}") if int(n[:12]) in done]
        folded = max((n for n in names if n.endswith("-all")), default="")
        names = [n for n in names if n >= folded]
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/{n}" for n in names]) if names else self.spark.createDataFrame([], schema)

    def _versions(self, keys: DataFrame | None = None) -> DataFrame:
        """Rows of the last version of each record, of the given (field_name, rec) only."""
        rows = self._read("versions", _VERSIONS)
        rows = rows.join(keys, ["field_name", "rec"], "left_semi") if keys is not None else rows
        last = rows.groupBy("field_name", "rec").agg(F.max("gen").alias("gen"))
        return rows.join(last, ["field_name", "rec", "gen"], "left_semi")

    def sync(self, field_name: str, batch: DataFrame, key: str, values: Column, deleted: DataFrame | None = None) -> TermStore:
        """Bring the store to the batch's records as they are now; ``deleted`` has the keys of records that are gone."""
        done = self._generations()
        gen = 1 + (done[-1] if done else 0)
        new = record_terms(batch, key, values)
        if deleted is not None:
            gone = deleted.select(F.concat(F.lit("="), F.col(key).cast("string")).alias("rec")).where("rec IS NOT NULL").distinct()
            new = new.unionByName(gone.join(new.select("rec"), "rec", "left_anti").select("rec", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n")))
        name = F.lit(field_name).alias("field_name")
        if done:
            new = written(new, "terms-batch")
            old = self._versions(new.select(name, "rec").distinct()).where(F.col("field_name") == field_name).select("rec", "term", F.col("n").alias("was"))
            both = new.where("n > 0").join(old.where("was > 0"), ["rec", "term"], "full_outer")
            diff = written(both.select("rec", "term", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("was", F.lit(0)).alias("was")), "terms-diff")
            changed = diff.where("n <> was").select("rec").distinct()
            kept = diff.join(changed, "rec", "left_semi")
            empty = kept.groupBy("rec").agg(F.max("n").alias("m")).where("m = 0").select("rec", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"))
            version = kept.where("n > 0").select("rec", "term", "n").unionByName(empty)
        else:
            version = new.where("n > 0")
        at = f"{gen:012d}"
        version.select(name, "rec", "term", "n", F.lit(gen).cast("long").alias("gen")).write.mode("overwrite").parquet(f"{self.path}/versions/{at}")
        if not done:
            diff = self.spark.read.schema(_VERSIONS).parquet(f"{self.path}/versions/{at}").select("rec", "term", "n", F.lit(0).cast("long").alias("was"))
        held = lambda c: (F.col(c) > 0).cast("long")
        terms = diff.groupBy("term").agg(F.sum(F.col("n") - F.col("was")).alias("occurrences"), F.sum(held("n") - held("was")).alias("records"))
        # the number of records that have any term stands under the null term
        total = diff.groupBy("rec").agg(F.max(held("n")).alias("n"), F.max(held("was")).alias("was")).agg(F.coalesce(F.sum(F.col("n") - F.col("was")), F.lit(0)).alias("records"))
        total = total.select(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("occurrences"), "records")
        delta = terms.unionByName(total).where("occurrences <> 0 OR records <> 0").select(name, "term", "occurrences", "records")
        delta.repartition("field_name", "term").write.mode("overwrite").parquet(f"{self.path}/counts/{at}")
        return self

    def counts(self) -> DataFrame:
        """(field_name, term, occurrences, records); the null term holds a field's number of records."""
        sums = self._read("counts", _COUNTS).groupBy("field_name", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
        return sums.where("occurrences <> 0 OR records <> 0")

    def compact(self) -> TermStore:
        """Fold all generations of versions and counts into one."""
        done = self._generations()
        if done:
            at = f"{done[-1] + 1:012d}-all"
            self._versions().where("n > 0").write.mode("overwrite").parquet(f"{self.path}/versions/{at}")
            self.counts().repartition("field_name", "term").write.mode("overwrite").parquet(f"{self.path}/counts/{at}")
        return self


def marked(counts: DataFrame, rare_below: int = RARE_BELOW, common_above: float = COMMON_ABOVE) -> DataFrame:
    """All terms with occurrences, records and a mark (rare, common or null).

    The totals are one row per field, so their broadcast has a proven bound.
    """
    totals = counts.where("term IS NULL").select("field_name", F.col("records").alias("total"))
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.col("total") * common_above, "common")
    return counts.where("term IS NOT NULL AND records > 0").join(F.broadcast(totals), "field_name").select("field_name", "term", "occurrences", "records", mark.alias("mark"))


def term_counts(spark: SparkSession, genre_result: DataFrame, track_features: DataFrame) -> DataFrame:
    """Bring a new store to both tables, each as one batch of records, and mark its terms."""
    store = TermStore(spark, scratch_path(spark, "terms"))
    store.sync("tags", genre_result, "lookup_id", F.col("tags"))
    store.sync("genre_top", track_features, "feature_id", F.array("genre_top"))
    return marked(store.counts())


def changed_counts(spark: SparkSession, genre_result: DataFrame) -> DataFrame:
    """The look-ups arrive, then every third one without its first tag, then every seventh is deleted; the last batch comes twice."""
    store = TermStore(spark, scratch_path(spark, "terms"))
    store.sync("tags", genre_result, "lookup_id", F.col("tags"))
    third = genre_result.where("lookup_id % 3 = 0").withColumn("tags", F.slice("tags", F.lit(2), F.greatest(F.size("tags") - 1, F.lit(0))))
    for _ in range(2):
        store.sync("tags", third, "lookup_id", F.col("tags"))
        store.sync("tags", genre_result.limit(0), "lookup_id", F.col("tags"), genre_result.where("lookup_id % 7 = 0"))
        third = third.where("lookup_id % 7 <> 0")
    return marked(store.compact().counts())
