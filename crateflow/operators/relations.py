"""Relational operators: deduplication, ranked heads and caps, look-ups, set differences, samples, upserts.

Orders are always total: callers give the columns that break ties. No operator sorts a whole table in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """First row of each key; the window's limit is pushed below the shuffle, so hot keys are cut map-side."""
    return head_of_groups(df, keys, order, 1)


def head_of_groups(df: DataFrame, keys: list, order: list, n: int) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def later_claims(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Rows whose key an earlier row holds already."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn > 1").drop("_rn")


def capped(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of a total order: per-task heaps, merged."""
    return df.orderBy(*order).limit(n)


def sources_union(frames: list[DataFrame], ordinal: str = "src_ord") -> DataFrame:
    """All rows of the sources with the place of their source."""
    return reduce(DataFrame.unionByName, [f.withColumn(ordinal, F.lit(i)) for i, f in enumerate(frames)])


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_anti")


def only_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_semi")


def looked_up(df: DataFrame, other: DataFrame, key: str, order: list, value: str, name: str) -> DataFrame:
    """Each row with the value of the first row of ``other`` that has its key, or null; ``other`` is reduced map-side first."""
    first = other.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(name))
    return df.join(first, key, "left")


def unique_match(df: DataFrame, other: DataFrame, key: str, value: str) -> DataFrame:
    """Value where exactly one row of ``other`` has the key, else null."""
    one = other.groupBy(key).agg(F.count("*").alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")
    return df.join(one, key, "left")


def duplicate_classes(df: DataFrame, by: str, key: str, order: list) -> DataFrame:
    """Each row with the first key of its class of equal ``by`` and the class's number of rows; classes aren't expanded to pairs."""
    c = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.min_by(key, F.struct(*order)).alias("class_key"), F.count("*").alias("class_rows"))
    return df.join(c, by)


def cached_or(df: DataFrame, cache: DataFrame, key: str, value: str, fetched: str, now: float, ttl: float) -> DataFrame:
    """Rows with the cached value if it is fresh; an empty cached list is an answer."""
    fresh = cache.where(F.lit(now) - F.col(fetched) <= ttl).groupBy(key).agg(F.max_by(value, F.col(fetched)).alias("cached"), F.lit(True).alias("hit"))
    return df.join(fresh, key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def upserted(old: DataFrame, new: DataFrame, key: str, keep: list[str], take: list[str], order: list, reset: dict[str, Column] | None = None) -> DataFrame:
    """Old rows updated and new ones added: ``keep`` columns stay as they were, ``take`` columns come from the new row.

    ``reset`` columns are set to a value wherever a new row comes.
    """
    last = new.groupBy(key).agg(*(F.max_by(c, F.struct(*order)).alias(f"new_{c}") for c in [*keep, *take]), F.lit(True).alias("_new"))
    both = old.join(last, key, "full_outer")
    cols = [F.coalesce(c, f"new_{c}").alias(c) for c in keep] + [F.when(F.col("_new"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in take]
    cols += [F.when(F.col("_new"), v).otherwise(F.col(c)).alias(c) for c, v in (reset or {}).items()]
    return both.select(key, *cols)


def soft_deleted(df: DataFrame, gone: DataFrame, key: str, at: str, now: float, clear: list[str]) -> DataFrame:
    marks = gone.select(key).distinct().withColumn("_gone", F.lit(True))
    both = df.join(marks, key, "left")
    out = both.withColumn(at, F.when(F.col("_gone"), F.lit(now)).otherwise(F.col(at)))
    for c in clear:
        out = out.withColumn(c, F.when(F.col("_gone").isNull(), F.col(c)))
    return out.drop("_gone")


def counted(base: DataFrame, events: DataFrame, key: str, count: str) -> DataFrame:
    """Counters raised by the events of known keys."""
    add = events.groupBy(key).agg(F.count("*").alias("_add"))
    return base.join(add, key, "left").withColumn(count, F.coalesce(F.col(count), F.lit(0)) + F.coalesce("_add", F.lit(0))).drop("_add")


def after_cursor(events: DataFrame, at: str, cursor: float) -> DataFrame:
    """Events later than the cursor; all if it is 0 or less."""
    return events.where(F.col(at) > cursor) if cursor > 0 else events


def global_ranks(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Places from 0 in a total order, without a single-task window: range partitions, their sizes, places within."""
    from crateflow.session import written

    parts = written(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranks")
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    # one row per partition: the window over them is small
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_off")
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return parts.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_off") + inside - 1).drop("_p", "_off")


def strided(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """Every step-th row of the order, ``count`` at most."""
    ranked = global_ranks(df, order)
    step = max(1, df.count() // count)
    return ranked.where((F.col("rank") % step == 0) & (F.col("rank") < step * count)).drop("rank")


def rotated(df: DataFrame, order: list[str], start: int, take: int) -> tuple[DataFrame, int]:
    """``take`` rows from place ``start`` on, around the end, and the next start."""
    n = df.count()
    ranked = global_ranks(df, order)
    return ranked.where(F.pmod(F.col("rank") - start, F.lit(max(n, 1))) < take).drop("rank"), (start + take) % n if n else 0


def round_robin(df: DataFrame, group: str, within: str, order: list, n: int) -> DataFrame:
    """n rows per group, taken in turns from its parts."""
    depth = F.row_number().over(Window.partitionBy(group, within).orderBy(*order))
    # more than n rows of one part are never needed; this cut works before the shuffle
    df = df.withColumn("_depth", depth).where(F.col("_depth") <= n)
    return df.withColumn("_turn", F.row_number().over(Window.partitionBy(group).orderBy("_depth", within, *order))).where(F.col("_turn") <= n).drop("_depth", "_turn")


def names_of(structs: Column) -> Column:
    """Distinct names of a list of structs, without blanks."""
    return F.array_distinct(F.filter(F.transform(structs, lambda p: p["name"]), lambda n: n.isNotNull() & (n != "")))


def create_missing(want: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Wanted rows with what is to be done: create those that aren't there, skip the others."""
    held = there.select(key).distinct().withColumn("_there", F.lit(True))
    return want.join(held, key, "left").select(key, F.when(F.col("_there"), "skipped").otherwise("create").alias("op"))


def ordered_distinct(c: Column) -> Column:
    """Lower-case, trimmed distinct values in order, without blanks."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != "")))


def first_blocked(tags: Column, blocked: list[str]) -> Column:
    return F.get(F.filter(tags, lambda t: t.isin(blocked)), F.lit(0))


def first_reason(*rules: tuple[Column, str | Column]) -> Column:
    """Reason of the first rule that holds, or null."""
    out = F.lit(None).cast("string")
    for cond, reason in reversed(rules):
        out = F.when(cond, reason if isinstance(reason, Column) else F.lit(reason)).otherwise(out)
    return out


def exact_percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Linear-interpolated percentiles with count, minimum and maximum.

    Values are counted first, before the shuffle; a running sum over the distinct values of a group tells which hold the wanted
    places, so no task buffers a group. The two values around a place are its ceiling's and its floor's.
    """
    rows = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    total = rows.groupBy(*by).agg(F.sum("_c").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"))
    upto = rows.withColumn("_e", F.sum("_c").over(Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    both = upto.join(F.broadcast(total) if not by else total, by) if by else upto.crossJoin(total)
    first = {}
    for name, share in shares.items():
        at = F.lit(share) * (F.col("n") - 1)
        for end, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            first[f"{name}_{end}"] = F.min(F.when(F.col("_e") > place, F.col("_v")))
    got = both.groupBy(*by, "n", "least", "most").agg(*(v.alias(k) for k, v in first.items()))
    part = lambda s: F.lit(s) * (F.col("n") - 1) - F.floor(F.lit(s) * (F.col("n") - 1))
    out = [(F.col(f"{k}_lo") + (F.col(f"{k}_hi") - F.col(f"{k}_lo")) * part(s)).alias(k) for k, s in shares.items()]
    return got.select(*by, "n", "least", *out, "most")
