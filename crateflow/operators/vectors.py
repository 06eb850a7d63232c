"""Exact vector operators: nearest rows of a seed, similarity walks, mean of the best against a reference set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crateflow.functions.numbers import dot
from crateflow.sources.sinks import VersionedTable, last_wins

BLOCK = 8_192
#: Values of a reference set below which every task gets the whole of it.
SMALL_VALUES = 1 << 22


def nearest_to(df: DataFrame, key: str, field: str, query: list[float], k: int) -> DataFrame:
    """k rows most similar to a vector from outside, ties by key: per-task heaps, merged."""
    q = F.array(*[F.lit(float(x)) for x in query])
    rows = df.where(F.size(field) == len(query)).select(key, dot(F.col(field), q).alias("similarity"))
    return rows.orderBy(F.desc("similarity"), key).limit(k)


def store_info(df: DataFrame, key: str, field: str, dim: int) -> DataFrame:
    """Rows, keys, dimensions and kind of a store of vectors, and how many are usable."""
    ok = (F.size(field) == dim) & F.exists(F.col(field), lambda x: x != 0)
    kind = df.schema[field].dataType.elementType.simpleString()
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"), F.lit(dim).alias("dimensions"), F.lit(kind).alias("kind"), F.count_if(F.coalesce(ok, F.lit(False))).alias("usable"))


class VectorStore:
    """Vectors by key in versions, each with the number it should hold; a version that doesn't hold as many counts as empty."""

    def __init__(self, spark: SparkSession, path: str, schema: str = "key string, vector array<float>"):
        self.data, self.index = VersionedTable(spark, f"{path}/vectors", schema), VersionedTable(spark, f"{path}/index", "rows bigint")

    def all(self) -> DataFrame:
        rows, said = self.data.read(), self.index.read().first()
        return rows if said and rows.count() == said[0] else rows.limit(0)

    def add(self, new: DataFrame) -> None:
        """New vectors take the place of held ones of the same key; of several the last by their order in ``new`` is arbitrary, so keys must be unique."""
        self.data.write(last_wins(self.all(), new, "key"))
        self.index.write(self.data.read().agg(F.count("*").alias("rows")))


def nearest(df: DataFrame, key: str, field: str, seed, k: int, restrict: DataFrame | None = None, overfetch: bool = False) -> DataFrame:
    """k rows most similar to the seed's vector, the seed left out, ties by key.

    ``overfetch``: take 4k + 1 first and restrict then, so fewer than k may come out.
    """
    held = df.where(F.col(key) == seed).select(field).limit(1).collect()
    if not held or held[0][0] is None:
        return df.select(key, F.lit(0.0).alias("similarity")).limit(0)
    q = F.array(*[F.lit(float(x)) for x in held[0][0]])
    rows = df.where(F.col(key) != seed)
    if restrict is not None and not overfetch:
        rows = rows.join(restrict.select(key), key, "left_semi")
    rows = rows.where(F.col(field).isNotNull()).select(key, dot(F.col(field), q).alias("similarity"))
    top = rows.orderBy(F.desc("similarity"), key).limit(4 * k if overfetch else k)
    if restrict is not None and overfetch:
        top = top.join(restrict.select(key), key, "left_semi").orderBy(F.desc("similarity"), key).limit(k)
    return top


def walk(df: DataFrame, key: str, field: str, seed, length: int) -> DataFrame:
    """(step, key): start at the seed, go on to the most similar row not yet used; one scan with a heap a step."""
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    rows = df.where(F.col(field).isNotNull()).select(key, field)
    at = rows.where(F.col(key) == seed).limit(1).collect()
    path = [seed] if at else []
    while at and len(path) < length:
        s = dot(F.col(field), F.array(*[F.lit(float(x)) for x in at[0][1]]))
        at = rows.where((F.size(field) == len(at[0][1])) & ~F.col(key).isin(path)).select(key, field, s.alias("_s")).orderBy(F.desc("_s"), key).limit(1).collect()
        path += [r[0] for r in at]
    return spark.createDataFrame([(i, p) for i, p in enumerate(path)], f"step int, {key} {kind}")


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def best_mean(queries: DataFrame, reference: DataFrame, key: str, field: str, k: int) -> DataFrame:
    """(key, score): mean of the k highest inner products of each query with the reference rows.

    Null vectors, and those of another length than the first reference row, have no score and count for none; k is clamped to the
    size of the reference; keys may be of any type. A reference below SMALL_VALUES values goes to every task as it is; a larger
    one is cut into blocks that each share of the queries meets once, each block giving k values a query.
    """
    kind = dict(queries.dtypes)[key]
    one = reference.where(F.col(field).isNotNull()).select(F.size(field)).first()
    empty = queries.sparkSession.createDataFrame([], f"{key} {kind}, score double")
    if one is None:
        return empty
    dim = one[0]
    full = lambda x: (F.size(x) == dim) & ~F.exists(F.col(x), lambda v: v.isNull())
    ref = reference.select(F.col(field).alias("x")).where(full("x"))
    q = queries.select(F.col(key).alias("k"), F.col(field).alias("x")).where(full("x"))
    rows = ref.count()

    def top(x: np.ndarray, r: np.ndarray) -> np.ndarray:
        n = min(k, len(r))
        return -np.partition(-(x @ r.T), n - 1, axis=1)[:, :n]

    if rows * dim <= SMALL_VALUES:
        held = _matrix(ref.toArrow().column("x"), dim)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(0, b.num_rows, 1024):
                    part = b.slice(i, 1024)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(top(_matrix(part.column(1), dim), held).mean(1))], [key, "score"])

        return q.mapInArrow(score, f"{key} {kind}, score double") if rows else empty
    blocks, shares = -(-rows // BLOCK), max(16, -(-q.count() // (8 * BLOCK)))
    left = q.withColumn("share", F.pmod(F.xxhash64("k"), F.lit(shares)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = ref.withColumn("block", F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int")).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def met(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"k": a.column("k")[:0], "s": pa.array([], pa.float64())})
        x, r = _matrix(a.column("x"), dim), _matrix(b.column("x"), dim)
        s = np.concatenate([top(x[i : i + 1024], r) for i in range(0, len(x), 1024)])
        return pa.table({"k": a.column("k").take(pa.array(np.repeat(np.arange(len(x)), s.shape[1]))), "s": pa.array(s.ravel())})

    part = left.groupBy("share", "block").cogroup(right.groupBy("share", "block")).applyInArrow(met, f"k {kind}, s double")
    ranked = part.withColumn("_r", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("s")))).where(F.col("_r") <= k)
    return ranked.groupBy(F.col("k").alias(key)).agg(F.avg("s").alias("score"))
