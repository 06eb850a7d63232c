"""Problem 9: texts into containers of fixed capacity, first-fit decreasing with a tournament tree.

Method: sizes are counts of tokens of a public tokenizer. A text larger than the capacity is cut into full pieces and
a rest; full pieces have a container of their own. All other pieces go, by a hash of their key, place and size, into randomised
groups of bounded size; each group is packed on its own, largest piece first, each into the first container with
room. A tournament tree over the rooms of the group's containers finds that container in logarithmic time.

Defined cases: texts without tokens (null, empty) need no place and have no row; ties of size are broken by key and
place; repeated keys are pieces of their own; a piece as large as the capacity fills a container; an empty table
gives no rows. Every token is in exactly one piece, every piece in exactly one container.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.session import written

CAPACITY = 2_048
#: Expected pieces of a group: enough for a good fit, few enough for one task.
GROUP_PIECES = 8_192


class Rooms:
    """Tournament tree over the room left in containers; the leftmost with enough room wins."""

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, (max(most, 1) - 1).bit_length())
        self.capacity = capacity
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        t, i = self.tree, 1
        while i < self.leaves:
            i *= 2
            if t[i] < size:
                i += 1
        at = i - self.leaves
        t[i] -= size
        while i > 1:
            i //= 2
            t[i] = t[2 * i] if t[2 * i] >= t[2 * i + 1] else t[2 * i + 1]
        return at


def first_fit_decreasing(sizes: Iterable[int], capacity: int) -> list[int]:
    """Container of each size, sizes given largest first."""
    sizes = list(sizes)
    rooms = Rooms(capacity, len(sizes))
    return [rooms.place(s) for s in sizes]


def pack(sizes: DataFrame, key: str, size: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, seed: int = 17) -> DataFrame:
    """(container, key, piece, start, size): pieces of the sized items and their containers."""
    items = sizes.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n")).where("n > 0")
    pieces = items.select("k", F.explode(F.transform(F.sequence(F.lit(0), ((F.col("n") - 1) / capacity).cast("long")), lambda j: F.struct(j.cast("int").alias("piece"), (j * capacity).alias("start"), F.least(F.lit(capacity), F.col("n") - j * capacity).alias("size")))).alias("p")).select("k", "p.*")
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    part = pieces.where(F.col("size") < capacity)
    groups = max(1, math.ceil(part.count() / group_pieces))
    # groups follow from key, place and size alone, so containers don't depend on how files are cut
    part = part.withColumn("home", F.pmod(F.xxhash64("k", "piece", "size", F.lit(seed)), F.lit(groups)))
    # one key in very many rows fills a group: such groups are split by row
    crowded = part.groupBy("home").agg(F.count("*").alias("n")).where(F.col("n") > 4 * group_pieces)
    part = part.join(crowded.select("home", F.ceil(F.col("n") / group_pieces).cast("int").alias("ways")), "home", "left")
    part = part.withColumn("grp", F.concat_ws(".", "home", F.pmod(F.xxhash64("row"), F.col("ways"))))

    def one(t: pa.Table) -> pa.Table:
        t = t.sort_by([("size", "descending"), ("k", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        at = first_fit_decreasing(t.column("size").to_pylist(), capacity)
        group = t.column("grp")[0].as_py()
        names = pa.array([f"{group}-{a}" for a in at], pa.string())
        return pa.table({"container": names, "k": t.column("k"), "piece": t.column("piece"), "start": t.column("start"), "size": t.column("size")})

    kind = dict(pieces.dtypes)["k"]
    packed = part.groupBy("grp").applyInArrow(one, f"container string, k {kind}, piece int, start bigint, size bigint")
    full = pieces.where(F.col("size") == capacity).select(F.concat(F.lit("full-"), F.col("row").cast("string")).alias("container"), "k", "piece", "start", "size")
    return packed.unionByName(full).withColumnRenamed("k", key)
