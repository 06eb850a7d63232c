"""Problem 3: the k most similar vectors of every vector, by a navigable small-world graph per shard.

Method: coarse centroids, fitted on a bounded sample, cut the collection into shards. Inside each shard a
hierarchical navigable small-world graph is built: levels are drawn geometrically, every level's links lie in one
flat neighbour array, and links are chosen by the usual diversity rule. Every row is searched in its own shard and
in the shards whose centroid is nearly as near; the shards' results are merged to the global top k. Building and
searching run in lock-step over batches of rows, so all arithmetic is in NumPy on contiguous arrays.

Rows of equal vectors: of each group of identical vectors only the k + 1 smallest ids are indexed. Ties are broken by
id, so no other copy can be among anybody's k nearest; this is exact and keeps a hot vector out of one task.

Defined cases: null, all-zero, short, long or non-finite vectors have no neighbours; a row is never its own neighbour;
ties go to the smaller id; ids must be unique, repeated ids count once; an empty table gives no rows; each shard larger than
``MOST_ROWS`` is split by id hash and its results merged, so no group is unbounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crateflow.session import written

DIM = 64
#: Bound of the sample that the coarse centroids are fitted on; every row is indexed.
SAMPLE_ROWS = 20_000
SHARD_ROWS = 4_096
#: Cells of the first level; a larger collection has a second level of as many shards in each as its rows ask for.
MOST_SHARDS = 1_024
#: Rows of a cell for each shard of it that its own centroids are fitted on, and rows that one task routes there.
FINE_SAMPLE, ROUTE_ROWS = 32, 1 << 17
#: Rows of a shard beyond which it is split.
MOST_ROWS = 1 << 15
LINKS = 20
EF_BUILD = 24
EF_SEARCH = 12
ENTRIES = 4
#: A further shard is searched if its squared distance exceeds the nearest one's by no more than this.
MARGIN = 0.08
BATCH = 1_024


class SmallWorld:
    """Hierarchical navigable small-world graph over unit vectors; similarity is the inner product."""

    def __init__(self, x: np.ndarray, links: int = LINKS, ef: int = EF_BUILD, seed: int = 7):
        self.x, self.links, self.ef = np.ascontiguousarray(x, dtype=np.float32), links, ef
        n = len(x)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n) + 1e-12) / math.log(links)).astype(int) if n else np.zeros(0, int)
        order = np.argsort(-level, kind="stable")
        self.ids = order  # place in the graph -> row; rows of high levels come first, so each level is a prefix
        self.x = self.x[order]
        top = int(level.max()) if n else 0
        self.sizes = [int((level >= at).sum()) for at in range(top + 1)]
        while len(self.sizes) > 1 and self.sizes[-1] < links:
            self.sizes.pop()
        self.near: list[np.ndarray] = [np.zeros((0, 0), np.int32)] * len(self.sizes)
        for at in range(len(self.sizes) - 1, -1, -1):
            self._build(at)

    def _build(self, at: int) -> None:
        n, wide = self.sizes[at], 2 * self.links if at == 0 else self.links
        near, sims = np.full((n, wide), -1, np.int32), np.full((n, wide), -2, np.float32)
        self.near[at] = near
        done = 0
        while done < n:
            b = min(BATCH, max(done, 64), n - done)
            q = self.x[done : done + b]
            inner = q @ q.T
            np.fill_diagonal(inner, -2)
            take = min(b, self.ef)
            ids = np.argpartition(-inner, take - 1, axis=1)[:, :take]
            cs, ids = np.take_along_axis(inner, ids, 1), (ids + done).astype(np.int32)
            ids[cs <= -2] = -1
            if done:
                found, fs = self._beam(at, q, self._entries(at, q, done), self.ef, done)
                ids, cs = np.concatenate([found, ids], 1), np.concatenate([fs, cs], 1)
            keep = np.argsort(-cs, axis=1, kind="stable")[:, : self.ef]
            ids, cs = np.take_along_axis(ids, keep, 1), np.take_along_axis(cs, keep, 1)
            ids, cs = self._diverse(ids, cs, wide)
            near[done : done + b, : ids.shape[1]], sims[done : done + b, : ids.shape[1]] = ids, cs
            self._link_back(near, sims, np.repeat(np.arange(done, done + b, dtype=np.int32), ids.shape[1]), ids.ravel(), cs.ravel())
            done += b

    def _diverse(self, ids: np.ndarray, cs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefer candidates nearer to the row than to any candidate already taken; fill up with the rest by similarity."""
        v = self.x[np.maximum(ids, 0)]
        among = v @ v.transpose(0, 2, 1)
        taken = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            hidden = (taken[:, :j] & (among[:, j, :j] > cs[:, j, None])).any(1) if j else np.zeros(len(ids), bool)
            taken[:, j] = ~hidden & (ids[:, j] >= 0)
        keep = np.argsort(~taken, axis=1, kind="stable")[:, :most]
        ids, cs = np.take_along_axis(ids, keep, 1), np.take_along_axis(cs, keep, 1)
        return ids, np.where(ids >= 0, cs, -2)

    @staticmethod
    def _link_back(near: np.ndarray, sims: np.ndarray, src: np.ndarray, dst: np.ndarray, s: np.ndarray) -> None:
        ok = dst >= 0
        src, dst, s = src[ok], dst[ok], s[ok]
        rows = np.unique(dst)
        wide = near.shape[1]
        u = np.concatenate([np.repeat(rows, wide), dst])
        v = np.concatenate([near[rows].ravel(), src])
        w = np.concatenate([sims[rows].ravel(), s])
        ok = v >= 0
        u, v, w = u[ok], v[ok], w[ok]
        _, first = np.unique(u.astype(np.int64) << 32 | v, return_index=True)
        u, v, w = u[first], v[first], w[first]
        o = np.lexsort((v, -w, u))
        u, v, w = u[o], v[o], w[o]
        rank = np.arange(len(u)) - np.maximum.accumulate(np.where(np.r_[True, u[1:] != u[:-1]], np.arange(len(u)), 0))
        ok = rank < wide
        near[rows], sims[rows] = -1, -2
        near[u[ok], rank[ok]], sims[u[ok], rank[ok]] = v[ok], w[ok]

    def _entries(self, at: int, q: np.ndarray, most: int) -> np.ndarray:
        """Good starts on level ``at``: greedy descent through the finished levels above."""
        if at + 1 >= len(self.sizes):
            n = min(most, max(self.links, 64))
            s = q @ self.x[:n].T
            return np.argpartition(-s, min(ENTRIES, n) - 1, axis=1)[:, :ENTRIES].astype(np.int32)
        start = self._entries(at + 1, q, self.sizes[at + 1])
        ids, _ = self._beam(at + 1, q, start, ENTRIES, self.sizes[at + 1])
        return np.where(ids < most, ids, -1)

    def _beam(self, at: int, q: np.ndarray, start: np.ndarray, ef: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all rows of ``q`` at once among the first ``most`` nodes; results sorted by similarity."""
        near, x, n = self.near[at], self.x, self.sizes[at]
        step = max(16, min(len(q), (1 << 25) // max(1, n)))
        if len(q) > step:
            parts = [self._beam(at, q[i : i + step], start[i : i + step], ef, most) for i in range(0, len(q), step)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        b = len(q)
        ids, cs = np.full((b, ef), -1, np.int32), np.full((b, ef), -2, np.float32)
        opened = np.ones((b, ef), bool)
        s = np.einsum("bmd,bd->bm", x[np.maximum(start, 0)], q)
        w = start.shape[1]
        ids[:, :w], cs[:, :w], opened[:, :w] = start, np.where(start >= 0, s, -2), start < 0
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        r, c = np.nonzero(start >= 0)
        seen[r, start[r, c]] = True
        live = rows
        while len(live):
            c = np.where(opened[live], -3, cs[live])
            j = c.argmax(1)
            go = c[np.arange(len(live)), j] > -2
            live, j = live[go], j[go]
            if not len(live):
                break
            opened[live, j] = True
            nb = near[ids[live, j]]
            safe = np.maximum(nb, 0)
            new = (nb >= 0) & ~seen[live[:, None], safe]
            seen[live[:, None], safe] = True
            s = np.where(new, (x[safe] @ q[live][:, :, None])[:, :, 0], -2)
            gain = s.max(1) > cs[live].min(1)
            if not gain.all():
                g = np.flatnonzero(gain)
                nb, s, into = nb[g], s[g], live[g]
            else:
                into = live
            if len(into):
                ai, ac = np.concatenate([ids[into], nb], 1), np.concatenate([cs[into], s], 1)
                ao = np.concatenate([opened[into], s <= -2], 1)
                keep = np.argpartition(-ac, ef - 1, axis=1)[:, :ef]
                ids[into], cs[into], opened[into] = np.take_along_axis(ai, keep, 1), np.take_along_axis(ac, keep, 1), np.take_along_axis(ao, keep, 1)
        ids = np.where(cs > -2, ids, -1)
        o = np.argsort(-cs, axis=1, kind="stable")
        return np.take_along_axis(ids, o, 1), np.take_along_axis(cs, o, 1)

    def search(self, q: np.ndarray, k: int, ef: int = EF_SEARCH, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and similarities of the k best of every query; -1 where there are fewer.

        ``own`` holds the row that each query is in this graph: its search then starts at its own node.
        """
        n = self.sizes[0] if self.sizes else 0
        if not n or not len(q):
            return np.full((len(q), k), -1), np.full((len(q), k), -2.0)
        q = np.ascontiguousarray(q, dtype=np.float32)
        place = np.empty(n, np.int32)
        place[self.ids] = np.arange(n)
        out_i, out_s = [], []
        for i in range(0, len(q), BATCH):
            start = self._entries(0, q[i : i + BATCH], n) if own is None else place[own[i : i + BATCH]][:, None]
            ids, cs = self._beam(0, q[i : i + BATCH], start, max(ef, k), n)
            out_i.append(np.where(ids[:, :k] >= 0, self.ids[np.maximum(ids[:, :k], 0)], -1))
            out_s.append(cs[:, :k])
        return np.concatenate(out_i), np.concatenate(out_s)


def _vectors(col: pa.ChunkedArray | pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable entries and their places."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size = col.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == dim)
    if not len(at):
        return np.zeros((0, dim), np.float32), at
    v = col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    norm = np.sqrt((v * v).sum(1))
    ok = np.isfinite(norm) & (norm > 0)
    return (v[ok] / norm[ok, None]).astype(np.float32), at[ok]


def fit_centroids(sample: np.ndarray, shards: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Lloyd's algorithm from random sample rows; dense regions get more centroids."""
    shards = max(1, min(shards, len(sample)))
    c = sample[np.random.default_rng(seed).choice(len(sample), shards, replace=False)] if len(sample) else np.zeros((1, DIM), np.float32)
    for _ in range(rounds if shards > 1 else 0):
        near = np.argmax(sample @ c.T - 0.5 * (c * c).sum(1), axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        n = np.bincount(near, minlength=shards)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c).astype(np.float32)
    return c


def _fitted(rows: DataFrame, total: int, shards: int, dim: int) -> np.ndarray:
    """Centroids from a sample of at most SAMPLE_ROWS rows, chosen by id hash; the share is of 2^62, so it never comes to nothing."""
    most = int(min(1.0, SAMPLE_ROWS / max(total, 1)) * (1 << 62))
    got = rows.where(F.shiftrightunsigned(F.xxhash64("id", F.lit(3)), 2) <= most).select("v").limit(SAMPLE_ROWS).toArrow()
    return fit_centroids(_vectors(got.column(0), dim)[0], shards)


def _near_cells(x: np.ndarray, cents: np.ndarray, margin: float, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid of each row, which centroids it goes to): queries also to those nearly as near."""
    g = 2 * (0.5 * (cents * cents).sum(1) - x @ cents.T)
    home = g.argmin(1)
    close = (g <= g[np.arange(len(g)), home][:, None] + margin) & ask[:, None]
    return home, close


_ROUTED = "shard bigint, id bigint, x binary, member boolean, asked boolean"


def _batch(shard, ids, x, member, ask) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(ids, pa.int64()), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(member, pa.bool_()), pa.array(ask, pa.bool_())], ["shard", "id", "x", "member", "asked"])


def _table(t: pa.Table, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("x").to_pylist()), np.float32).reshape(-1, dim)


def _finer(routed: DataFrame, total: int, coarse: int, shard_rows: int, margin: float, dim: int) -> DataFrame:
    """Rows of coarse cells in finer shards: each cell has centroids of its own, fitted on a sample of its rows by the executors."""
    share = min(1.0, FINE_SAMPLE / shard_rows)
    sample = routed.where(F.col("member") & (F.shiftrightunsigned(F.xxhash64("id", F.lit(5)), 2) <= int(share * (1 << 62))))

    def fit(t: pa.Table) -> pa.Table:
        c = fit_centroids(_table(t, dim), round(len(t) / share / shard_rows))
        return pa.table({"shard": pa.array([t.column("shard")[0].as_py()] * len(c), pa.int64()), "c": pa.array([v.astype(np.float32).tobytes() for v in c], pa.binary())})

    cents = written(sample.groupBy("shard").applyInArrow(fit, "shard bigint, c binary"), "vector-centroids")
    salts = max(1, math.ceil(4 * total / coarse / ROUTE_ROWS))

    def route(rows: pa.Table, held: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.Table.from_batches([_batch([], [], [], [], [])])
        # the same cell fits the same centroids in any order of its sample, as they are sorted here
        c = np.frombuffer(b"".join(sorted(held.column("c").to_pylist())), np.float32).reshape(-1, dim) if len(held) else np.zeros((1, dim), np.float32)
        x, member, ask, ids = _table(rows, dim), rows.column("member").to_numpy(), rows.column("asked").to_numpy(), rows.column("id").to_numpy()
        home, close = _near_cells(x, c, margin, ask)
        close[np.arange(len(x)), home] = True
        i, k = np.nonzero(close)
        return pa.Table.from_batches([_batch(rows.column("shard").to_numpy()[i] << 24 | k, ids[i], x[i], member[i] & (k == home[i]), ask[i])])

    left = routed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    right = cents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.groupBy("shard", "salt").cogroup(right.groupBy("shard", "salt")).applyInArrow(route, _ROUTED)


def nearest_rows(df: DataFrame, key: str, field: str, k: int, *, queries: str | None = None, least: float = -1.0, margin: float = MARGIN, ef: int = EF_SEARCH, dim: int = DIM, shard_rows: int = SHARD_ROWS, links: int = LINKS, most_shards: int = MOST_SHARDS, most_rows: int = MOST_ROWS) -> DataFrame:
    """(a, b, cosine, place): for every query row a its k most similar rows b, places from 1.

    ``queries`` is a SQL condition on the input that says which rows are asked for (all by default); ``least`` drops
    pairs below a cosine inside the shards. ``margin`` says how many further shards are searched.
    """
    asked = F.expr(queries) if queries else F.lit(True)
    rows = df.where(F.col(key).isNotNull() & (F.size(field) == dim)).select(F.col(key).cast("long").alias("id"), F.col(field).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    copies = Window.partitionBy(F.xxhash64("v")).orderBy("id")
    total = rows.count()
    shards = max(1, math.ceil(total / shard_rows))
    cents = _fitted(rows, total, min(shards, most_shards), dim)
    base = rows.withColumn("copy", F.row_number().over(copies))
    base = base.where(F.col("copy") <= k + 1) if not queries else base.where((F.col("copy") <= k + 1) | F.col("asked"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            x, at = _vectors(r.column(1), dim)
            if not len(at):
                continue
            ids, ask = r.column(0).to_numpy()[at], r.column(2).to_numpy(zero_copy_only=False)[at]
            first = r.column(3).to_numpy()[at] <= k + 1
            home, close = _near_cells(x, cents, margin, ask)
            close[np.arange(len(x)), home] = first | ask
            i, c = np.nonzero(close)
            yield _batch(c, ids[i], x[i], (c == home[i]) & first[i], ask[i])

    def in_shard(t: pa.Table) -> pa.Table:
        ids, x = t.column("id").to_numpy(), _table(t, dim)
        member, ask = t.column("member").to_numpy(), t.column("asked").to_numpy()
        o = np.argsort(ids[member], kind="stable")
        base_ids, mine = ids[member][o], ask[member][o]
        vectors = x[member][o]
        graph = SmallWorld(vectors, links=links)
        guests = ask & ~member
        parts = []
        for who, q, own in ((base_ids[mine], vectors[mine], np.flatnonzero(mine)), (ids[guests], x[guests], None)):
            got, sims = graph.search(q, k + 1, ef, own)
            a = np.repeat(who, got.shape[1])
            b = base_ids[np.maximum(got.ravel(), 0)] if len(base_ids) else np.zeros(len(a), np.int64)
            ok = (got.ravel() >= 0) & (a != b) & (sims.ravel() >= least)
            parts.append(pa.table({"a": a[ok], "b": b[ok], "cosine": sims.ravel()[ok].astype(np.float64)}))
        return pa.concat_tables(parts)

    routed = base.select("id", "v", "asked", "copy").mapInArrow(route, _ROUTED)
    if shards > most_shards:
        routed = _finer(written(routed, "vector-cells"), total, len(cents), shard_rows, margin, dim)
    routed = written(routed, "vector-shards")
    # shards that came out too large are split by id, each on its own; members live in one part, queries visit all
    sizes = routed.where("member").groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > most_rows)
    split = routed.join(sizes.select("shard", F.ceil(F.col("n") / most_rows).cast("int").alias("parts")), "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("id", F.lit(9)), F.col("parts")).cast("int")
    split = split.withColumn("own", own).withColumn("part", F.explode(F.when(F.col("asked"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))))
    split = split.select("shard", "part", "id", "x", (F.col("member") & (F.col("part") == F.col("own"))).alias("member"), "asked")
    found = split.groupBy("shard", "part").applyInArrow(in_shard, "a bigint, b bigint, cosine double")
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return found.distinct().withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def mutual_pairs(df: DataFrame, key: str, field: str, k: int = 5, least: float = 0.95) -> DataFrame:
    """(a, b) with a < b whose cosine is at least ``least`` and that are each among the other's k nearest rows.

    Whoever of a pair found the other, the link counts for both: all rows nearer than a partner at ``least`` or more
    are such links themselves, so ranking the links alone is enough.
    """
    near = nearest_rows(df, key, field, k, least=least)
    links = near.select("a", "b", "cosine").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    links = links.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    ranked = links.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    return ranked.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("n")).where("n = 2").select("a", "b")
