import numpy as np

from crateflow.llm.neighbours import SmallWorld, mutual_pairs, nearest_rows

SCHEMA = "profile_id bigint, embedding array<float>, artist string, v string"


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64)).astype(np.float32)
    for i in range(0, n - 3, 10):  # small tight groups
        x[i + 1 : i + 3] = x[i] + 0.05 * rng.normal(size=(2, 64))
    return x


def brute(x, ids, k):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return {ids[i]: sorted(range(len(ids)), key=lambda j: (-s[i, j], ids[j]))[:k] for i in range(len(ids))}, s


def test_graph_recall_against_brute_force():
    x = vectors(3000)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = SmallWorld(u)
    got, _ = g.search(u[:300], 6, 48)
    s = u[:300] @ u.T
    want = np.argsort(-s, axis=1)[:, :6]
    assert np.mean([len({*a} & {*b}) / 6 for a, b in zip(got, want)]) >= 0.95
    assert all(a.shape[1] <= 2 * g.links for a in g.near)


def test_queries_against_all_rows_reach_the_recall(spark):
    x = vectors(2500, 3)
    rows = [(i, x[i].tolist(), "a", "b") for i in range(len(x))]
    df = spark.createDataFrame(rows, SCHEMA)
    near = nearest_rows(df, "profile_id", "embedding", 5, queries="profile_id % 20 = 0", shard_rows=600, margin=0.6, ef=48)
    got = {}
    for r in near.collect():
        got.setdefault(r.a, set()).add(r.b)
    want, _ = brute(x, list(range(len(x))), 5)
    assert set(got) == set(range(0, len(x), 20))
    assert np.mean([len(got[i] & set(want[i])) / 5 for i in got]) >= 0.9


def test_mutual_pairs_match_brute_force(spark):
    x = vectors(1200, 5)
    bad = [(5000, None, "a", ""), (5001, [0.0] * 64, "a", ""), (5002, [1.0] * 32, "a", ""), (5003, [float("nan")] + [1.0] * 63, "a", "")]
    df = spark.createDataFrame([(i, x[i].tolist(), None, "") for i in range(len(x))] + bad, SCHEMA)
    got = {(r.a, r.b) for r in mutual_pairs(df, "profile_id", "embedding").collect()}
    want, s = brute(x, list(range(len(x))), 5)
    assert got == {(i, j) for i in want for j in want[i] if i < j and i in want[j] and s[i, j] >= 0.95}


def test_copies_ties_and_empty_table(spark):
    v = [1.0] + [0.0] * 63
    df = spark.createDataFrame([(i, v, None, "") for i in range(1, 41)], SCHEMA)
    got = {(r.a, r.b) for r in mutual_pairs(df, "profile_id", "embedding").collect()}
    first = {i: [j for j in range(1, 41) if j != i][:5] for i in range(1, 41)}
    assert got == {(i, j) for i in first for j in first[i] if i < j and i in first[j]}
    assert mutual_pairs(df.limit(0), "profile_id", "embedding").count() == 0
    assert nearest_rows(df.limit(1), "profile_id", "embedding", 5).count() == 0


def test_two_levels_and_split_shards_reach_the_recall(spark):
    for n, seed in ((1500, 7), (4000, 8)):
        x = vectors(n, seed)
        df = spark.createDataFrame([(i, x[i].tolist(), "a", "b") for i in range(n)], SCHEMA)
        want, _ = brute(x, list(range(n)), 5)
        for levels in ({"shard_rows": 100, "most_shards": 4}, {"shard_rows": 5000, "most_rows": 300}):
            got = {}
            for r in nearest_rows(df, "profile_id", "embedding", 5, queries="profile_id % 20 = 0", margin=0.6, ef=48, **levels).collect():
                got.setdefault(r.a, set()).add(r.b)
            assert np.mean([len(got[i] & set(want[i])) / 5 for i in range(0, n, 20)]) >= 0.9
