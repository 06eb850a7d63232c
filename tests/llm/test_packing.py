from hypothesis import given, settings
from hypothesis import strategies as st

from crateflow.llm.packing import first_fit_decreasing, pack


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_tournament_tree_equals_a_scan(sizes):
    sizes = sorted(sizes, reverse=True)
    rooms, want = [], []
    for s in sizes:
        at = next((i for i, r in enumerate(rooms) if r >= s), len(rooms))
        if at == len(rooms):
            rooms.append(100)
        rooms[at] -= s
        want.append(at)
    assert first_fit_decreasing(sizes, 100) == want


def test_every_token_in_one_piece_and_no_container_overfull(spark):
    rows = [(i, (i * 37) % 300, "c") for i in range(600)] + [(1000, 4096, ""), (1001, 5000, ""), (1002, None, ""), (1003, 0, ""), (7, 50, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, container string")
    got = pack(df, "doc_id", "tokens", 2048, 200).collect()
    assert sum(r.size for r in got) == sum(r[1] or 0 for r in rows)
    fill = {}
    for r in got:
        fill[r.container] = fill.get(r.container, 0) + r.size
    assert max(fill.values()) <= 2048
    assert len(fill) <= -(-sum(fill.values()) // 2048) + 4
    cut = sorted((r.piece, r.start, r.size) for r in got if r.doc_id == 1001)
    assert cut == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 904)]
    assert sorted((r.start, r.size) for r in got if r.doc_id == 1000) == [(0, 2048), (2048, 2048)]
    assert all(r.piece == 0 for r in got if r.doc_id not in (1000, 1001))
    assert pack(df.limit(0), "doc_id", "tokens").count() == 0
