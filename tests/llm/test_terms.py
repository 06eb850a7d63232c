from collections import Counter

from pyspark.sql import functions as F

from crateflow.llm.terms import TermStore, marked

SCHEMA = "id bigint, tags array<string>, term string"


def counts(store):
    return {r.term: (r.occurrences, r.records) for r in store.counts().collect() if r.term is not None}


def brute(rows):
    seen, occ, rec = set(), Counter(), Counter()
    for i, tags, _ in rows:
        key = (i, tuple(tags or ()))
        if key in seen:
            continue
        seen.add(key)
        terms = [" ".join(t.split()).lower() for t in tags or () if t and t.strip()]
        occ.update(terms)
    for i in {i for i, _, _ in rows}:
        rec.update({" ".join(t.split()).lower() for j, tags, _ in rows if j == i for t in tags or () if t and t.strip()})
    return {t: (occ[t], rec[t]) for t in occ}


ROWS = [(1, ["Hip  Hop", "hip hop", None, " "], "a"), (1, ["Hip  Hop", "hip hop", None, " "], "b"), (2, ["JAZZ"], "c"), (3, None, "d"), (4, [], "e"), (5, ["jazz ", " Été"], "f")]


def test_counts_match_brute_force(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    store = TermStore(spark, str(tmp_path / "a")).sync("tags", df, "id", F.col("tags"))
    assert counts(store) == brute(ROWS) == {"hip hop": (2, 1), "jazz": (2, 2), "été": (1, 1)}


def test_changes_equal_a_recount(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame(ROWS, SCHEMA)
    TermStore(spark, path).sync("tags", df, "id", F.col("tags"))
    # opened again: one record changed, one new, one deleted, one as it was, one unknown deleted
    batch = [(2, ["Rock", "rock"], "x"), (7, ["jazz"], "y"), (1, ["Hip  Hop", "hip hop", None, " "], "z")]
    gone = spark.createDataFrame([(5,), (99,), (None,)], "id bigint")
    store = TermStore(spark, path).sync("tags", spark.createDataFrame(batch, SCHEMA), "id", F.col("tags"), gone)
    after = [r for r in ROWS if r[0] not in (2, 5)] + batch[:2]
    assert counts(store) == brute(after)
    assert store.counts().where("term IS NULL").collect()[0].records == 3
    # delivered again: nothing changes
    store.sync("tags", spark.createDataFrame(batch, SCHEMA), "id", F.col("tags"), gone)
    assert counts(store) == brute(after)
    # a record that loses all its terms
    store.sync("tags", spark.createDataFrame([(7, None, "")], SCHEMA), "id", F.col("tags"))
    store.compact()
    after = [r for r in after if r[0] != 7]
    assert counts(TermStore(spark, path)) == brute(after)
    TermStore(spark, path).sync("tags", spark.createDataFrame([(7, ["jazz"], "")], SCHEMA), "id", F.col("tags"))
    assert counts(TermStore(spark, path)) == brute(after + [(7, ["jazz"], "")])


def test_marks_null_ids_and_empty_input(spark, tmp_path):
    rows = [(i, ["all"] + (["six"] if i < 6 else []) + (["few"] if i < 2 else []), "") for i in range(40)] + [(None, ["all"], "a"), (None, ["all"], "b"), (None, None, "c")]
    store = TermStore(spark, str(tmp_path / "c")).sync("tags", spark.createDataFrame(rows, SCHEMA), "id", F.col("tags"))
    assert {r.term: (r.records, r.mark) for r in marked(store.counts()).collect()} == {"all": (41, "common"), "six": (6, None), "few": (2, "rare")}
    empty = TermStore(spark, str(tmp_path / "d"))
    assert empty.counts().count() == 0
    empty.sync("tags", spark.createDataFrame([], SCHEMA), "id", F.col("tags"))
    assert marked(empty.counts()).count() == 0
