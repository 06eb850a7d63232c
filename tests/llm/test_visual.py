from crateflow.llm.visual import canonical_forms, same_in_print

SCHEMA_C = "row_ord bigint, artist string, title string, k string"
SCHEMA_T = "track_key string, artist string, title string, seen_a string"


def run(spark, cand, tracks):
    return sorted(map(tuple, same_in_print(spark.createDataFrame(cand, SCHEMA_C), spark.createDataFrame(tracks, SCHEMA_T)).collect()))


def test_characters_that_print_alike(spark):
    tracks = [("k1", "Café Noir", "Tall Tower", "x"), ("k2", "コヨ・ハハソ", "Window", "x"), ("k3", "Нортев", "Die Straße", "x")]
    cand = [
        (1, "Café Noir", "Tall Tower", "a"),  # the same characters: no case
        (2, "Café Noir", "Tall Tower", "a"),
        (3, "Ｃａｆé　Noir", "T­all​ Tower", "a"),
        (4, "Саfé Nоir", "Tall Tower", "a"),  # Cyrillic letters
        (5, "Cafe Noir", "Tall Tower", "a"),  # the accent counts
        (6, "CAFÉ NOIR", "Tall Tower", "a"),  # case counts
        (7, "ｺﾖ･ﾊﾊｿ", "Window", "a"),
        (8, "Hортев", "Die Straße", "a"),  # Latin letter
        (9, "Нортев", "Die Strasse", "a"),  # spelling counts
        (10, None, "Window", "a"), (11, "", "", "a"), (12, "Café Noir", None, "a"),
    ]
    assert run(spark, cand, tracks) == [(2, "k1"), (3, "k1"), (4, "k1"), (7, "k2"), (8, "k3")]


def test_repeats_ties_and_empty_tables(spark):
    tracks = [("k1", "A", "Fﬁx", "x"), ("k1", "A", "Fﬁx", "x")]
    assert run(spark, [(1, "A", "Ffix", "a"), (1, "A", "Ffix", "b"), (2, "A", "Ffix", None)], tracks) == [(1, "k1"), (2, "k1")]
    assert run(spark, [], tracks) == run(spark, [(1, "A", "Ffix", "a")], []) == []
    long = "а" * 200_000
    assert run(spark, [(1, long, "t", "a")], [("k", "a" * 200_000, "t", "x")]) == [(1, "k")]


def test_canonical_form_is_one_per_class(spark):
    df = spark.createDataFrame([(1, "Zoë", "x", ""), (2, "Zoë", "x", ""), (3, "Zoe", "x", ""), (4, None, "x", "")], SCHEMA_C)
    got = {r.row_ord: r.canonical_artist for r in canonical_forms(df, ["row_ord"]).collect()}
    assert got[1] == got[2] and got[3] == "Zoe" and got[4] is None


def test_letters_with_marks_and_number_forms(spark):
    tracks = [("k1", "Cöre", "Tóny", "x"), ("k2", "Part IV", "Ëve", "x")]
    cand = [(1, "Cӧre", "Tóny", ""), (2, "Cöre", "Tόny", ""), (3, "Part Ⅳ", "Ёve", ""), (4, "Part VI", "Ëve", ""), (5, "Cöre", "Tony", "")]
    assert run(spark, cand, tracks) == [(1, "k1"), (2, "k1"), (3, "k2")]
