import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from crateflow.operators.packed import split_packed, tokenize


def test_delimiters_quotes_and_escapes():
    assert tokenize('folk|"jazz"; cinematic; Sadcore, ELECTRONIC|café music / drone') == ["folk", "jazz", "cinematic", "Sadcore", "ELECTRONIC", "café music", "drone"]
    assert tokenize("surf/'so-called \"space\" pop'/minimal") == ["surf", 'so-called "space" pop', "minimal"]
    assert tokenize('"So-Called ""Space"" Pop", "Live; Demo"') == ['So-Called "Space" Pop', "Live; Demo"]
    assert tokenize("Guitar \\| Voice, 80s\\/90s") == ["Guitar | Voice", "80s/90s"]
    assert tokenize("Neo-Classical\\\\Spoken Word\\\\sleep") == ["Neo-Classical", "Spoken Word", "sleep"]
    assert tokenize('["Caf\\u00e9 music", "a, b", null, ""]') == ["Café music", "a, b"]
    assert tokenize("“rock, soft”, Emo") == ["rock, soft", "Emo"]


def test_apostrophes_and_unclosed_marks_are_text():
    assert tokenize("r'n'b, '80s, rock") == ["r'n'b", "'80s", "rock"]
    assert tokenize('"open, rock') == ['"open', "rock"]
    assert tokenize("a [b, c") == ["a [b", "c"]
    assert tokenize("folk (soft, slow), jazz") == ["folk (soft, slow)", "jazz"]


def test_nothing_to_split():
    assert tokenize(None) == tokenize("") == tokenize("  \t ") == tokenize(",; |") == tokenize('""') == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet='ab ,;|"', min_size=1, max_size=8).filter(lambda v: v.strip() == v and v), min_size=1, max_size=6))
def test_round_trip_of_quoted_rows(values):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(values)
    assert tokenize(out.getvalue()) == [v for v in values if v]


def test_long_field_is_read_whole():
    n = 50_000
    assert len(tokenize(", ".join(f'"t{i}, x"' for i in range(n)))) == n


def test_operator_counts_repeated_rows_once(spark):
    rows = [(1, "a, b", 9), (1, "a, b", 8), (2, None, 1), (3, "  ", 1), (None, "x;y", 1), (None, "z", 1), (4, '"q, r", q', 1)]
    df = spark.createDataFrame(rows, "feature_id bigint, lastfm_tags string, k int")
    got = sorted(map(tuple, split_packed(df, "feature_id", "lastfm_tags", "tag_ord", "tag").collect()), key=str)
    assert got == sorted([(1, 1, "a"), (1, 2, "b"), (None, 1, "x"), (None, 2, "y"), (None, 1, "z"), (4, 1, "q, r"), (4, 2, "q")], key=str)
    assert split_packed(df.limit(0), "feature_id", "lastfm_tags").count() == 0
