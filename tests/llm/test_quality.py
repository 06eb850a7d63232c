from functools import reduce

from hypothesis import given, settings
from hypothesis import strategies as st

from crateflow.llm.quality import FIELDS, LOOK, PIECE, chunk_state, finished, merged, not_prose, text_statistics

PROSE = "The drums come in late, which is a risk, yet it pays off when the organ answers them. She sings as if the village were listening."
TABLE = "score\tartist\tno\n0.84\tNorth Quartet\t1\n0.18\tDJ Lolo\t2\n0.82\tThe Wolves\t3"
LIST = "Wandering Postcard\nHonest Thistle Swallow\nWhen the Button Returns\nHollow Noon for Ursula\nCold Spider"


def states(text, chunk):
    return [chunk_state(text[max(0, at - 2) : at], text[at : at + chunk], text[at + chunk : at + chunk + LOOK], at) for at in range(0, max(len(text), 1), chunk)]


def total(text, chunk):
    return dict(zip(FIELDS, finished(reduce(merged, states(text, chunk)))))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é,.1'\n\n \t-", max_size=7000), st.booleans())
def test_chunks_add_up_to_the_whole(text, spread):
    text = text * 3 if spread else text
    whole, parts = total(text, 1 << 20), total(text, PIECE)
    assert whole == parts == total(text, 2 * PIECE)
    assert whole["chars"] == len(text) and whole["lines"] == sum(bool(x.strip()) for x in text.split("\n"))
    s = states(text, PIECE)
    right = reduce(lambda a, b: merged(b, a), reversed(s))
    assert dict(zip(FIELDS, finished(right))) == whole  # merged from the other end


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([PROSE, LIST, TABLE, "", "A Cold Day", "the end of it all was near"]), max_size=60))
def test_judgement_does_not_depend_on_the_chunk(parts):
    text = "\n".join(parts)
    assert total(text, 1 << 20) == total(text, PIECE)


def test_prose_then_a_list_and_long_words_and_lines():
    text = "\n".join([PROSE] * 20 + LIST.split("\n") * 6)
    assert total(text, 1024) == total(text, 65_536)
    word = "a" * 100_000 + " b"
    for chunk in (1024, 1 << 20):
        c = total(word, chunk)
        assert (c["words"], c["word_letters"], c["lines"]) == (2, 100_001, 1)
    assert total("end." + " " * 5000 + "\nx", 1024)["punct_lines"] == 1


def test_prose_stays_prose_in_any_layout():
    for t in (PROSE, PROSE.upper(), PROSE.lower().replace(",", "").replace(".", ""), PROSE.replace(" ", "  "), "— " + PROSE, "\n".join(PROSE[i : i + 40] for i in range(0, len(PROSE), 40))):
        c = total(t, 1 << 16)
        assert c["junk"] * 2 <= c["judged"], t


def test_lists_tables_and_junk():
    junk = [TABLE, LIST, '<div class="a"><a href="/t/1">bridge</a></div>\n' * 3, "Home | Login | Cart | RSS | Next | Home", "gVKJlZQ1V/yhJNPv3fIReOru2A+Ymbe+vXGdmtNYfQJG75u9BR6fkl", "2025-03-28T16:34:00Z level=WARN id=18634 code=0xba17\n" * 4, "ttsjj .lssg.fh lfhp,pwqoi.fzr,jruigw.dk ig,p zzoh wihl", "Tracklist: 1 Early Dawn / 2 The Paper Valley / 3 Hurricane in the Tiger"]
    for t in junk:
        c = total(t, 1 << 16)
        assert c["junk"] * 2 > c["judged"], t


def test_operator_on_odd_input(spark):
    rows = [(1, PROSE, 1), (2, TABLE, 2), (3, None, 3), (4, "", 4), (5, " \n\t ", 5), (6, PROSE + "\n" + TABLE * 9, 6), (7, "x" * 300_000, 7), (1, PROSE, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, words int")
    got = {r.doc_id: r for r in text_statistics(df, "doc_id", "text").collect()}
    assert text_statistics(df, "doc_id", "text").count() == 8
    assert got[1].is_prose and not got[2].is_prose and got[3].is_prose is None and got[5].mean_word_length is None
    small = {r.doc_id: r for r in text_statistics(df, "doc_id", "text", PIECE).collect()}
    assert small == got
    assert got[7].words == 1 and got[7].chars == 300_000
    assert sorted(r.doc_id for r in not_prose(df, "doc_id", "text").collect()) == [2, 6, 7]
    assert not_prose(df.limit(0), "doc_id", "text").count() == 0
