"""Problem 10: per-document text statistics that tell prose from lists, tables and junk.

Method: texts are split into chunks. The counts of a chunk come with its boundary state: its first and last open line, the sums
of its first and last open group of lines. Two neighbouring states merge into the state of both, closing what lies between
them; merging is associative, so states are merged in a tree, and the result is the same for every size of chunk. A word
counts where it starts, its letters where they stand. Ratios and rule outcomes come from the merged counts.

The share of characters that are no prose is counted by pieces of lines. A piece is judged by its marks (markup, cells,
columns, log fields, list marks, broken characters); pieces without marks are judged together with their unmarked
neighbours by common words, so wrapped, capitalised or unpunctuated prose stays prose.

Defined cases: null, empty and blank texts have zero counts, null ratios and no outcome; repeated rows are each their own
document; texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.session import written

CHUNK = 1 << 16
#: Characters behind a chunk that it sees: longer than any common word, list mark or run of blanks before one.
LOOK = 48
#: Chunks whose states are merged in one task.
TREE = 256
#: A line is judged in pieces of this many characters; it divides CHUNK, so no piece lies in two chunks.
PIECE = 1 << 10

#: The commonest words of each language.
COMMON = {
    "en": "the a an of and to in is it that for on with as was at by from this but not are be we you they his her its or which when what there could have been has had more than one if i my she he out so never".split(),
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine einem einen als auch es an er sie wir dem im am vor wie war wird was noch aber doch ohne dass dann hat".split(),
    "fr": "le la les de des du et un une est que qui dans pour pas sur en ce il elle on se avec au aux son sa ses ne plus par mais sans ou été".split(),
    "es": "el los las y una es por con no su del al lo como más se que para pero sin ha muy sus todo fue hasta entre".split(),
}
COMMON_WORDS = frozenset(w for ws in COMMON.values() for w in ws)

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_TAG = re.compile(r"<[/!a-zA-Z|][^<>]{0,400}>|&[a-z]{2,6};|https?://\S+")
_LOG = re.compile(r"^\s*\[?\d{4}-\d\d-\d\d[T ]\d\d:\d\d|(?:^|\s)\w+=\S+\s+\S*\w+=\S+|^\s*\d{1,2}:\d\d(?::\d\d)?\s+[-\d]")
_ITEM = re.compile(r"^\s*(?:[-*•·+>»–—]|\[[ xX]?\]|\(?\d{1,3}[.):]\)?|\(?[A-Za-z][.)])\s+\S")
_CREDIT = re.compile(r"^\s*[^\W\d][^:.,!?]{0,24}:\s")
_RULE = re.compile(r"^[\s|:+=\-_*~#.]+$")
_COLUMNS = re.compile(r"\S(?:\s{2,}|\t)(?=\S)")
_NUMBERED = re.compile(r"(?:^|[/|,;:])\s*\d{1,3}[.)]?\s+[^\W\d]")
_END = tuple(".!?…:;,\"”»)。")
_NO_LETTER = re.compile(r"[\W\d_]+")
_NO_DIGIT = re.compile(r"\D+")
_SYMBOLS = re.compile(r"[!-/:-@\[-`{-~](?<![.,'\"!?-])")
_ODD = re.compile("[\x80-\x9f\ufffdÃÂÐÑ¤¦¨¬±\u0300-\u036f\u0483-\u0489\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ue000-\uf8ff\ufe20-\ufe2f]+")
_CELLS = re.compile(r"[;,|]\S")


def _broken(s: str, solid: int) -> bool:
    """Many marks, controls, private or mis-decoded characters, or symbols, that prose has few of; ``solid`` is the number of characters but white space."""
    if not s.isascii() and len(_ODD.sub("", s)) < len(s) - 0.12 * solid:
        return True
    return len(_SYMBOLS.findall(s)) > 0.2 * solid


def _marked(s: str, words: int, common: int, solid: int) -> bool:
    """Whether a piece of a line bears the marks of markup, tables, lists or machine output."""
    t = s.strip()
    n = len(t)
    if _RULE.match(t):
        return True
    tags = sum(len(m) for m in _TAG.findall(t)) if "<" in t or "&" in t or "://" in t else 0
    if tags > 0.2 * n or _broken(t, solid) or _LOG.search(t):
        return True
    share = common / words if words else 0.0
    if words == 0:
        return True
    longest = max(map(len, t.split()))
    if longest > 40 and longest > 0.4 * n:
        return True
    bars, tabs = t.count("|"), t.count("\t")
    if bars >= 2 and words < 8 * bars or tabs and words < 8 * (tabs + 1):
        return True
    if len(_CELLS.findall(t)) >= 2 and words < 6 * len(_CELLS.findall(t)):
        return True
    if t.count('","') >= 1 or t[0] in "{[" and '":' in t:
        return True
    cols = len(_COLUMNS.findall(t))
    tokens = t.split()
    if cols and share < 0.2 and words < 6 * (cols + 1):
        return True
    if cols >= 2 and words < 3 * (cols + 1) and (len(tokens) <= 6 or cols < 0.8 * (len(tokens) - 1) and any(x[0].isdigit() for x in tokens)):
        return True
    if len(_NUMBERED.findall(t)) >= 3 and words < 9 * len(_NUMBERED.findall(t)):
        return True
    sentence = share >= 0.2 and words >= 6 and t.endswith((".", "!", "?", "…", "»", "”", '"'))
    if _ITEM.match(t) and not sentence and (words < 9 or share < 0.2):
        return True
    if _CREDIT.match(t) and words <= 9 and not sentence and common <= 2 and not t.endswith((".", "!", "?")):
        return True
    commas = t.count(",")
    return commas >= 2 and words <= 4.5 * (commas + 1) and share < 0.1


def _listed(pieces: int, words: int, common: int, chars: int, upper: int, ended: int, not_upper: int, not_lower: int) -> bool:
    """Whether unmarked neighbouring pieces of lines, given by their sums, are a list rather than prose."""
    share = common / max(words, 1)
    if share < 0.1:
        return True
    if not not_upper or not not_lower:
        return share < 0.14
    return upper >= 0.9 * pieces and ended <= 0.1 * pieces and words <= 8 * pieces


FIELDS = ("chars", "spaces", "letters", "digits", "symbols", "words", "word_letters", "common_words", "lines", "punct_lines", "item_lines", "judged", "junk")
#: Boundary state of a run of text: does it hold a line break, is there a visible character and a closing mark in its first
#: and last line; does it hold a break between groups; sums of its first and last open group.
GROUP = ("pieces", "words", "common", "chars", "upper", "ended", "not_upper", "not_lower")
STATE = (*FIELDS, "breaks", "head_seen", "head_punct", "tail_seen", "tail_punct", "cuts", *(f"head_{g}" for g in GROUP), *(f"tail_{g}" for g in GROUP))
_LINES, _PUNCT, _JUNK, _BREAKS, _CUTS, _HEAD, _TAIL = 8, 9, 12, 13, 18, 19, 27
_STOPS = (".", "!", "?", "…", ":", ";", '"', "”", "»", ")")
_QUOTES = "'’"


def _goes_on(s: str, at: int) -> bool:
    """Whether a word that stands before place ``at`` goes on there."""
    a, b = s[at - 1 : at], s[at : at + 1]
    if not a or not b:
        return False
    if a.isalpha():
        return b.isalpha() or (b in _QUOTES and s[at + 1 : at + 2].isalpha())
    return a in _QUOTES and b.isalpha() and s[max(at - 2, 0) : at - 1].isalpha()


def chunk_state(before: str, body: str, after: str, at: int) -> list[int]:
    """State of one chunk in the order of STATE; ``at`` is its offset in the document, a multiple of PIECE.

    ``before`` are the 2 characters before it, ``after`` the LOOK characters behind it: enough to tell whether a word starts
    here, whether the last one is a common word and whether a line starts with a list mark. All else is carried by the state.
    """
    spaces = len(body) - len("".join(body.split()))
    letters = len(_NO_LETTER.sub("", body))
    digits = len(_NO_DIGIT.sub("", body))
    words = word_letters = common = lines = punct = items = judged = junk = cuts = 0
    shift = len(before)
    whole = before + body + after
    end = shift + len(body)
    head: list[int] | None = None
    group = [0] * len(GROUP)

    def close() -> None:
        nonlocal head, group, junk, cuts
        cuts = 1
        if head is None:
            head = group
        elif group[0] and _listed(*group):
            junk += group[3]
        group = [0] * len(GROUP)

    ends: list[tuple[bool, bool]] = []
    i = shift
    starts = at == 0 or before.endswith("\n")
    for line in body.split("\n"):
        j = i + len(line)
        tail = line.rstrip()
        ends.append((bool(tail), tail.endswith(_STOPS)))
        if starts and tail and _ITEM.match(whole[i : i + LOOK].split("\n", 1)[0]):
            items += 1
        p = i
        while p < j:
            stop = min(j, p + PIECE - (at + p - shift) % PIECE)
            piece = line if stop - p == len(line) else whole[p:stop]
            size = len("".join(piece.split()))
            if size:
                low = piece.lower()
                found = WORD.findall(low)
                word_letters += sum(map(len, found))
                if stop < j or stop == end or p > i or p == shift:
                    if found and _goes_on(whole, stop):
                        rest = WORD.match(whole[stop : stop + LOOK].lower().lstrip(_QUOTES))
                        found[-1] += rest.group() if rest else ""
                    if found and _goes_on(whole, p):
                        found = found[1:]
                hits = sum(map(COMMON_WORDS.__contains__, found))
                words += len(found)
                common += hits
                judged += size
                if _marked(piece, len(found), hits, size):
                    close()
                    junk += size
                else:
                    first = next((c for c in piece if c.isalpha()), "a")
                    for k, v in enumerate((1, len(found), hits, size, first.isupper(), piece.rstrip().endswith(_END), piece.upper() != piece, low != piece)):
                        group[k] += v
            p = stop
        # a blank line that lies in one piece with its end parts groups
        if starts and not tail and j < end and (at + i - shift) // PIECE == (at + j - shift) // PIECE:
            close()
        i, starts = j + 1, True
    for seen, stop_ in ends[1:-1]:
        lines += seen
        punct += seen and stop_
    marks = len(body) - spaces - letters - digits
    none = [0] * len(GROUP)
    sums = [len(body), spaces, letters, digits, marks, words, word_letters, common, lines, punct, items, judged, junk]
    return [*sums, len(ends) > 1, *ends[0], *ends[-1], cuts, *(group if head is None else head), *(none if head is None else group)]


def merged(a: list[int], b: list[int]) -> list[int]:
    """State of two neighbouring runs of text as one; associative, so runs may be merged in any grouping."""
    out = [x + y for x, y in zip(a[: len(FIELDS)], b[: len(FIELDS)], strict=True)] + [0] * (len(STATE) - len(FIELDS))
    seen = a[_BREAKS + 3] or b[_BREAKS + 1]
    middle = [seen, b[_BREAKS + 2] if b[_BREAKS + 1] else a[_BREAKS + 4]]
    if a[_BREAKS] and b[_BREAKS]:
        out[_LINES] += bool(seen)
        out[_PUNCT] += bool(seen and middle[1])
    out[_BREAKS] = a[_BREAKS] or b[_BREAKS]
    out[_BREAKS + 1 : _BREAKS + 3] = a[_BREAKS + 1 : _BREAKS + 3] if a[_BREAKS] else middle
    out[_BREAKS + 3 : _BREAKS + 5] = b[_BREAKS + 3 : _BREAKS + 5] if b[_BREAKS] else middle
    out[_CUTS] = a[_CUTS] or b[_CUTS]
    a_last = a[_TAIL:] if a[_CUTS] else a[_HEAD:_TAIL]
    between = [x + y for x, y in zip(a_last, b[_HEAD:_TAIL], strict=True)]
    if a[_CUTS] and b[_CUTS]:
        if between[0] and _listed(*between):
            out[_JUNK] += between[3]
        out[_HEAD:_TAIL], out[_TAIL:] = a[_HEAD:_TAIL], b[_TAIL:]
    elif a[_CUTS]:
        out[_HEAD:_TAIL], out[_TAIL:] = a[_HEAD:_TAIL], between
    elif b[_CUTS]:
        out[_HEAD:_TAIL], out[_TAIL:] = between, b[_TAIL:]
    else:
        out[_HEAD:_TAIL] = between
    return out


def finished(s: list[int]) -> list[int]:
    """FIELDS of a whole document from its state."""
    out = list(s[: len(FIELDS)])
    for seen, stop in ((s[_BREAKS + 1], s[_BREAKS + 2]), *([(s[_BREAKS + 3], s[_BREAKS + 4])] if s[_BREAKS] else [])):
        out[_LINES] += bool(seen)
        out[_PUNCT] += bool(seen and stop)
    for g in (s[_HEAD:_TAIL], s[_TAIL:]):
        if g[0] and _listed(*g):
            out[_JUNK] += g[3]
    return out


def text_statistics(docs: DataFrame, key: str, text: str, chunk: int = CHUNK) -> DataFrame:
    """Counts, ratios and rule outcomes of every document; ``chunk`` is a multiple of PIECE and changes no result."""
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"), F.monotonically_increasing_id().alias("row"))
    one = F.array(F.struct(F.lit("").alias("before"), F.col("t").alias("body"), F.lit("").alias("after"), F.lit(0).cast("long").alias("at")))
    # one pass cuts a text, so its length costs no more than itself
    cut = rows.withColumn("p", F.when(F.length("t") > chunk, F.regexp_extract_all("t", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))))
    side = lambda i: F.coalesce(F.get("p", i), F.lit(""))
    many = F.transform("p", lambda x, i: F.struct(F.right(side(i - 1), F.lit(2)).alias("before"), x.alias("body"), F.left(side(i + 1), F.lit(LOOK)).alias("after"), (i.cast("long") * chunk).alias("at")))
    parts = cut.select("k", "row", F.col("p").isNull().alias("single"), F.explode(F.when(F.col("p").isNull(), one).otherwise(many)).alias("c")).select("k", "row", "single", "c.*")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            got = []
            for single, *x in zip(*(r.column(i).to_pylist() for i in range(2, 7)), strict=True):
                state = chunk_state(*x)
                got.append(finished(state) + [0] * (len(STATE) - len(FIELDS)) if single else state)
            cols = list(zip(*got, strict=True)) if got else [[] for _ in STATE]
            yield pa.RecordBatch.from_arrays([r.column(0), r.column(1), r.column(2), r.column(6), *(pa.array(map(int, c), pa.int64()) for c in cols)], ["k", "row", "single", "at", *STATE])

    def joined(last: bool):
        def run(t: pa.Table) -> pa.Table:
            t = t.sort_by("at")
            state = None
            for s in zip(*(t.column(c).to_pylist() for c in STATE), strict=True):
                state = list(s) if state is None else merged(state, list(s))
            if last:
                state = finished(state) + [0] * (len(STATE) - len(FIELDS))
            return pa.table([t.column("k")[:1], t.column("row")[:1], t.column("single")[:1], t.column("at")[:1], *(pa.array([int(v)], pa.int64()) for v in state)], names=["k", "row", "single", "at", *STATE])

        return run

    kind = dict(rows.dtypes)["k"]
    shape = f"k {kind}, row bigint, single boolean, at bigint, " + ", ".join(f"{f} bigint" for f in STATE)
    counted = written(parts.mapInArrow(count, shape), "text-states")
    # states of cut documents are merged in two steps, so no task holds more than TREE chunks of one
    lower = counted.where("NOT single").groupBy("row", F.floor(F.col("at") / (chunk * TREE)).alias("node")).applyInArrow(joined(False), shape)
    total = counted.where("single").unionByName(lower.groupBy("row").applyInArrow(joined(True), shape)).select("k", *FIELDS)

    def share(a: str, b: str):
        return F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 6))

    out = total.select(
        F.col("k").alias(key), *FIELDS,
        share("word_letters", "words").alias("mean_word_length"), share("symbols", "chars").alias("symbol_ratio"), share("digits", "chars").alias("digit_ratio"),
        share("punct_lines", "lines").alias("punct_line_share"), share("item_lines", "lines").alias("item_line_share"), share("common_words", "words").alias("common_word_share"), share("junk", "judged").alias("junk_share"),
    )
    return out.withColumns({
        "is_prose": F.when(F.col("judged") > 0, F.col("junk") * 2 <= F.col("judged")),
        "too_symbolic": F.when(F.col("judged") > 0, F.col("symbol_ratio") > 0.1),
        "odd_words": F.when(F.col("words") > 0, ~F.col("mean_word_length").between(3, 10)),
        "few_common_words": F.when(F.col("words") > 0, F.col("common_word_share") < 0.1),
    })


def not_prose(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Keys of documents of whose characters, white space aside, more than half are list, table or junk."""
    return text_statistics(docs, key, text).where("junk * 2 > judged").select(key)
