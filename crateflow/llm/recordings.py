"""What a written artist and title say about a recording, and how likely one writing is a variant of another.

``parse`` folds case, marks and punctuation, drops notes that don't change the recording (official audio, remasters,
guests) and keeps in a version what does (live, remix, part, demo ...). The rest is a bag of words, so swapped fields,
reordered names and both values in one field come to the same bag. ``channel_cost`` is the negative log-likelihood of
writing one bag as another: typos, initials, short forms, words run together.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import permutations

import xxhash

#: Words that carry no name; articles may come and go freely.
ARTICLES = frozenset("the an le la les el los las der die das un une ein eine".split())
LIGHT = frozenset("a o y of in and for on to by with without when de des du del al en et sur sous dans au aux pour par dem den im am von vom und auf ohne para sin".split())
#: Words in a note that make another recording, and words of notes that don't.
OTHER = frozenset("live remix session sessions demo acoustic instrumental karaoke cover tutorial slowed reverb sped nightcore loop hour 8d unplugged rehearsal mashup edit mix bootleg reprise".split())
SAME = frozenset("official video audio lyric lyrics visualizer visualiser hd hq 4k remaster remastered version album single original deluxe edition explicit music mono stereo clip full song new bonus track master mv".split())
SHORT = {"3": "trio", "qt": "quartet", "qtet": "quartet", "4": "quartet", "coll": "collective", "ens": "ensemble", "orch": "orchestra", "proj": "project", "co": "collective"}
NUMBER = {"one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5"}

_BRACKET = re.compile(r"[(\[【{<]([^()\[\]【】{}<>]*)[)\]】}>]\s*(\d{1,3}\b)?")
_PART = re.compile(r"[,:\-\s]*\b(?:pt|part|par|prt|teil|partie|parte)\b\.?\s*(\d+|one|two|three|four|five|iv|v|i{1,3})\b\.?", re.I)
_FEAT = re.compile(r"\s[(\[]?(?:feat|ft|featuring)\b\.?\s.*$", re.I)
_TAIL = re.compile(
    r"(?P<other>[\s\-–—|]+(?:live(?:\s*[@|]\s*\S.*|\s+(?:at|in|from)\s+\S.*)?|slowed\s*[+&]?\s*reverb|slowed|sped\s+up|nightcore|(?:instrumental\s+)?karaoke(?:\s+version)?|instrumental|acoustic|piano\s+tutorial|\d+\s+hours?(?:\s+loop)?|cover\s+of\s.*|cover|remix|demo|8d))\s*$"
    r"|(?P<same>(?:\s[-–—|]\s*(?:(?:19|20)\d\d\s+)?(?:full\s+song|single|hq|hd|(?:re)?master(?:ed)?|(?:official|lyric|album|single|original)\s+\w+)|\s+new(?:\s+(?:19|20)\d\d)?|\s+(?:official\s+(?:music\s+)?(?:audio|video)|lyrics?(?:\s+video)?|please|pls|hd|hq|\[hd\])|\s*[♫♪]+))\s*$",
    re.I,
)
_WORD = re.compile(r"\w+")
_MARKS = re.compile("[\u0300-\u036f\u0483-\u0489\u0591-\u05bd\u064b-\u065f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe20-\ufe2f]+")
_WITHOUT = re.compile(r"\bw\s*/\s*o\b", re.I)
_DOTTED_DJ = re.compile(r"\bd\s*\.\s*j\b\.?", re.I)
#: A text without any of these has no note after its end.
_HINTS = ("live", "slowed", "sped", "nightc", "karaoke", "instrumental", "acoustic", "tutorial", "hour", "cover", "remix", "demo", "8d", "song", "single", "hq", "hd", "master", "official", "lyric", "album", "original", "new", "please", "pls", "♫", "♪")
_JOINED = re.compile(r"\w-\w+-\w|[-_]\(|\(\w+-")
_JOINT = re.compile(r"(?<=[\w)\]])[-_](?=[\w(\[])")
_OPENING = re.compile(r"[(\[【{<]")
_ELIDED = re.compile(r"\b(?:l|d|s|n|j|c|qu)['’`]", re.I)
_CAMEL = re.compile(r"(?<=[a-zß-öø-ÿα-ωа-яё]{2})(?=[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][a-zß-öø-ÿα-ωа-яё])|(?<=\bDJ)(?=[A-Z][a-z])")
#: What ASCII texts look like as to camel case, and their words between spaces.
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 else 32 for c in range(256))
_SPACED = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
_ASIDE = re.compile(r"\b(?:official\s+(?:music\s+)?(?:audio|video)|lyrics?\s+video|please)\b", re.I)
PLACEHOLDER_ARTIST = re.compile(r"^\W*(?:unknown(?:\s+artist)?|various(?:\s+artists)?|va|v\.a\.|n/?a|none|artist|untitled)?\W*$", re.I)
PLACEHOLDER_TITLE = re.compile(r"^\W*(?:(?:audio\s*)?track\s*\d*|untitled(?:\s*\d*)|audio\s*file\s*\d*|new\s+recording\s*\d*|unknown(?:\s+title)?|recording\s*\d*|title|\d*)\W*$", re.I)


def fold(s: str) -> str:
    """Lower case without marks; signs of one width."""
    if s.isascii():
        return s.lower()
    return _MARKS.sub("", unicodedata.normalize("NFKD", s)).casefold()


@lru_cache(maxsize=1 << 15)
def _words(s: str) -> tuple[str, ...]:
    if "/" in s:
        s = _WITHOUT.sub("without", s)
    if "." in s:
        s = _DOTTED_DJ.sub("DJ", s)
    plain = s.isascii()
    if not (s.islower() or s.isupper() or s.istitle()):
        shape = s.encode().translate(_SHAPE) if plain else b""
        if not plain or b"aaAa" in shape or b"AAAa" in shape:
            s = _CAMEL.sub(" ", s)
    if "'" in s or "’" in s or "`" in s:
        s = _ELIDED.sub(" ", s).replace("'", "")
    s = fold(s)
    if "&" in s or "+" in s:
        s = s.replace("&", " and ").replace("+", " and ")
    if plain:
        return tuple(s.encode().translate(_SPACED).decode().split())
    return tuple(_WORD.findall(s.replace("_", " ").replace("・", "")))


def words(s: str, nicknames: dict[str, str] | None = None) -> list[str]:
    """Folded words; camel-cased joins are split, elided articles dropped, nicknames and usual short forms written out."""
    full = nicknames or SHORT
    return [full.get(w, w) for w in _words(s)]


def full_forms(pairs) -> dict[str, str]:
    """Usual short forms and nicknames with their full forms; ``pairs`` are rows of (short form, full form)."""
    return SHORT | {a.casefold(): b.casefold() for a, b in pairs if a and b}


@lru_cache(maxsize=1 << 14)
def _note(text: str, number: str | None) -> tuple[str, str]:
    """Kind (same, other, guest, part, text) of a note and its detail."""
    w = words(text)
    if not w:
        return "same", ""
    if w[0] in ("feat", "ft", "featuring", "with"):
        return "guest", ""
    m = _PART.fullmatch(" " + text.strip())
    if m:
        return "part", NUMBER.get(m.group(1).lower(), m.group(1))
    if any(x in OTHER for x in w) and not (w[0] in ("single", "album", "radio") and "cover" not in w and w[-1] == "mix"):
        return "other", " ".join(sorted([*(x for x in w if x not in ("at", "the", "in", "version", "festival", "from", "of", "by")), *([number] if number else [])]))
    if all(x in SAME or x.isdigit() for x in w):
        return "same", ""
    near = [x for x in w if x in SAME or x.isdigit() or any(len(x) > 4 and abs(len(x) - len(k)) < 2 and distance(x, k, 2) <= 2 for k in ("official", "version", "remastered", "lyrics", "visualizer", "album", "edition", "video"))]
    return ("same", "") if len(near) == len(w) else ("text", text)


def _hinted(low: str) -> bool:
    for h in _HINTS:
        if h in low:
            return True
    return False


@lru_cache(maxsize=1 << 15)
def parse(text: str | None) -> tuple[str, tuple[str, ...]]:
    """(text without notes, version marks in order)."""
    if not text:
        return "", ()
    s = " " + (text if text.isascii() else unicodedata.normalize("NFKC", text)).strip()
    marks: list[str] = []

    def bracket(m: re.Match) -> str:
        kind, detail = _note(m.group(1), m.group(2))
        if kind == "other":
            marks.append(detail)
            return " "
        if kind == "part":
            marks.append("part " + detail)
        if kind == "text":
            return f" {m.group(1)} {m.group(2) or ''} "
        return f" {m.group(2) or ''} "

    if ("-" in s or "_" in s) and _JOINED.search(s):
        s = _JOINT.sub(" ", s)
    if _OPENING.search(s):
        s = _BRACKET.sub(bracket, s)
    low = s.lower()
    if "official" in low or "please" in low or "lyric" in low:
        s = _ASIDE.sub(" ", s)
    if "f" in low and ("feat" in low or "ft" in low):
        s = _FEAT.sub(" ", s)
    s = s.rstrip(' "”»')
    while _hinted(low) and (m := _TAIL.search(s)):
        if m.start() == 0:
            break
        if m.group("other"):
            kind, detail = _note(m.group("other").strip(" -–—|"), None)
            marks.append(detail or fold(m.group("other")).strip())
        s = s[: m.start()].rstrip(' "”»')
        low = s.lower()
    m = _PART.search(s) if "pt" in low or "par" in low or "prt" in low or "teil" in low else None
    if m and m.start() > 0:
        marks.append("part " + NUMBER.get(m.group(1).lower(), m.group(1)))
        s = s[: m.start()] + " " + s[m.end() :]
    return s.strip(), tuple(sorted(set(marks)))


def is_placeholder(artist: str | None, title: str | None) -> bool:
    """Names that name nothing."""
    return bool(PLACEHOLDER_ARTIST.match(artist or "")) or bool(PLACEHOLDER_TITLE.match(title or ""))


def bag(*texts: str, nicknames: dict[str, str] | None = None) -> list[str]:
    """Sorted distinct words of the texts without articles."""
    return sorted({w for t in texts for w in words(t, nicknames)} - ARTICLES)


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def _edited(words) -> frozenset[str]:
    """What one edit or swap makes of the words; a sign stands for any character."""
    out = set(words)
    for w in words:
        for i in range(len(w)):
            out |= {w[:i] + w[i + 1 :], w[:i] + "\0" + w[i + 1 :], w[:i] + w[i + 1 : i + 2] + w[i] + w[i + 2 :]}
        out |= {w[:i] + "\0" + w[i:] for i in range(len(w) + 1)}
    return frozenset(out)


_NEAR_ARTICLE, _NEAR_LIGHT, _NEAR_WITHOUT = (_edited([w for w in ws if len(w) > 1]) for ws in (ARTICLES, ARTICLES | LIGHT, {"without"}))


def _is_edited(w: str, near: frozenset[str]) -> bool:
    if w in near:
        return True
    for i in range(len(w)):
        if w[:i] + "\0" + w[i + 1 :] in near:
            return True
    return False


def is_near_light(w: str) -> bool:
    """An article or a light word, maybe with a typo."""
    if len(w) <= 5:
        return len(w) > 1 and _is_edited(w, _NEAR_LIGHT)
    # an edit leaves one end of "without" as it is
    return len(w) < 9 and (w[:3] == "wit" or w[-3:] == "out") and _is_edited(w, _NEAR_WITHOUT)


@lru_cache(maxsize=1 << 16)
def _mark(kind: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\x1f{text}")


@lru_cache(maxsize=1 << 16)
def distance(a: str, b: str, most: int) -> int:
    """Edits with swaps of neighbours (optimal string alignment), most + 1 if there are more than ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row, low = row, [i], i
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
            low = min(low, d)
        if low > most:
            return most + 1
        before = last
    return min(row[-1], most + 1)


TYPO, INITIAL, SHORTENED, JOINED, CUT_OFF, LOST, LOST_LIGHT, CANNOT = 2.2, 1.2, 1.2, 1.5, 0.4, 7.5, 1.6, 99.0
#: A writing is a variant if its cost is at most this.
LIMIT = 7.0


@lru_cache(maxsize=1 << 16)
def word_cost(x: str, y: str) -> float:
    """Cost of one word as another."""
    if x[-1] == "*" or y[-1] == "*":
        x, y = (x, y) if x[-1] == "*" else (y, x)
        return CUT_OFF if y.startswith(x[:-1]) else CANNOT
    if len(x) > len(y):
        x, y = y, x
    if len(x) == 1:
        return INITIAL if y[0] == x else CANNOT
    if x in LIGHT and y in LIGHT and len(x) + len(y) < 7 and distance(x, y, 1) > 1:
        return CANNOT
    most = 1 if len(y) < 5 else 2 if len(y) < 10 else 3
    far = len(y) - len(x) > most or (x[0] != y[0] and x[-1] != y[-1] and x[:2] != y[1::-1])
    if far and "ph" not in x and "ph" not in y:  # both ends differ: no typo of so few letters is that unlucky
        return SHORTENED if len(x) >= 3 and y.startswith(x) and len(x) <= len(y) - 2 else CANNOT
    if len(set(x) ^ set(y)) > 2 * most + 2 * ("ph" in x or "ph" in y):
        return SHORTENED if len(x) >= 3 and y.startswith(x) and len(x) <= len(y) - 2 else CANNOT
    d = distance(x, y, most)
    if d > 1 and ("ph" in x) != ("ph" in y):
        d = min(d, 1 + distance(x.replace("ph", "f"), y.replace("ph", "f"), most))
    if d <= most and not (x.isdigit() or y.isdigit()):
        return TYPO * d
    if len(x) >= 3 and y.startswith(x) and len(x) <= len(y) - 2:
        return SHORTENED
    return CANNOT


def is_near_article(w: str) -> bool:
    """An article, maybe with a typo."""
    return len(w) <= 5 and _is_edited(w, _NEAR_ARTICLE)


def _lost_word(w: str) -> float:
    if w in LIGHT or len(w) == 1 or w[-1] == "*":
        return LOST_LIGHT
    return TYPO if is_near_article(w) else LOST


def _lost(ws: list[str]) -> float:
    return sum(map(_lost_word, ws))


def _aligned(ra: list[str], rb: list[str]) -> tuple[float, list[tuple[str, str]]]:
    pairs = sorted((word_cost(x, y), x, y) for x in ra for y in rb)
    total, la, lb, typos = 0.0, list(ra), list(rb), []
    for c, x, y in pairs:
        if c < CANNOT and x in la and y in lb:
            la.remove(x)
            lb.remove(y)
            total += c
            if c >= TYPO:
                typos.append((x, y))
    return total + _lost(la) + _lost(lb), typos


def _run_together(ra: list[str], rb: list[str]) -> float:
    """Cost if the words that differ are the same letters with other spaces."""
    if not ra or not rb or len(ra) > 4 or len(rb) > 4:
        return CANNOT
    best = CANNOT
    short, long = (ra, rb) if len(ra) <= len(rb) else (rb, ra)
    whole = ["".join(p) for p in permutations(short)]
    for p in permutations(long):
        t = "".join(p)
        for s in whole:
            if abs(len(s) - len(t)) < 3 and (s[0] == t[0] or s[-1] == t[-1]) and len(set(s) ^ set(t)) < 5:
                d = distance(s, t, 2)
                if d <= 2:
                    best = min(best, JOINED + TYPO * d)
    return best


def _only_joined(ra: list[str], rb: list[str]) -> bool:
    """Whether the words are the same letters with other spaces, however many there are."""
    short, long = (ra, rb) if len(ra) <= len(rb) else (rb, ra)
    if not short or sorted("".join(short)) != sorted("".join(long)):
        return False

    def fits(s: str, at: int, left: tuple[str, ...]) -> bool:
        if not s:
            return not left if at == len(short) else fits(short[at], at + 1, left)
        return any(s.startswith(w) and fits(s[len(w) :], at, left[:i] + left[i + 1 :]) for i, w in enumerate(left))

    return fits("", 0, tuple(long))


def channel_cost(a: list[str], b: list[str]) -> tuple[float, list[tuple[str, str]]]:
    """Cost of two bags as writings of one recording, and the word pairs taken as typos."""
    sa, sb = set(a), set(b)
    ra, rb = [w for w in a if w not in sb], [w for w in b if w not in sa]
    if not ra and not rb:
        return 0.0, []
    if len(ra) > 5 or len(rb) > 5 or len(sa & sb) == 0:
        return (JOINED if _only_joined(ra, rb) else CANNOT), []
    heavy_a, heavy_b = [w for w in ra if w not in LIGHT], [w for w in rb if w not in LIGHT]
    if len(heavy_a) == len(heavy_b) > 1:
        first = [w[0] for w in heavy_b]
        odd = 0
        for w in heavy_a:
            if w[0] in first:
                first.remove(w[0])
            else:
                odd += 1
        if odd > 1:
            return CANNOT, []
    cost, typos = _aligned(ra, rb)
    if cost > JOINED and len(heavy_a) != len(heavy_b):
        other = _run_together(heavy_a, heavy_b) + _lost([w for w in ra if w in LIGHT]) + _lost([w for w in rb if w in LIGHT])
        if other < cost:
            return other, []
    return cost, typos
