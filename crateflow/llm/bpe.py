"""Problem 8: token ids of every text by a public byte-level BPE, computed by Spark's own expressions.

Method: texts are cut into words by the tokenizer's pattern. The rank map is a literal: an array of small maps addressed
by a checksum, because one large map literal would be searched from its start at every look-up; an expression binds it once.
A word that is itself in the map has that one id. Of all other words the distinct ones are encoded once, by a fold over
their bytes, which are written as strings of one character per byte (ISO-8859-1), so joining strings joins bytes; their ids
are joined back to the texts. Decoding concatenates binary pieces. No Python runs.

Defined cases: null, empty and blank texts: null and empty texts have the empty list, blank ones the ids of their
white space; every input row gives one row, so repeated rows and null keys stay; texts and words are encoded whole; an empty table gives no rows; decoding an empty list gives the empty text.
"""

from __future__ import annotations

import base64
import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.session import written

BUCKETS = 16_384
NONE = 2_147_483_647
#: Words of more bytes are cut where nothing can merge; the sign put there is no byte.
LONG, CUT = 48, "\u2063"
DECODE_BLOCK = 512


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The place of a public tokenizer's file as installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    """The tokenizer's word pattern for Java; white space in Unicode's sense."""
    import public_tokenizers

    return "(?U)" + public_tokenizers.PATTERN


def _as_text(piece: bytes) -> str | None:
    try:
        return piece.decode("utf-8")
    except UnicodeDecodeError:
        return None


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


class ByteBpe:
    """Encoder and decoder as Column expressions over literals made of a rank file."""

    def __init__(self, path: str | None = None, pattern: str | None = None, buckets: int = BUCKETS):
        self.ranks = read_ranks(path or tokenizer_file())
        self.pattern = pattern or word_pattern()
        self.buckets = buckets
        self._bytes_map = self._hashed((p.decode("latin-1"), r) for p, r in self.ranks.items())
        self._text_map = self._hashed((t, r) for p, r in self.ranks.items() if (t := _as_text(p)) is not None)
        pieces = [b""] * (max(self.ranks.values()) + 1)
        meets = [0] * (1 << 16)
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
            for a, b in zip(piece, piece[1:]):
                meets[a << 8 | b] = 1
        self._pieces = json.dumps([base64.b64encode(p).decode() for p in pieces])
        self._meets = json.dumps(meets)

    def _hashed(self, pairs) -> str:
        table: list[dict[str, int]] = [{} for _ in range(self.buckets)]
        for text, rank in pairs:
            table[zlib.crc32(text.encode("utf-8")) % self.buckets][text] = rank
        return json.dumps(table)

    def _rank(self, table: Column, piece: Column) -> Column:
        """Rank of a piece in a map, or null."""
        return F.try_element_at(F.get(table, F.pmod(F.crc32(piece.cast("binary")), F.lit(self.buckets)).cast("int")), piece)

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def known(self, words: Column) -> Column:
        """Ids of words that stand in the map as they are, null for others."""
        return _bound(F.from_json(F.lit(self._text_map), "array<map<string,int>>"), lambda t: F.transform(words, lambda w: self._rank(t, w)))

    def fold(self, word: Column) -> Column:
        """Ids of one word by ranked merges over its bytes; a round joins all places of the pair of lowest rank.

        A merged piece ranks above what it is made of, so joining its places one by one from the left gives the same. Words of
        more than LONG bytes are cut first between bytes that stand side by side in no piece, over which nothing merges.
        """

        def run(table: Column, data: Column) -> Column:
            def joined(x: Column, y: Column) -> Column:
                return F.coalesce(self._rank(table, F.concat(x, y)), F.lit(NONE))

            def start(p: Column) -> Column:
                return F.transform(p, lambda x, i: F.struct(x.alias("p"), F.when(i + 1 < F.size(p), joined(x, F.get(p, i + 1))).otherwise(F.lit(NONE)).alias("r")))

            def state(q: Column) -> Column:
                return F.struct(q.alias("q"), F.array_min(q["r"]).alias("low"))

            def merged(s: Column) -> Column:
                q, low = s["q"], s["low"]
                # of overlapping places (one piece repeated) every second is joined, from the left
                marks = F.split(F.replace(F.array_join(F.transform(q, lambda x: F.when(x["r"] == low, "1").otherwise("0")), ""), F.lit("11"), F.lit("10")), "")

                def merge(m: Column) -> Column:
                    here = lambda i: F.coalesce(F.get(m, i), F.lit("0")) == "1"

                    def one(x: Column, i: Column) -> Column:
                        plain = F.struct(x["p"].alias("p"), F.when(here(i + 1), F.lit(-1)).otherwise(x["r"]).alias("r"))
                        return F.when(here(i), F.struct(F.concat(x["p"], F.get(q, i + 1)["p"]).alias("p"), F.lit(-1).alias("r"))).when(~here(i - 1), plain)

                    def fresh(n: Column) -> Column:
                        return F.transform(n, lambda x, i: F.when(x["r"] >= 0, x).otherwise(F.struct(x["p"].alias("p"), F.when(i + 1 < F.size(n), joined(x["p"], F.get(n, i + 1)["p"])).otherwise(F.lit(NONE)).alias("r"))))

                    return _bound(_bound(F.filter(F.transform(q, one), lambda x: x.isNotNull()), fresh), state)

                return _bound(marks, merge)

            def ids(p: Column, long: bool = False) -> Column:
                step = lambda s: F.when(s["low"] < NONE, merged(s)).otherwise(s)
                last = lambda s: F.transform(s["q"], lambda x: self._rank(table, x["p"]))
                if not long:
                    steps = F.when(F.size(p) > 1, F.sequence(F.lit(2), F.size(p))).otherwise(F.array().cast("array<int>"))
                    return F.aggregate(steps, _bound(start(p), state), lambda s, _: step(s), last)
                # as many rounds as bytes may be needed, but few are: rounds in blocks, of which those after the last merge are skipped
                some = F.sequence(F.lit(1), F.ceil(F.sqrt(F.size(p))).cast("int"))
                block = lambda s, _: F.when(s["low"] < NONE, F.aggregate(some, s, lambda s, _: step(s))).otherwise(s)
                return F.aggregate(some, _bound(start(p), state), block, last)

            whole = _bound(F.split(data, ""), lambda p: ids(p))
            return F.when(F.length(data) <= LONG, whole).otherwise(F.flatten(F.transform(self._runs(data), lambda w: _bound(F.split(w, ""), lambda p: ids(p, True)))))

        return _bound(F.from_json(F.lit(self._bytes_map), "array<map<string,int>>"), lambda t: run(t, F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")))

    def _runs(self, data: Column) -> Column:
        """Parts of a byte string that no merge crosses."""
        meets = F.from_json(F.lit(self._meets), "array<int>")

        def cut(p: Column) -> Column:
            apart = lambda x, i: (i > 0) & (F.get(meets, F.ascii(F.get(p, i - 1)) * 256 + F.ascii(x)) == 0)
            return F.split(F.array_join(F.transform(p, lambda x, i: F.when(apart(x, i), F.concat(F.lit(CUT), x)).otherwise(x)), ""), CUT)

        return _bound(F.split(data, ""), cut)

    def decode(self, ids: Column) -> Column:
        """The text of a list of ids: binary pieces are concatenated, first in blocks, so a text of n pieces costs n * BLOCK copies."""
        table = F.from_json(F.lit(self._pieces), "array<binary>")
        glue = lambda pieces: F.aggregate(pieces, F.lit(b""), lambda a, x: F.concat(a, x))
        pieces = lambda t: F.transform(ids, lambda x: F.get(t, x))
        blocks = lambda p: F.transform(F.when(F.size(p) > 0, F.sequence(F.lit(1), F.size(p), F.lit(DECODE_BLOCK))).otherwise(F.array().cast("array<int>")), lambda i: glue(F.slice(p, i, F.lit(DECODE_BLOCK))))
        return F.when(ids.isNotNull(), F.decode(_bound(_bound(table, pieces), lambda p: glue(blocks(p))), "UTF-8"))

    def _parsed(self, docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
        """(row, k, known ids with null for each other word) and (row, pos, ids) of the other words."""
        words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"), self.words(F.coalesce(F.col(text), F.lit(""))).alias("w"))
        known = words.select("row", "k", "w", self.known(F.col("w")).alias("known"))
        rest = F.filter(F.transform(F.col("w"), lambda w, j: F.when(F.isnull(F.get(F.col("known"), j)), F.struct(j.alias("pos"), w.alias("w")))), lambda x: x.isNotNull())
        parsed = written(known.select("row", "k", "known", rest.alias("rest")), "bpe-words")
        cells = parsed.select("row", F.explode("rest").alias("c")).select("row", "c.pos", "c.w")
        codes = written(cells.select("w").distinct().select("w", self.fold(F.col("w")).alias("ids")), "bpe-codes")
        return parsed.select("row", "k", "known"), cells.join(codes, "w").select("row", "pos", "ids")

    def encode(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        """(key, ids) of every document."""
        known, found = self._parsed(docs, key, text)
        lists = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("rest"))
        both = known.join(lists, "row", "left")
        rest = F.col("rest")
        # known ids up to each other word, then that word's ids; after the last one the known ids that are left
        after = lambda j: F.when(j > 0, F.get(rest, j - 1)["pos"] + 1).otherwise(F.lit(0))
        ahead = F.transform(rest, lambda c, j: F.concat(F.slice("known", after(j) + 1, c["pos"] - after(j)), c["ids"]))
        tail = F.slice("known", F.element_at("rest", -1)["pos"] + 2, F.size("known"))
        ids = F.when(rest.isNull(), F.col("known")).otherwise(F.concat(F.flatten(ahead), tail))
        return both.select(F.col("k").alias(key), ids.alias("ids"))

    def count(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        """(key, tokens) of every document; only counts are moved."""
        known, found = self._parsed(docs, key, text)
        more = found.groupBy("row").agg(F.sum(F.size("ids")).alias("more"))
        single = F.size(F.filter("known", lambda x: x.isNotNull()))
        return known.select("row", "k", single.cast("long").alias("single")).join(more, "row", "left").select(F.col("k").alias(key), (F.col("single") + F.coalesce("more", F.lit(0))).alias("tokens"))
