"""Tag lists of several services united into one, with the services that added to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tags shown of a united list.
SHOWN = 15
_EMPTY = "array<string>"


def _low(c: Column) -> Column:
    return F.transform(F.coalesce(c, F.array().cast(_EMPTY)), lambda x: F.lower(F.trim(x)))


def _filled(c: Column) -> Column:
    return F.filter(_low(c), lambda x: x.isNotNull() & (x != ""))


def curated_then_crowd(genres: Column, tags: Column) -> Column:
    """All curated names, repeats included, then the crowd's names that are not there yet, each once."""
    g = _filled(genres)
    return F.concat(g, F.array_except(_filled(tags), g))


def of_releases(releases: Column, most: int = 3) -> Column:
    """Distinct genres, then styles, release by release, of the first releases (structs of genre and style lists)."""
    lists = F.transform(F.slice(F.coalesce(releases, F.array().cast("array<struct<genre:array<string>,style:array<string>>>")), 1, most), lambda r: F.concat(_filled(r["genre"]), _filled(r["style"])))
    return F.array_distinct(F.flatten(lists))


def of_top_tags(body: Column) -> Column:
    """Lower-case names of a service's answer; anything but a list of tags gives none."""
    both = F.from_json(body, "toptags struct<tag:string>")["toptags"]["tag"]
    names = F.from_json(both, "array<struct<name:string>>")["name"]
    return F.when(F.startswith(F.ltrim(both), F.lit("[")) & names.isNotNull(), F.transform(F.filter(names, lambda x: x.isNotNull()), F.lower)).otherwise(F.array().cast(_EMPTY))


def united(sources: list[tuple[str, Column]], fallback: tuple[str, Column] | None = None) -> Column:
    """Struct of all tags in the order of the sources and of the sources that added a tag; the fallback only counts if none did."""
    lists = [(n, F.array_distinct(_filled(c))) for n, c in sources]
    seen, hits = F.array().cast(_EMPTY), []
    for name, tags in lists:
        new = F.array_except(tags, seen)
        hits.append(F.when(F.size(new) > 0, F.lit(name)))
        seen = F.concat(seen, new)
    if fallback:
        other = F.array_distinct(_filled(fallback[1]))
        hits.append(F.when((F.size(seen) == 0) & (F.size(other) > 0), F.lit(fallback[0])))
        seen = F.when(F.size(seen) == 0, other).otherwise(seen)
    return F.struct(seen.alias("tags"), F.array_compact(F.array(*hits)).alias("sources_hit"))


def genre_result(df: DataFrame, tags: str, hits: str, blocked: list[str], shown: int = SHOWN) -> DataFrame:
    """First tags, top tag and the first blocked one of the whole list."""
    bad = F.get(F.filter(F.col(tags), lambda t: t.isin(blocked)), F.lit(0))
    return df.withColumns({"shown": F.slice(tags, 1, shown), "top_tag": F.get(F.col(tags), F.lit(0)), "is_blocked": bad.isNotNull(), "blocked_tag": bad, "hits": F.col(hits)})
