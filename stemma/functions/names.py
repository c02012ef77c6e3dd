"""Names of authors: display form, parts in brackets, kind and matching key, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import bangla
from stemma.functions import strings as S

BRACKET = r"\([^()]*\)"
MOHAMMAD = S.pattern("(?:^|(?<=\\s))(?:" + "|".join(map(re.escape, R.MOHAMMAD_FORMS)) + ")(?=\\s|\\z)")
EMPTY = "struct<name_display:string,name_key:string,honorifics:array<string>,rank_titles:array<string>,descriptors:array<string>,aliases:array<string>,author_type:string>"


def _kind(inner: Column) -> Column:
    return F.when(inner == "", "").when(inner.isin(*R.HONORIFICS), "honorific").when(inner.isin(*R.RANK_TITLES), "rank").when(inner.isin(*R.DESCRIPTORS), "descriptor").otherwise("alias")


def _without_leading_titles(core: Column) -> Column:
    """Words after the leading titles; the last word stays even if it is a title."""

    def of(words: Column) -> Column:
        state = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
        step = lambda s, w: F.struct((s["n"] + (s["on"] & w.isin(*R.LEADING_TITLES)).cast("int")).alias("n"), (s["on"] & w.isin(*R.LEADING_TITLES)).alias("on"))
        titles = F.aggregate(words, state, step, lambda s: s["n"])
        start = F.least(titles, F.size(words) - 1) + 1
        return F.when(F.size(words) == 0, "").otherwise(F.array_join(F.slice(words, F.greatest(start, F.lit(1)), F.greatest(F.size(words), F.lit(1))), " "))

    return S.let(S.word_list(core), of)


def _key(core: Column) -> Column:
    key = F.regexp_replace(_without_leading_titles(core), MOHAMMAD, R.MOHAMMAD)
    key = F.regexp_replace(key, "[.,:;'\"“”‘’]", " ")
    return S.null_if_empty(F.lower(S.strip(S.one_space(key))))


def split_name(text: Column) -> Column:
    """The fields of a name already in normal form."""

    def of(display: Column) -> Column:
        inner = lambda m: S.strip(S.strip(F.substr(m, F.lit(2), F.length(m) - 2)), "-–,")
        parts = F.transform(F.regexp_extract_all(display, F.lit(BRACKET), F.lit(0)), inner)
        of_kind = lambda kind: F.filter(parts, lambda p: _kind(p) == kind)
        core = S.strip(S.one_space(F.regexp_replace(display, BRACKET, " ")), " ,-–")

        def with_core(core: Column) -> Column:
            organisation = F.lit(False)
            for end in R.ORG_ENDINGS:
                organisation = organisation | (core == end) | core.endswith(f" {end}")
            ranks, short = of_kind("rank"), core
            for title in R.TRAILING_TITLES:
                ends = short.endswith(f" {title}")
                ranks = F.when(ends, F.concat(ranks, F.array(F.lit(title)))).otherwise(ranks)
                short = F.when(ends, S.strip(F.substr(short, F.lit(1), F.length(short) - len(title)))).otherwise(short)
            return F.struct(
                S.null_if_empty(display).alias("name_display"),
                _key(short).alias("name_key"),
                of_kind("honorific").alias("honorifics"),
                ranks.alias("rank_titles"),
                of_kind("descriptor").alias("descriptors"),
                of_kind("alias").alias("aliases"),
                F.when(organisation, "organisation").otherwise("person").alias("author_type"),
            )

        return S.let(core, with_core)

    none = F.struct(*(F.lit(None).cast("string").alias(n) for n in ("name_display", "name_key")), *(F.array().cast("array<string>").alias(n) for n in ("honorifics", "rank_titles", "descriptors", "aliases")), F.lit("person").alias("author_type"))
    shown = F.regexp_replace(F.regexp_replace(text, R.ARABIC, ""), S.pattern("\\(\\s*\\)"), "")
    return F.when(F.coalesce(text, F.lit("")) == "", none).otherwise(S.let(S.strip(S.one_space(shown)), of)).cast(EMPTY)


def parse_author(raw: Column) -> Column:
    return split_name(S.normalize_whitespace(bangla.normalize_bn(raw)))


def name_key(raw: Column) -> Column:
    """The key by which names match; labels of an authority file get theirs the same way."""
    return parse_author(raw)["name_key"]
