"""Titles: what stands in brackets is sorted out by kind, the rest is the title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import bangla
from stemma.functions import strings as S

PAREN = r"\([^()]*\)|\[[^\[\]]*\]"
VOLUME = S.pattern(f"(?i)^\\s*(?:{R.VOLUME_BEFORE})?\\s*([০-৯\\p{{Nd}}]+)\\s*(?:{R.VOLUME_ORDINALS})?\\s*(?:{R.VOLUME_AFTER})?\\s*\\z")
FIELDS = "struct<title_clean:string,binding:string,paper:string,volume:int,series_hint:string,language_hint:string,is_bundle:boolean,is_collection:boolean>"


def _lookup(table: dict[str, str], key: Column) -> Column:
    out = F.lit(None).cast("string")
    for word, value in table.items():
        out = F.when(key == word, value).otherwise(out)
    return out


def _part(m: Column) -> Column:
    """struct(kind, value, out) of one bracket: out is what stays of it in the title."""
    inner = S.strip(F.substr(m, F.lit(2), F.length(m) - 2))

    def of(text: Column) -> Column:
        low = F.lower(text)
        made = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(" ").alias("out"))
        binding, paper, language = _lookup(R.BINDING, low), _lookup(R.PAPER, text), _lookup(R.LANGUAGE, low)
        return (
            F.when(binding.isNotNull(), made("binding", binding))
            .when(paper.isNotNull(), made("paper", paper))
            .when(text.rlike(VOLUME), made("volume", S.ascii_digits(F.regexp_extract(text, VOLUME, 1))))
            .when(language.isNotNull(), made("language", language))
            .when(S.contains_any(text, R.SERIES_WORDS), made("series", text))
            .when(S.contains_any(text, R.MARKETING), made("marketing", text))
            .otherwise(F.struct(F.lit("kept").alias("kind"), text.alias("value"), m.alias("out")))
        )

    return S.let(inner, of)


def split_title(text: Column) -> Column:
    """The fields of a title already in normal form."""

    def of(t: Column) -> Column:
        parts = F.transform(F.regexp_extract_all(t, F.lit(PAREN), F.lit(0)), _part)
        gaps = F.split(t, PAREN, -1)

        def built(ps: Column) -> Column:
            last = lambda kind: F.try_element_at(F.filter(ps, lambda p: p["kind"] == kind), F.lit(-1))["value"]
            joined = F.array_join(F.zip_with(gaps, ps, lambda g, p: F.concat(g, F.coalesce(p["out"], F.lit("")))), "")
            clean = S.null_if_empty(S.strip(S.one_space(joined), " -–—,:"))
            return F.struct(
                clean.alias("title_clean"),
                last("binding").alias("binding"),
                last("paper").alias("paper"),
                last("volume").try_cast("int").alias("volume"),
                last("series").alias("series_hint"),
                last("language").alias("language_hint"),
                S.contains_any(t, R.BUNDLE_MARKERS, ignore_case=True).alias("is_bundle"),
                S.contains_any(joined, R.COLLECTION_WORDS).alias("is_collection"),
            )

        return S.let(parts, built)

    empty = F.struct(*(F.lit(None).cast(t).alias(n) for n, t in [("title_clean", "string"), ("binding", "string"), ("paper", "string"), ("volume", "int"), ("series_hint", "string"), ("language_hint", "string")]), F.lit(False).alias("is_bundle"), F.lit(False).alias("is_collection"))
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(S.let(text, of)).cast(FIELDS)


def clean_title(raw: Column) -> Column:
    """The fields of a raw title. Unknown brackets, such as honorifics, stay in the title."""
    return split_title(S.normalize_whitespace(bangla.normalize_bn(raw)))
