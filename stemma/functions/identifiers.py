"""Identifiers: ISBN, URL slugs, title and signature keys, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import strings as S


def isbn_digits(raw: Column) -> Column:
    """Digits and X only, Bangla digits as ASCII, upper case; null becomes empty."""
    return F.upper(F.regexp_replace(S.ascii_digits(F.coalesce(raw, F.lit(""))), "[^0-9Xx]", ""))


def _weighted(digits: Column, n: int, weight) -> Column:  # noqa: ANN001
    value = lambda i: F.when(F.substr(digits, i, F.lit(1)) == "X", 10).otherwise(F.substr(digits, i, F.lit(1)).try_cast("int"))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: value(i) * weight(i)), F.lit(0), lambda a, x: a + x)


def isbn10_ok(digits: Column) -> Column:
    return digits.rlike("^[0-9]{9}[0-9X]\\z") & (_weighted(digits, 10, lambda i: 11 - i) % 11 == 0)


def isbn13_sum(digits: Column, n: int = 13) -> Column:
    return _weighted(digits, n, lambda i: F.when(i % 2 == 1, 1).otherwise(3))


def isbn13_ok(digits: Column) -> Column:
    return digits.rlike("^[0-9]{13}\\z") & (isbn13_sum(digits) % 10 == 0)


def normalize_isbn(raw: Column) -> Column:
    """struct(isbn13, valid); a valid ISBN-10 is converted, anything else is null and false."""

    def of(d: Column) -> Column:
        core = F.concat(F.lit("978"), F.substring(d, 1, 9))
        converted = F.concat(core, ((10 - isbn13_sum(core, 12) % 10) % 10).cast("string"))
        found = F.when(isbn13_ok(d), d).when(isbn10_ok(d), converted)
        return F.struct(found.alias("isbn13"), found.isNotNull().alias("valid"))

    return S.let(isbn_digits(raw), of)


def isbn_origin(isbn13: Column) -> Column:
    """Registration group of an ISBN-13."""
    group = F.substr(isbn13, F.lit(4))
    known = F.when(group.startswith("984"), "bangladesh").when(group.startswith("81") | group.startswith("93"), "india").otherwise("other")
    return F.when(F.coalesce(isbn13, F.lit("")) != "", known)


def isbn_country(raw: Column) -> Column:
    """Group of a raw ISBN without its check digit: missing, malformed, or a country."""
    digits = F.regexp_replace(raw, "[^0-9Xx]", "")
    long = (F.length(digits) == 13) & (digits.startswith("978") | digits.startswith("979"))
    group = F.when(long, F.substr(digits, F.lit(4))).when(F.length(digits) == 10, digits)
    known = F.when(group.startswith("984"), "bangladesh").when(group.startswith("81") | group.startswith("93"), "india").otherwise("other")
    return F.when(raw.isNull(), "missing").when(group.isNull(), "malformed").otherwise(known)


def slug_of(url: Column) -> Column:
    """Last part of a url's path, lower case; null becomes empty."""
    return F.lower(F.substring_index(F.rtrim(F.coalesce(url, F.lit("")), F.lit("/")), "/", -1))


def slug_volume(slug: Column) -> Column:
    """Volume that a slug names: an ordinal with a part word, a part word with a number, or a number at the end."""
    after = "(?:^|-)([0-9]{1,2})(?:st|nd|rd|th)?-(?:" + "|".join(R.SLUG_PART_WORDS) + ")(?:-|\\z)"
    before = "(?:^|-)(?:" + "|".join(R.SLUG_PART_FIRST) + ")-([0-9]{1,2})(?:-|\\z)"
    both = f"{after}|{before}"  # the leftmost of either counts
    found = lambda p, g: S.null_if_empty(F.regexp_extract(slug, p, g))
    return F.coalesce(found(both, 1), found(both, 2), found("[a-z]-([0-9]{1,2})\\z", 1)).cast("int")


def subtitle_signature(slug: Column, n_title_words: Column, author_words: Column) -> Column:
    """Words of a slug beyond the title's that name one book, joined; empty if they are fewer than five letters."""
    words = F.filter(F.split(slug, "-"), lambda w: w != "")

    def names(w: Column) -> Column:
        number = w.rlike("^\\p{Nd}+(?:st|nd|rd|th)?\\z")
        cut = lambda end: w.endswith(end) & F.array_contains(author_words, F.substr(w, F.lit(1), F.length(w) - len(end)))
        return ~number & ~w.isin(*R.SLUG_GENERIC) & ~F.array_contains(author_words, w) & ~cut("er") & ~cut("r") & (F.length(w) > 1)

    rest = F.slice(words, n_title_words + 1, F.greatest(F.size(words), F.lit(1)))
    signature = F.array_join(F.filter(rest, names), "-")
    return F.when(F.length(F.replace(signature, F.lit("-"), F.lit(""))) >= 5, signature).otherwise("")


def title_key(title: Column) -> Column:
    """Lower case, punctuation as spaces, single spaces; null becomes empty."""
    plain = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[\"'“”‘’.,:;!?()\\[\\]\\-–—_/]", " ")
    return S.strip(S.one_space(plain))


def name_year(iso: Column) -> Column:
    """Year of an ISO date text, null if it doesn't begin with four digits."""
    return F.when(iso.rlike("^[0-9]{4}"), F.substring(iso, 1, 4).cast("int"))
