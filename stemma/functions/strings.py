"""Text functions as Column expressions, with Python's meaning of white space, word characters and digits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stemma import rules as R

#: White space as Python's ``str.strip`` and ``\s`` have it. Java's ``\s`` is ASCII only.
SPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: What Python's ``\W`` matches: combining signs are no word characters there.
NOT_WORD = "[^\\p{L}\\p{N}_]"


def pattern(text: str) -> str:
    """A pattern in NFC whose ``\\s`` means SPACE."""
    return R.nfc(text).replace("\\s", SPACE)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(text: Column, more: str = "") -> Column:
    """Without white space (or the characters ``more`` instead) at both ends."""
    return F.btrim(text, F.lit(more or SPACES))


def one_space(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def normalize_whitespace(text: Column) -> Column:
    """One kind of line end, single spaces, trimmed lines, at most one empty line in a row."""
    text = if_has(text, "\r", lambda t: F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))
    text = F.translate(text, "\xa0\t", "  ")
    text = if_has(text, "  ", lambda t: F.regexp_replace(t, " {2,}", " "))
    text = if_has(text, "\n", lambda t: F.replace(F.replace(t, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))
    return strip(if_has(text, "\n\n\n", lambda t: F.regexp_replace(t, "\n{3,}", "\n\n")))


def if_has(text: Column, mark: str, change: Callable[[Column], Column]) -> Column:
    """``change`` of texts that contain ``mark``; others, found by a plain search, stay as they are."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(mark)), change(t)).otherwise(t))


def strip_show_more(text: Column) -> Column:
    """Without the label ``Show More`` and all that follows it; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    cut = F.regexp_replace(text, pattern("(?s)\\s*Show More(?![\\p{L}\\p{N}_]).*\\z"), "")
    return strip(F.when(F.contains(text, F.lit("Show More")), cut).otherwise(text))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, pattern("<\\s*/?\\s*[A-Za-z][^<>]{0,40}>"), " ")


def strip_html(text: Column) -> Column:
    """Without tags, and without what is left of ``<b>`` and ``<br>`` when brackets were lost, near a Bangla letter only."""
    residue = "(?>(?<![A-Za-z])(?:/?br?/?)+(?![A-Za-z]))"
    near = f"(?=/?b)(?:(?<=[{R.BN_LETTERS}][\\s\\S]{{0,19}}){residue}|{residue}(?=[\\s\\S]{{0,19}}[{R.BN_LETTERS}]))"
    bare = if_has(text, "<", strip_tags)
    return let(bare, lambda t: F.when(t.rlike(f"[{R.BN_LETTERS}]"), F.regexp_replace(t, near, " ")).otherwise(t))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, R.BN_DIGITS, "0123456789")


def number(text: Column) -> Column:
    """A double if the text is a number and nothing else, else null."""
    return F.when(text.rlike(pattern("^\\s*[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?\\s*\\z")), F.btrim(text).try_cast("double"))


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def script_of(text: Column, threshold: float = 0.7) -> Column:
    """bangla, latin or mixed by the share of letters; null without letters."""
    counts = F.struct(F.regexp_count(text, F.lit(f"[{R.BN_LETTERS}]")).alias("bangla"), F.regexp_count(text, F.lit("[A-Za-z]")).alias("latin"))

    def of(n: Column) -> Column:
        share = lambda k: n[k] / (n["bangla"] + n["latin"]) >= threshold
        return F.when(n["bangla"] + n["latin"] > 0, F.when(share("bangla"), "bangla").when(share("latin"), "latin").otherwise("mixed"))

    return let(counts, of)


def latin_share(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Za-z]")) / F.greatest(F.length(text), F.lit(1))


def pct(n: Column, total: Column) -> Column:
    """``1,234 (5.6%)``, or 0 of nothing."""
    shown = F.concat(F.format_number(n, 0), F.lit(" ("), F.format_string("%.1f", n / total * 100), F.lit("%)"))
    return F.when(total > 0, shown).otherwise("0")


def contains_any(text: Column, words: tuple[str, ...], ignore_case: bool = False) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | (F.lower(text).contains(w.lower()) if ignore_case else text.contains(w))
    return out


def whole_words(*words: str) -> str:
    """Pattern of whole words between non-letters, in any case."""
    return "(?iu)(?<![A-Za-z])(?:" + "|".join(words) + ")(?![A-Za-z])"


def word_list(text: Column) -> Column:
    """Words between white space; an empty text has none."""
    return F.filter(F.split(one_space(text), " "), lambda w: w != "")


def bangla_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[{R.BN_BLOCK}]+"), F.lit(0))
