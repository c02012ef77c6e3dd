"""Unicode normalisation of Bangla text.

Legacy spellings are repaired in Column expressions. NFC needs the canonical order of combining marks, for which Spark has
no function, so that part runs as an Arrow-batched function with a memo of words.

The word rules are this library's own, written to the published behaviour: a hasanta that joins nothing goes, marks at
the start of a word go, a doubled ra or ya phala becomes one, and ta with hasanta before a consonant that it forms no
conjunct with becomes khanda ta. Conjuncts are kept as written. Latin letters, quotes and other scripts are not touched.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stemma import rules as R
from stemma.functions import strings as S

_RUN = re.compile(f"[{R.BN_BLOCK}{R.JOINERS}]+")
_SIGNS = "া-ৌৗৢৣ"
_WORD_RULES = [
    (re.compile(f"[{R.JOINERS}]"), ""),
    (re.compile(f"{R.HASANTA}+"), R.HASANTA),
    (re.compile(f"(?<!{R.CONSONANT})(?<!{R.CONSONANT}{R.NUKTA})(?:(?<![অএ]){R.HASANTA}|{R.HASANTA}(?!য))"), ""),
    (re.compile(f"{R.HASANTA}$"), ""),
    (re.compile(f"^[{_SIGNS}{R.NUKTA}{R.HASANTA}]+"), ""),
    (re.compile(f"([{_SIGNS}])\\1+"), "\\1"),
    (re.compile("(র্)\\1+"), "\\1"),
    (re.compile("(্য)\\1+"), "\\1"),
    (re.compile("(?<!্)ত্(?=[সকপখফ])"), "ৎ"),
]
_MEMO = 500_000
_memo: dict[str, str] = {}


def normalize_word(word: str) -> str:
    """One run of Bangla characters. The rules are applied until nothing changes, so the result is stable."""
    out = _memo.get(word)
    if out is None:
        out, before = unicodedata.normalize("NFC", word), None
        while out != before:
            before = out
            for rule, to in _WORD_RULES:
                out = rule.sub(to, out)
            out = unicodedata.normalize("NFC", out)
        if len(_memo) >= _MEMO:
            _memo.clear()
        _memo[word] = out
    return out


def normalize_text(text: str | None) -> str | None:
    """What the Arrow function does to each value."""
    if not text or text.isascii():
        return text
    return unicodedata.normalize("NFC", _RUN.sub(lambda m: normalize_word(m[0]), unicodedata.normalize("NFC", text)).replace("‌", "").replace("‍", ""))


@F.pandas_udf(StringType())
def _normalized(texts: pd.Series) -> pd.Series:
    return texts.map(normalize_text, na_action="ignore")


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition."""
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def repair_legacy_encoding(text: Column) -> Column:
    """Vowel signs stored in reverse, tha written as ha in conjuncts, and a lost u sign in sta and nta conjuncts."""
    text = F.replace(text, F.lit("াে"), F.lit("ো"))
    text = F.replace(text, F.lit("ৗে"), F.lit("ৌ"))
    text = F.replace(text, F.lit("স্হ"), F.lit("স্থ"))
    text = F.replace(text, F.lit("গ্রন্হ"), F.lit("গ্রন্থ"))
    return F.regexp_replace(text, "([সন]্ত)্তু?", "$1ু")


def normalize_bn(text: Column) -> Column:
    """Repaired, normalised, without joiners, in NFC; null and empty stay as they are."""
    return _normalized(S.let(text, lambda t: F.when(t.rlike(f"[{R.BN_BLOCK}]"), repair_legacy_encoding(t)).otherwise(t)))


def clean_text(text: Column) -> Column:
    """Free text made fit for use: no button label, no tags, normal form, normal white space; empty becomes null."""
    return S.null_if_empty(S.normalize_whitespace(normalize_bn(S.strip_html(S.strip_show_more(text)))))


def unshift_vowels(word: Column) -> Column:
    """Move an i or e sign that sits one consonant too far right back to the consonant before."""
    consonant = f"^{R.CONSONANT}{R.NUKTA}?\\z"
    tokens = F.regexp_extract_all(word, F.lit(f"(?s){R.CONSONANT}{R.NUKTA}?|."), F.lit(0))

    def put(out: Column, token: Column) -> Column:
        last, before = F.try_element_at(out, F.lit(-1)), F.try_element_at(out, F.lit(-2))
        shifted = token.isin("ি", "ে") & F.coalesce(last.rlike(consonant) & before.rlike(consonant), F.lit(False))
        return F.when(shifted, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(token, last))).otherwise(F.concat(out, F.array(token)))

    return F.array_join(F.aggregate(tokens, F.array().cast("array<string>"), put), "")
