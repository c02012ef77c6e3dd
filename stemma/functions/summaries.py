"""Summaries: class by leading label or shape, usability, numbered lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import strings as S

_QUOTE = f"[{R.QUOTES}]"
_QUOTED = f"{_QUOTE}[^{R.QUOTES}\\n]{{1,80}}{_QUOTE}"
_NOT_BN = "(?![\\u0980-\\u0982\\u0984-\\u09ff])"  # a visarga may stand for a colon
_BOOK = {"optional": f"(?:(?:{R.BOOK_WORDS})\\s*)?", "required": f"(?:{R.BOOK_WORDS})\\s*", "none": ""}


def label_pattern(words: str, book: str = "optional") -> str:
    """Pattern of a label at the start of a text: a quoted title, a book word, the label's words, perhaps a colon."""
    return S.pattern(f"^{S.NOT_WORD}*(?:{_QUOTED}\\s*)?{_BOOK[book]}(?:{words}){_NOT_BN}\\s*[:ঃ\\-–—]?\\s*")


LABELS = [(name, label_pattern(words, book)) for name, book, words in R.SUMMARY_LABELS]
TAIL = S.pattern(f"\\s(?:{R.TAIL_LABELS}){_NOT_BN}")
DIALOGUE = S.pattern("^\\s*[\"“‘'\\-–—]")
QUOTED_TITLE = S.pattern(f"^\\s*{_QUOTED}\\s*(?:{R.BOOK_WORDS}|{R.QUOTED_BOOK_WORDS})")
LIST_ITEM = S.pattern("(?:^|\\s)\\p{Nd}{1,2}\\s*[.:)\\-]\\s")
LIST_ITEM_TEXT = S.pattern("(?:^|\\s)\\p{Nd}{1,2}\\s*[.:)\\-]\\s*\\P{Nd}{0,70}")


def cut_tail(text: Column) -> Column:
    """The text before a later label of contents or author."""
    return S.strip(F.element_at(F.split(text, TAIL, 2), 1))


def bullets(text: Column) -> Column:
    return F.regexp_count(text, F.lit(S.pattern("(?:^|\\s)[*•●■]\\s")))


def dialogue_lines(text: Column) -> Column:
    """struct(n, share) of lines that begin like speech, among lines that aren't white."""
    lines = F.filter(F.split(text, "\n"), lambda x: S.strip(x) != "")
    n = F.size(F.filter(lines, lambda x: x.rlike(DIALOGUE)))
    return F.struct(n.alias("n"), (n / F.greatest(F.size(lines), F.lit(1))).alias("share"))


def classify_summary(text: Column) -> Column:
    """struct(class, body) of a cleaned summary; the label goes from the body."""
    made = lambda name, body: F.struct(F.lit(name).alias("class"), body.alias("body"))
    none = made("empty", F.lit(None).cast("string"))
    named = lambda name: lambda body: F.when(body.isNull(), none).otherwise(made(name, body))
    labelled = F.lit(None).cast("struct<class:string,body:string>")
    for name, pattern in reversed(LABELS):
        rest = S.strip(F.regexp_replace(text, pattern, ""))
        found = S.let(S.null_if_empty(cut_tail(rest) if name in R.CUT_CLASSES else rest), named(name))
        labelled = F.when(text.rlike(pattern), found).otherwise(labelled)
    speech = lambda: S.let(dialogue_lines(text), lambda d: (d["n"] >= 2) & (d["share"] >= 0.3))
    shaped = lambda latin: (
        F.when(latin, made("english", text))
        .when(bullets(text) >= 5, made("toc", text))
        .when(text.rlike(DIALOGUE) & ~text.rlike(QUOTED_TITLE) & speech(), made("excerpt", text))
        .otherwise(made("blurb", cut_tail(text)))
    )
    # every label has Bangla letters, so texts without one skip the patterns, and are Latin if they have any letter
    shape = F.when(text.rlike(f"[{R.BN_LETTERS}]"), F.coalesce(labelled, shaped(S.script_of(text).eqNullSafe("latin")))).otherwise(shaped(text.rlike("[A-Za-z]")))
    return F.when(F.coalesce(text, F.lit("")) == "", none).otherwise(shape)


def summary_usable(kind: Column, body: Column) -> Column:
    """Whether a class may be used at the length it has."""
    out = F.lit(False)
    for name, least in R.USABLE_FROM.items():
        out = F.when(kind == name, F.length(body) >= least).otherwise(out)
    return F.coalesce(out & (F.coalesce(body, F.lit("")) != ""), F.lit(False))


def is_list_summary(text: Column) -> Column:
    """Four or more numbered items and under 150 characters of prose besides."""
    prose = S.strip(S.one_space(F.regexp_replace(text, LIST_ITEM_TEXT, " ")))
    return F.coalesce((F.regexp_count(text, F.lit(LIST_ITEM)) >= 4) & (F.length(prose) < 150), F.lit(False))
