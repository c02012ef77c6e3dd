"""Data quality: rules as data, counted in one aggregation per table, with a report and an exit code."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stemma import rules as R
from stemma.functions import bangla, identifiers, summaries
from stemma.functions import strings as S


@dataclass(frozen=True)
class Rule:
    """``violation`` is true for a bad row; ``aggregate`` counts violations over the whole table instead."""

    name: str
    violation: Column | None = None
    aggregate: Column | None = None
    kind: str = "hard"


@dataclass(frozen=True)
class Finding:
    kind: str
    name: str
    violations: int

    @property
    def passed(self) -> bool:
        return self.kind == "soft" or self.violations == 0


def run(df: DataFrame, rules: Iterable[Rule]) -> list[Finding]:
    """All rules of a table in one pass."""
    rules = list(rules)
    counts = [r.aggregate if r.aggregate is not None else F.count_if(F.coalesce(r.violation, F.lit(False))) for r in rules]
    row = df.agg(*(c.cast("bigint").alias(f"c{i}") for i, c in enumerate(counts))).first()
    return [Finding(r.kind, r.name, row[i] or 0) for i, r in enumerate(rules)]


def unique(*keys: str) -> Column:
    """Aggregate: rows beyond the first of their keys."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))


def missing(left: DataFrame, right: DataFrame, key: str) -> int:
    """Different keys of one table that the other lacks, both ways."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").count() + b.join(a, key, "left_anti").count()


def report(title: str, findings: list[Finding]) -> str:
    hard = [f for f in findings if f.kind == "hard"]
    lines = [f"# {title}", "", "| Kind | Check | Result | Violations |", "|---|---|---|---|"]
    lines += [f"| {f.kind} | {f.name} | {'info' if f.kind == 'soft' else 'pass' if f.passed else 'FAIL'} | {f.violations:,} |" for f in findings]
    return "\n".join([*lines, "", f"**{sum(f.passed for f in hard)} of {len(hard)} hard checks passed.**"]) + "\n"


def exit_code(findings: list[Finding]) -> int:
    return int(not all(f.passed for f in findings))


# ---------- the normaliser's audit ----------

_DOUBLED = re.compile("্(.)্\\1|(.)্\\2্")
_CONJUNCT = re.compile(f"{R.CONSONANT}(?=্{R.CONSONANT})")


@F.pandas_udf(StringType())
def _lost(words: pd.Series) -> pd.Series:
    """consonant or conjunct: what normalising a word loses without an accepted reason."""

    def of(word: str) -> str | None:
        out = bangla.normalize_word(word)
        if out == word or _DOUBLED.search(word) or ("ত্" in word and "ৎ" in out):
            return None
        before, after = unicodedata.normalize("NFD", word), unicodedata.normalize("NFD", out)
        if len(re.findall(R.CONSONANT, after)) < len(re.findall(R.CONSONANT, before)):
            return "consonant"
        return "conjunct" if len(_CONJUNCT.findall(after)) < len(_CONJUNCT.findall(before)) else None

    return words.map(of)


def audit_words(texts: DataFrame, text: str) -> dict[str, int]:
    """Different Bangla words of all texts whose normal form loses a consonant or a conjunct, and their number."""
    prepared = bangla.nfc(bangla.repair_legacy_encoding(F.col(text)))
    words = texts.select(F.explode(F.regexp_extract_all(prepared, F.lit(f"[{R.BN_BLOCK}{R.JOINERS}]+"), F.lit(0))).alias("word")).distinct()
    row = words.select(_lost("word").alias("lost")).agg(F.count(F.lit(1)).alias("words"), F.count_if(F.col("lost") == "consonant").alias("consonant"), F.count_if(F.col("lost") == "conjunct").alias("conjunct")).first()
    return row.asDict()


# ---------- the forty checks ----------


def book_checks(raw: DataFrame, books: DataFrame) -> list[Finding]:
    """Eighteen hard and three soft checks of steps 1 to 6. What the reference samples is checked on all rows here."""
    clean, title = F.coalesce("summary_clean", F.lit("")), F.coalesce("title_clean", F.lit(""))
    both = F.concat(clean, F.lit("\n"), title)
    norm_title = S.normalize_whitespace(bangla.normalize_bn(F.coalesce("title_raw", F.lit(""))))
    books = books.withColumns({"_norm_title": norm_title, "_again": bangla.normalize_bn(clean), "_nfc": bangla.nfc(clean), "_isbn": identifiers.normalize_isbn(F.col("isbn13"))})
    soft = lambda name, c: Rule(name, c, kind="soft")
    rules = [
        Rule("book_id is unique", aggregate=unique("book_id")),
        Rule("summary_clean is part of the normalised summary", F.col("summary_clean").isNotNull() & ~F.contains(F.coalesce("summary_norm", F.lit("")), F.col("summary_clean"))),
        Rule("no button label is left", clean.contains("Show More")),
        Rule("no vowel signs in reverse are left", both.rlike("াে|ৗে")),
        Rule("no joiners are left", both.rlike(f"[{R.JOINERS}]")),
        Rule("no summary starts with a combining mark", clean.rlike("^[\\p{Mn}\\p{Mc}]")),
        Rule("normalising again changes nothing", F.col("_again") != clean),
        Rule("cleaned summaries are in NFC", F.col("_nfc") != clean),
        Rule("every isbn13 passes its checksum", F.col("isbn13").isNotNull() & ~((F.col("_isbn.isbn13") == F.col("isbn13")) & F.col("_isbn.valid"))),
        Rule("isbn_valid exactly when isbn13 is set", F.col("isbn_valid") != F.col("isbn13").isNotNull()),
        Rule("rating_avg is null or from 1 to 5", ~F.col("rating_avg").between(1, 5)),
        Rule("usable summaries meet the length rule", F.col("summary_usable") & ~summaries.summary_usable(F.col("summary_class"), F.col("summary_clean"))),
        Rule("words of the title come from the raw title", ~F.forall(S.word_list(title), lambda w: F.contains(F.col("_norm_title"), w))),
        Rule("no title is emptied", F.col("title_clean").isNull() & (F.coalesce("title_raw", F.lit("")) != "")),
        soft("blurbs with a flap word near their start", (F.col("summary_class") == "blurb") & S.contains_any(F.substring(clean, 1, 120), R.FLAP_WORDS)),
        soft("tag residue left", clean.rlike(f"(?<![A-Za-z])/?bbr|(?<![A-Za-z])br(?=[{R.BN_BLOCK}])")),
        soft("excerpts", F.col("summary_class") == "excerpt"),
    ]
    found = run(books, rules)
    ids = raw.select("book_id").distinct()
    found.insert(1, Finding("hard", "row count equals different raw ids", abs(ids.count() - books.count())))
    found.insert(2, Finding("hard", "raw ids are all present and no others", missing(ids, books, "book_id")))
    lost = audit_words(raw, "book_summary")
    return [*found, Finding("hard", "the normaliser removes consonants only as accepted", lost["consonant"]), Finding("hard", "no conjunct is broken except as accepted", lost["conjunct"])]


def _outside(values: Column, allowed: Iterable[str]) -> Column:
    return F.size(F.array_except(values, F.array(*map(F.lit, allowed), F.lit("")))) > 0


def catalogue_checks(mapping: DataFrame, books: DataFrame, authors: DataFrame, works: DataFrame, editions: DataFrame, expected_books: int | None = None) -> list[Finding]:
    """Twenty-two hard and three soft checks of steps 7 to 12."""
    mapped, name = F.col("action") == "map", F.col("category_name")
    found = run(
        mapping,
        [
            Rule("every category has an action", ~F.coalesce("action", F.lit("")).isin(*R.ACTION_TAGS)),
            Rule("no History category is mapped", mapped & name.rlike("(?<![A-Za-z])History(?![A-Za-z])") & ~name.contains("Historical")),
            Rule("known false positives are not mapped", mapped & name.rlike("Artificial Intelligence|Kindergarten|Non-?Fiction")),
            Rule("genre hints of categories are in the vocabulary", mapped & _outside(F.split(F.coalesce("genre_hints", F.lit("")), "\\|"), R.GENRE_TAGS)),
            Rule("formats are in the vocabulary", mapped & F.col("format").isNotNull() & ~F.col("format").isin(*R.FORMAT_TAGS, "")),
        ],
    )
    complete = F.abs(F.count(F.lit(1)) - F.lit(expected_books)) if expected_books is not None else F.lit(0)
    found += run(
        books,
        [
            Rule("book_id is unique and complete", aggregate=unique("book_id") + complete),
            Rule("origins are in the allowed set", ~F.coalesce("origin", F.lit("")).isin(*R.ORIGIN_TAGS)),
            Rule("English books have the origin english_language", (F.col("language") == "en") & (F.col("origin") != "english_language")),
            Rule("fiction books have a mapped category", F.col("is_fiction") & ~F.array_contains(F.split(F.coalesce("category_actions", F.lit("")), "\\|"), "map")),
        ],
    )
    linked = F.col("wikidata_qid").isNotNull()
    found += run(
        authors,
        [
            Rule("one row per source author", aggregate=unique("rokomari_author_id")),
            Rule("links passed all rules of evidence", linked & ~((F.col("match_method") == "exact_key") & F.col("has_fiction") & (F.col("same_key_count") == 1))),
            Rule("no organisation is linked", linked & (F.col("author_type") != "person")),
            Rule("author_id names the linked person", linked & (F.col("author_id") != F.concat(F.lit("au_"), "wikidata_qid"))),
        ],
    )
    found += run(
        works,
        [
            Rule("work_id is unique", aggregate=unique("work_id")),
            Rule("genre hints of works are in the vocabulary", _outside(F.col("genre_hints"), R.GENRE_TAGS)),
            Rule("in_catalogue exactly without reasons", F.col("in_catalogue") != (F.size("exclude_reasons") == 0)),
            Rule("catalogue works are usable Bangla fiction, no bundles", F.col("in_catalogue") & ~(F.col("is_fiction") & (F.col("language") == "bn") & ~F.col("is_bundle") & F.col("summary_usable"))),
            Rule("catalogue works have a title and a summary of 200 characters", F.col("in_catalogue") & (F.col("title_bn").isNull() | (F.length(F.coalesce("summary", F.lit(""))) < 200))),
            Rule("origins of the catalogue are the three literary ones", F.col("in_catalogue") & ~F.coalesce("origin", F.lit("")).isin("bangladesh", "west_bengal", "translated")),
            Rule("catalogue works with a low-confidence origin", F.col("in_catalogue") & (F.col("origin_confidence") == "low"), kind="soft"),
            Rule("catalogue works without format", F.col("in_catalogue") & F.col("format").isNull(), kind="soft"),
        ],
    )
    per_work = editions.groupBy("work_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(identifiers.title_key(F.col("title_clean"))).alias("titles"),
        F.count_distinct("main_author_id").alias("authors"),
        F.count_if(F.col("main_author_id").isNull()).alias("unknown"),
    )
    found += run(
        per_work.join(works.select("work_id", "n_editions"), "work_id", "full_outer"),
        [
            Rule("every edition is in one work and the counts agree", ~F.col("n").eqNullSafe(F.col("n_editions"))),
            Rule("merged editions share one title key and one author", (F.col("n") > 1) & ((F.col("titles") != 1) | (F.col("authors") != 1))),
            Rule("no edition without author is merged", (F.col("n") > 1) & (F.col("unknown") > 0)),
        ],
    )
    (twice,) = run(editions, [Rule("an edition is listed once", aggregate=unique("book_id"))])
    one_work = "every edition is in one work and the counts agree"
    return [Finding(f.kind, f.name, f.violations + twice.violations) if f.name == one_work else f for f in found]


def as_table(findings_of: DataFrame, rules: list[Rule]) -> DataFrame:
    """(name, violations) rows of one pass over a table, without leaving the engine."""
    counts = [r.aggregate if r.aggregate is not None else F.count_if(F.coalesce(r.violation, F.lit(False))) for r in rules]
    one = findings_of.agg(F.array(*(F.struct(F.lit(r.name).alias("name"), c.cast("bigint").alias("violations")) for r, c in zip(rules, counts, strict=True))).alias("found"))
    return one.select(F.explode("found").alias("f")).select("f.*")
