"""Categories, steps 7 and 8: what a category says, what a book's categories say together, and where a book is from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import strings as S
from stemma.operators import relational as rel


def _has(name: Column, *words: str) -> Column:
    return name.rlike(S.whole_words(*words))


def _labels(name: Column, table: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """Labels of the rows of an ordered table whose words occur, in its order."""
    return F.filter(F.array(*(F.when(_has(name, *words), label) for label, words in table)), lambda x: x.isNotNull())


def classify(category: Column) -> Column:
    """struct of what a category's name says. The action is the first that fits; hints apply to any action, and format,
    genres and audience to mapped categories alone."""
    n = S.strip(category)
    history = _has(n, "History") & ~_has(n, "Historical Novel", "Historical Story")
    cascade = [
        (_has(n, *R.ACADEMIC), "exclude", "academic"),
        (_has(n, *R.PROMO), "ignore", "promotion"),
        (F.lower(n).isin(*R.GENERIC), "ignore", "generic"),
        (_has(n, *R.FICTION) & ~_has(n, *R.NOT_FICTION) & ~history, "map", "fiction"),
        (_has(n, *R.NONFICTION, *R.NOT_FICTION), "exclude", "nonfiction"),
    ]
    verdict = lambda action, rule: F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))
    chosen = reduce(lambda out, row: F.when(row[0], verdict(*row[1:])).otherwise(out), reversed(cascade), verdict("unknown", "unmatched"))
    english = _has(n, "Foreign Language Books?") | (_has(n, "English") & ~_has(n, "Translated", "Bangla-English"))

    def of(v: Column) -> Column:
        mapped, formats = v["action"] == "map", _labels(n, R.FORMATS)
        form = F.when(F.array_contains(formats, "comics"), "comics").when(F.size(formats) == 1, F.element_at(formats, 1))
        audience = F.when(n.rlike(f"(?iu){R.AUDIENCES[0][1]}"), R.AUDIENCES[0][0]).when(n.rlike(f"(?iu){R.AUDIENCES[1][1]}"), R.AUDIENCES[1][0])
        return F.struct(
            v["action"].alias("action"),
            v["rule"].alias("rule"),
            F.when(mapped, form).alias("format"),
            F.when(mapped, F.array_join(_labels(n, R.GENRES), "|")).otherwise("").alias("genre_hints"),
            F.when(mapped, audience).alias("audience"),
            F.when(_has(n, "Translated", "Translation"), "translated").when(_has(n, "West Bengal"), "west_bengal").alias("origin_hint"),
            F.when(english, "en").alias("language_hint"),
            _has(n, "Islamic", "Religious", "Devotional").alias("religious"),
            _has(n, "Compilation", "Collections?", "Box Sets?", "Omnibus").alias("is_collection"),
        )

    return S.let(chosen, of)


def category_map(categories: DataFrame, links: DataFrame) -> DataFrame:
    """Every category with its number of distinct books and what its name says, most books first."""
    books = links.select("book_id", "category_id").distinct().groupBy("category_id").agg(F.count(F.lit(1)).alias("books"))
    rows = categories.join(books, "category_id", "left").withColumn("_is", classify(F.col("category_name")))
    return rows.select("category_id", "category_name", F.coalesce("books", F.lit(0)).alias("books"), "_is.*").orderBy(F.desc("books"), "category_id")


def book_categories(books: DataFrame, links: DataFrame, mapping: DataFrame) -> DataFrame:
    """(book, category) pairs, the primary category among them, with what the category says."""
    primary = books.select("book_id", F.col("primary_category_id").alias("category_id"))
    pairs = links.select("book_id", "category_id").unionByName(primary).dropna().distinct()
    return pairs.join(mapping.drop("category_name", "books"), "category_id", "left")


def aggregate_books(pairs: DataFrame) -> DataFrame:
    """What a book's categories say together. Format, genres and audience come from mapped categories; flags from all."""
    action = F.coalesce("action", F.lit("unknown"))
    mapped = lambda c: F.when(action == "map", c)
    hint = F.coalesce("origin_hint", F.lit(""))
    actions = F.array_join(rel.sorted_set(action), "|")
    genres = F.array_join(rel.sorted_union(mapped(F.split(F.coalesce("genre_hints", F.lit("")), "\\|"))), "|")
    some = F.count_if(action == "map") > 0
    return pairs.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("n_categories"),
        actions.alias("category_actions"),
        some.alias("is_fiction"),
        rel.first_present(mapped(F.col("format")), R.FORMAT_ORDER).alias("format"),
        F.when(some, rel.in_conflict(mapped(F.col("format")))).alias("format_conflict"),
        F.when(genres != "", genres).alias("genre_hints"),
        rel.first_present(mapped(F.col("audience")), R.AUDIENCE_ORDER).alias("audience"),
        F.when(F.bool_or(hint == "translated"), "translated").when(F.bool_or(hint == "west_bengal"), "west_bengal").alias("category_origin_hint"),
        F.bool_or(F.coalesce("language_hint", F.lit("")) == "en").alias("category_language_en"),
        F.bool_or(F.coalesce("religious", F.lit(False))).alias("religious"),
        F.bool_or(F.coalesce("is_collection", F.lit(False))).alias("category_collection"),
        rel.joined_without(F.col("rule"), "fiction").alias("excluded_reason"),
    )


#: Origin cascade: (condition over the columns, origin, rule, confidence); the first that holds decides.
ORIGIN_RULES = (
    ("language = 'en'", "english_language", "language_en", "high"),
    ("category_origin_hint = 'translated'", "translated", "translation_category", "high"),
    ("publisher_india", "west_bengal", "publisher_india", "high"),
    ("category_origin_hint = 'west_bengal'", "west_bengal", "west_bengal_category", "high"),
    ("isbn_origin = 'india'", "west_bengal", "isbn_india", "medium"),
    ("isbn_origin = 'bangladesh'", "bangladesh", "isbn_bangladesh", "medium"),
    ("true", "bangladesh", "default", "low"),
)


def origin() -> Column:
    """struct(origin, origin_rule, origin_confidence) from language, hint, publisher and ISBN columns."""
    row = lambda r: F.struct(F.lit(r[1]).alias("origin"), F.lit(r[2]).alias("origin_rule"), F.lit(r[3]).alias("origin_confidence"))
    return reduce(lambda out, r: F.when(F.expr(r[0]), row(r)).otherwise(out), reversed(ORIGIN_RULES[:-1]), row(ORIGIN_RULES[-1]))


def with_origin(books: DataFrame, s7: DataFrame, publishers: DataFrame) -> DataFrame:
    """Books with their categories' fields, publisher, language and origin."""
    flags = ("is_fiction", "format_conflict", "category_language_en", "religious", "category_collection", "is_bundle", "is_collection")
    rows = rel.lookup(books.join(s7, "book_id", "left"), publishers, "publisher_id", ["publisher_name"])
    rows = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})
    latin = F.col("title_script").eqNullSafe("latin")
    english = latin & (F.col("category_language_en") | ~F.col("summary_script").eqNullSafe("bangla"))
    rows = rows.withColumns(
        {
            "publisher_india": F.coalesce(F.col("publisher_name").contains("(India)"), F.lit(False)),
            "language": F.when(english, "en").otherwise("bn"),
            "is_collection_any": F.col("is_collection") | F.col("category_collection"),
        }
    )
    return rows.withColumn("_origin", origin()).select("*", "_origin.*").drop("_origin")
