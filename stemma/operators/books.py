"""Books, steps 1 to 6: one row per id, clean titles and summaries, checked fields, scripts, summary classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions import bangla, identifiers, summaries, titles
from stemma.functions import strings as S
from stemma.operators.relational import top1, with_group_size

OUTPUT = """book_id dup_count title_raw title_clean binding paper volume series_hint language_hint is_bundle is_collection title_script
summary_raw summary_norm summary_clean summary_class summary_len summary_usable summary_script isbn_raw isbn13 isbn_valid isbn_origin
pages rating_avg rating_count review_count primary_category_id primary_author_id publisher_id book_url""".split()


def best_scrapes(raw: DataFrame) -> DataFrame:
    """Of the scrapes of a book the one with the longest summary, then the most filled fields, then the first.

    ``ord`` gives the order of the input. A summary counts twice among the filled fields, as it does in the published
    numbers. Only the lengths and ids take part in the choice; texts are normalised after it.
    """
    given = [c for c in raw.columns if c != "ord"]
    shown = S.strip_show_more(F.col("book_summary"))
    filled = sum((F.col(c).isNotNull().cast("int") for c in given), F.col("book_summary").isNotNull().cast("int"))
    rows = with_group_size(raw.withColumns({"_len": F.length(shown), "_filled": filled}), ["book_id"], "dup_count")
    best = top1(rows, ["book_id"], [F.desc("_len"), F.desc("_filled"), F.asc("ord")])
    return best.drop("_len", "_filled")


def clean_books(raw: DataFrame) -> DataFrame:
    """Raw scrapes to the table of books (31 columns)."""
    rows = best_scrapes(raw).withColumns(
        {
            "_title": titles.clean_title(F.col("book_title")),
            "summary_norm": bangla.clean_text(F.col("book_summary")),
            "_isbn": identifiers.normalize_isbn(F.col("isbn")),
            "_pages": S.number(S.ascii_digits(F.col("book_pages"))),
            "rating_count": F.coalesce(S.number(F.col("rating_count").cast("string")), F.lit(0)).cast("bigint"),
            "review_count": F.coalesce(S.number(F.col("review_count").cast("string")), F.lit(0)).cast("bigint"),
            "_rating": S.number(F.col("average_rating").cast("string")),
        }
    )
    rows = rows.withColumn("_class", summaries.classify_summary(F.col("summary_norm")))
    rows = rows.select(
        "*",
        "_title.*",
        F.col("_class.class").alias("summary_class"),
        F.col("_class.body").alias("summary_clean"),
        F.col("_isbn.isbn13").alias("isbn13"),
        F.col("_isbn.valid").alias("isbn_valid"),
    )
    made = rows.withColumns(
        {
            "title_raw": F.col("book_title"),
            "summary_raw": F.col("book_summary"),
            "isbn_raw": F.col("isbn"),
            "title_script": S.script_of(F.col("title_clean")),
            "summary_script": S.script_of(F.col("summary_norm")),
            "summary_len": F.coalesce(F.length("summary_clean"), F.lit(0)),
            "summary_usable": summaries.summary_usable(F.col("summary_class"), F.col("summary_clean")),
            "isbn_origin": identifiers.isbn_origin(F.col("isbn13")),
            "pages": F.when(F.col("_pages") > 0, F.col("_pages")),
            "rating_avg": F.when((F.col("rating_count") > 0) & F.col("_rating").between(1, 5), F.col("_rating")),
            "primary_category_id": F.col("category_id"),
            "primary_author_id": F.col("author_id"),
        }
    )
    return made.select(*OUTPUT)


def cleaning_metrics(raw: DataFrame, books: DataFrame) -> dict[str, int]:
    """Counts of the cleaning report, in one pass over each table."""
    n = lambda c: F.count_if(c)
    row = books.agg(
        F.count(F.lit(1)).alias("unique_books"),
        n(F.col("dup_count") > 1).alias("books_with_duplicates"),
        n(F.coalesce(F.col("summary_raw"), F.lit("")).rlike(S.pattern("\\s*Show More(?![\\p{L}\\p{N}_])"))).alias("show_more_stripped"),
        n(~F.col("title_clean").eqNullSafe(F.col("title_raw"))).alias("title_changed"),
        *(n(F.col(c).isNotNull()).alias(f"title_{c}_extracted") for c in ("binding", "paper", "volume", "series_hint", "language_hint")),
        n("is_bundle").alias("title_is_bundle"),
        n("is_collection").alias("title_is_collection"),
        n(F.coalesce("summary_norm", F.lit("")) != S.strip_show_more(F.col("summary_raw"))).alias("summary_changed_by_normalisation"),
        n(F.col("isbn_raw").isNotNull()).alias("isbn_present"),
        n("isbn_valid").alias("isbn_valid"),
        n(F.length(identifiers.isbn_digits(F.col("isbn_raw"))) == 10).alias("isbn10_converted"),
        n(F.col("rating_avg").isNull()).alias("rating_set_to_null"),
        n("summary_usable").alias("summary_usable"),
    ).first()
    return {"raw_rows": raw.count(), **row.asDict()}
