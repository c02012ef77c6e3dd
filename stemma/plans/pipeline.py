"""The catalogue pipeline: twelve steps in five stages, with Parquet between them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stemma.operators import authors, books, categories, profile, quality, reports, works
from stemma.sources import raw


@dataclass
class Layout:
    """Where raw tables are read and results written; any store Spark knows."""

    raw: str
    out: str
    suffix: str = ".json.gz"
    people: str | None = None
    year: int = 2026
    spread: int | None = None
    reviewed_map: str | None = None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return raw.json_array(spark, f"{self.raw}/{name}{self.suffix}", name, self.spread if name == "book" else None)

    def result(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.out}/{name}")

    def write(self, df: DataFrame, name: str) -> None:
        raw.write_table(df, f"{self.out}/{name}")


def clean(spark: SparkSession, at: Layout) -> None:
    """Steps 1 to 6."""
    at.write(books.clean_books(at.table(spark, "book")), "books")


def map_categories(spark: SparkSession, at: Layout) -> None:
    """Step 7, the map: built from rules unless a reviewed one is given."""
    made = raw.category_map(spark, at.reviewed_map) if at.reviewed_map else categories.category_map(at.table(spark, "category"), at.table(spark, "book_to_category"))
    at.write(made, "category_map")


def place(spark: SparkSession, at: Layout) -> None:
    """Steps 7 and 8: fields of the categories, language and origin of books."""
    cleaned = at.result(spark, "books")
    pairs = categories.book_categories(cleaned, at.table(spark, "book_to_category"), at.result(spark, "category_map"))
    at.write(categories.with_origin(cleaned, categories.aggregate_books(pairs), at.table(spark, "publisher")), "books_s8")


def link(spark: SparkSession, at: Layout) -> None:
    """Steps 9 and 10."""
    people = raw.people(spark, at.people)
    at.write(authors.link_authors(at.table(spark, "author"), at.table(spark, "book_to_author"), at.result(spark, "books_s8"), people, at.year, at.people), "authors")


def group(spark: SparkSession, at: Layout) -> None:
    """Steps 11 and 12."""
    made = works.build_works(at.result(spark, "books_s8"), at.result(spark, "authors"), at.table(spark, "book_to_author"))
    for df, name in zip(made, ("works", "editions", "authors_in_use"), strict=True):
        at.write(df, name)


STAGES: list[tuple[str, Callable[[SparkSession, Layout], None]]] = [("clean", clean), ("map_categories", map_categories), ("place", place), ("link", link), ("group", group)]


def run(spark: SparkSession, at: Layout) -> None:
    for _, stage in STAGES:
        stage(spark, at)


def validate(spark: SparkSession, at: Layout, expected_books: int | None = None) -> list[quality.Finding]:
    """All checks on the written results."""
    found = quality.book_checks(at.table(spark, "book"), at.result(spark, "books"))
    tables = [at.result(spark, n) for n in ("category_map", "books_s8", "authors", "works", "editions")]
    return [*found, *quality.catalogue_checks(*tables, expected_books=expected_books)]


def report(spark: SparkSession, at: Layout) -> str:
    """Profile of the raw tables as Markdown."""
    names = ("book", "author", "category", "publisher", "book_to_category", "book_to_author", "book_to_review")
    return profile.profile({n: at.table(spark, n) for n in names})


def write_reports(spark: SparkSession, at: Layout) -> dict[str, str]:
    """The reports of all steps and the profile, written below ``reports``; returned by name."""
    made = {
        "cleaning": reports.cleaning(at.table(spark, "book"), at.result(spark, "books")),
        "placing": reports.placing(at.result(spark, "books_s8")),
        "linking": reports.linking(at.result(spark, "authors"), raw.people(spark, at.people)),
        "catalogue": reports.catalogue(at.result(spark, "works"), at.result(spark, "editions").count()),
        "checks": quality.report("Checks", validate(spark, at)),
        "profile": report(spark, at),
    }
    for name, text in made.items():
        raw.write_text(spark, text, f"{at.out}/reports/{name}")
    return made
