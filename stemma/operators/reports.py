"""Reports of the pipeline's steps: a few aggregations each, written as Markdown on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.operators import books as B
from stemma.operators import relational as rel


def _table(head: tuple[str, ...], rows: list[tuple]) -> list[str]:
    cell = lambda v: f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else str(v)
    return ["| " + " | ".join(head) + " |", "|---" * len(head) + "|", *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""]


def _counts(df: DataFrame, column: str) -> list[tuple]:
    return [tuple(r) for r in rel.value_counts(df, column, nulls=True).collect()]


def _numbers(df: DataFrame, **named: Column) -> list[tuple]:
    """Named aggregates in one pass, as rows."""
    return list(df.agg(*(c.alias(n) for n, c in named.items())).first().asDict().items())


def _markdown(title: str, sections: list[tuple[str, tuple[str, ...], list[tuple]]]) -> str:
    lines = [f"# {title}", ""]
    for name, head, rows in sections:
        lines += [f"## {name}", "", *_table(head, rows)]
    return "\n".join(lines)


def cleaning(raw: DataFrame, books: DataFrame) -> str:
    """Steps 1 to 6."""
    metrics = list(B.cleaning_metrics(raw, books).items())
    return _markdown("Cleaning, steps 1 to 6", [("Counts", ("metric", "value"), metrics), ("Summary classes", ("class", "books"), _counts(books, "summary_class"))])


def placing(books: DataFrame) -> str:
    """Steps 7 and 8."""
    fiction = books.where("is_fiction")
    numbers = _numbers(books, books=F.count(F.lit(1)), fiction=F.count_if("is_fiction"), format_conflicts=F.count_if(F.col("is_fiction") & F.col("format_conflict")), with_genres=F.count_if(F.col("is_fiction") & F.col("genre_hints").isNotNull()), religious=F.count_if(F.col("is_fiction") & F.col("religious")))
    origins = fiction.groupBy("origin", "origin_rule", "origin_confidence").count().orderBy("origin", "origin_rule", "origin_confidence")
    parts = [(f"Fiction by {c}", (c, "books"), _counts(fiction, c)) for c in ("format", "audience", "language")]
    return _markdown("Categories and origin, steps 7 and 8", [("Counts", ("metric", "value"), numbers), *parts, ("Origin of fiction", ("origin", "rule", "confidence", "books"), [tuple(r) for r in origins.collect()])])


def linking(authors: DataFrame, people: DataFrame) -> str:
    """Steps 9 and 10."""
    linked = F.col("wikidata_qid").isNotNull()
    some = lambda c: F.count_if(F.size(c) > 0)
    numbers = _numbers(
        authors,
        ids=F.count(F.lit(1)),
        organisations=F.count_if(F.col("author_type") == "organisation"),
        with_aliases=some("aliases"),
        with_honorifics=some("honorifics"),
        with_ranks=some("rank_titles"),
        ids_with_shared_keys=F.count_if(F.col("same_key_count") > 1),
        linked_ids=F.count_if(linked),
        linked_people=F.count_distinct("wikidata_qid"),
        linked_books=F.sum(F.when(linked, F.col("book_count")).otherwise(0)),
        all_books=F.sum("book_count"),
        our_authors=F.count_distinct("author_id"),
    )
    merged = authors.where(linked).groupBy("wikidata_qid").count().where("count > 1").count()
    methods = authors.groupBy("match_method").agg(F.count(F.lit(1)).alias("ids"), F.sum("book_count").alias("books")).orderBy("match_method")
    return _markdown("Authors, steps 9 and 10", [("Counts", ("metric", "value"), [*numbers, ("people_indexed", people.count()), ("people_with_several_ids", merged)]), ("Linking", ("method", "ids", "book links"), [tuple(r) for r in methods.collect()])])


def catalogue(works: DataFrame, editions: int) -> str:
    """Steps 11 and 12."""
    listed = F.col("in_catalogue")
    numbers = _numbers(
        works,
        works=F.count(F.lit(1)),
        with_several_editions=F.count_if(F.col("n_editions") > 1),
        largest=F.max("n_editions"),
        in_catalogue=F.count_if(listed),
        list_summaries=F.count_if(F.col("is_fiction") & F.col("list_summary")),
        garbled=F.count_if("garbled_source_text"),
        in_series=F.count_if(listed & F.col("series_group_id").isNotNull()),
        series=F.count_distinct(F.when(listed, F.col("series_group_id"))),
        from_nationality=F.count_if(listed & (F.col("origin_rule") == "author_wikidata")),
        with_genres=F.count_if(listed & (F.size("genre_hints") > 0)),
        religious=F.count_if(listed & F.col("religious")),
        collections=F.count_if(listed & F.col("is_collection")),
        linked_authors=F.count_if(listed & F.coalesce(F.col("main_author_id"), F.lit("")).startswith("au_Q")),
        with_reviews=F.count_if(listed & (F.col("review_count") > 0)),
    )
    first = works.where(~listed).select(F.element_at("exclude_reasons", 1).alias("reason"))
    chosen = works.where(listed)
    parts = [(f"Catalogue by {c}", (c, "works"), _counts(chosen, c)) for c in ("format", "summary_class", "origin", "origin_confidence", "audience")]
    return _markdown("Works and catalogue, steps 11 and 12", [("Counts", ("metric", "value"), [("editions", editions), *numbers]), ("Left out, by first reason", ("reason", "works"), _counts(first, "reason")), *parts])
