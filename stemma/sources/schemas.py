"""Declared schemas of the raw tables. Every id is a string, because raw files disagree about its type."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType


def _fields(*names: str, **typed: DataType) -> StructType:
    return StructType([*(StructField(n, StringType()) for n in names), *(StructField(n, t) for n, t in typed.items())])


BOOK = _fields("book_id", "book_title", "category_id", "book_summary", "isbn", "book_pages", "author_id", "publisher_id", "average_rating", "rating_count", "review_count", "book_url")
AUTHOR = _fields("author_id", "author", "bio", "follower_count")
CATEGORY = _fields("category_id", "category_name")
PUBLISHER = _fields("publisher_id", "publisher_name")
BOOK_TO_CATEGORY = _fields("book_id", "category_id")
BOOK_TO_AUTHOR = _fields("book_id", "author_id")
BOOK_TO_REVIEW = _fields("book_id", "review_id")
TABLES = {"book": BOOK, "author": AUTHOR, "category": CATEGORY, "publisher": PUBLISHER, "book_to_category": BOOK_TO_CATEGORY, "book_to_author": BOOK_TO_AUTHOR, "book_to_review": BOOK_TO_REVIEW}

_VALUE = StructType([StructField("value", StringType())])
_BINDING = StructType([StructField(n, _VALUE) for n in ("person", "bnLabel", "enLabel", "bnAliases", "enAliases", "birthDate", "deathDate", "countries")])
SPARQL = StructType([StructField("results", StructType([StructField("bindings", ArrayType(_BINDING))]))])
FETCH_LOG = _fields("page_id", "url", "fetched_at", "note", "error", status=IntegerType(), bytes=LongType())
MANIFEST = _fields("path", "sha256", "source_url", "license", "fetched_at", files=LongType(), bytes=LongType())
SITEMAP_URL = _fields("loc", "lastmod")
CATEGORY_MAP = StructType([*_fields("category_id", "category_name", books=LongType()).fields, *_fields("action", "rule", "format", "genre_hints", "audience", "origin_hint", "language_hint", "religious", "is_collection").fields])
