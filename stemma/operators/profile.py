"""Profile of the raw tables, before any cleaning: nine sections of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions import identifiers
from stemma.functions import strings as S
from stemma.operators import relational as rel

#: Substrings by which the profile, unlike step 7, takes a category for fiction, poetry or translation.
KEYWORDS = {
    "fiction": ("novel", "story", "stories", "fiction", "thriller", "mystery", "detective", "horror", "adventure", "fantasy", "romance", "romantic", "humor", "comics", "children & teens", "fairy", "folk tale", "উপন্যাস", "গল্প"),
    "poetry": ("poem", "poetry", "rhyme", "কবিতা"),
    "translation": ("translat", "অনুবাদ"),
}
LENGTHS = ((1, 200), (200, 500), (500, 1500), (1500, None))
#: What summaries are searched for.
SUMMARY_PATTERNS = {"flap": "ফ্ল্যাপ", "contents": "সূচিপত্র", "preface": "ভূমিকা|মুখবন্ধ", "abstract": "সংক্ষিপ্ত বিবরণ|সারসংক্ষেপ", "url": "https?://"}


def latest_scrapes(books: DataFrame) -> DataFrame:
    """One row per book: the longest summary without the trailing label, then the first."""
    summary = S.strip(F.regexp_replace(F.coalesce("book_summary", F.lit("")), S.pattern("\\s*Show More\\s*\\z"), ""))
    rows = books.withColumn("book_summary", summary)
    return rel.top1(rows.withColumn("_len", F.length("book_summary")), ["book_id"], [F.desc("_len"), F.asc("ord")]).drop("_len")


def row_counts(books: DataFrame) -> DataFrame:
    """Rows, ids, rows and groups of repeated ids, and the share of such groups with one title and one URL."""
    groups = books.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("book_title").alias("t"), F.count_distinct("book_url").alias("u"))
    many = F.col("n") > 1
    return groups.agg(
        F.sum("n").alias("rows"),
        F.count("book_id").alias("ids"),
        F.sum(F.when(many, F.col("n")).otherwise(0)).alias("repeated_rows"),
        F.count_if(many).alias("repeated_groups"),
        F.avg(F.when(many, ((F.col("t") == 1) & (F.col("u") == 1)).cast("int"))).alias("share_same"),
    )


def title_counts(books: DataFrame, links: DataFrame) -> DataFrame:
    title = F.coalesce("book_title", F.lit(""))
    first = links.groupBy("book_id").agg(F.min_by("author_id", "ord").alias("_author"))
    bare = S.strip(F.regexp_replace(F.col("book_title"), S.pattern("\\s*\\([^)]*\\)\\s*\\z"), ""))
    rows = books.join(first, "book_id", "left").withColumn("_key", F.concat_ws("|", F.coalesce(bare, F.lit("")), F.coalesce("author_id", F.lit("None"))))
    rows = rel.with_repeated(rows, ["_key"], "_again")
    latin, bangla = title.rlike("[A-Za-z]"), title.rlike("[ঀ-৿]")
    return rows.agg(F.count_if(title.rlike(S.pattern("\\([^)]*\\)\\s*\\z"))).alias("bracketed"), F.count_if(bangla).alias("bangla"), F.count_if(latin & ~bangla).alias("latin_only"), F.count_if("_again").alias("shared_title_author"))


def top_brackets(books: DataFrame, k: int = 12) -> DataFrame:
    """The k most frequent brackets at the end of titles. The limit is the feature."""
    suffix = F.regexp_extract("book_title", S.pattern("(\\([^)]*\\))\\s*\\z"), 1)
    return rel.value_counts(books.select(S.null_if_empty(suffix).alias("suffix")), "suffix").limit(k)


def summary_counts(books: DataFrame) -> DataFrame:
    text, n = F.col("book_summary"), F.length("book_summary")
    buckets = [F.count_if((n >= lo) & (n < hi if hi else F.lit(True))).alias(f"from_{lo}") for lo, hi in LENGTHS]
    patterns = [F.count_if(text.rlike(p)).alias(name) for name, p in SUMMARY_PATTERNS.items()]
    return books.agg(F.count_if(n == 0).alias("empty"), *buckets, F.median(F.when(n > 0, n)).alias("median_length"), *patterns, F.count_if((S.latin_share(text) > 0.5) & (n > 50)).alias("mostly_latin"))


def book_families(books: DataFrame, links: DataFrame, categories: DataFrame) -> DataFrame:
    """(book_id, n_categories, fiction, poetry, translation): whether any category's name holds a keyword."""
    pairs = links.select("book_id", "category_id").distinct().join(books.select("book_id"), "book_id", "left_semi")
    named = rel.lookup(pairs, categories, "category_id", ["category_name"])
    has = lambda words: F.bool_or(S.contains_any(F.coalesce(F.col("category_name"), F.lit("nan")), words, ignore_case=True))
    return named.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_categories"), *(has(words).alias(name) for name, words in KEYWORDS.items()))


def review_counts(links: DataFrame, books: DataFrame, families: DataFrame) -> DataFrame:
    """Review links, books with at least 1, 5, 10 and 50, books that say they have reviews, and fiction with at least 5."""
    per_book = links.groupBy("book_id").agg(F.count(F.lit(1)).alias("n")).join(families.select("book_id", "fiction"), "book_id", "left")
    counted = per_book.agg(F.sum("n").alias("links"), *(F.count_if(F.col("n") >= k).alias(f"at_least_{k}") for k in (1, 5, 10, 50)), F.count_if((F.col("n") >= 5) & F.coalesce("fiction", F.lit(False))).alias("fiction_at_least_5"))
    said = books.agg(F.count_if(F.coalesce(S.number(F.col("review_count")), F.lit(0)) > 0).alias("said"))
    return counted.crossJoin(said)  # one row each


def author_counts(authors: DataFrame, links: DataFrame) -> DataFrame:
    name = S.strip(F.coalesce("author", F.lit("")))
    rows = rel.with_repeated(authors.withColumn("_name", name), ["_name"], "_again").withColumn("_again", F.col("_again") & (F.col("_name") != ""))
    counted = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("author_id").alias("ids"), F.count_distinct(F.when(F.col("_again"), F.col("_name"))).alias("shared_names"), F.count_if("_again").alias("ids_of_shared"), F.count_if(F.col("bio").isNotNull()).alias("with_bio"), F.count_if(F.col("_name").rlike("[ঀ-৿]")).alias("bangla"))
    several = links.select("book_id", "author_id").distinct().groupBy("book_id").count().agg(F.count_if(F.col("count") > 1).alias("books_of_several"))
    return counted.crossJoin(several)  # one row each


def origin_counts(books: DataFrame) -> DataFrame:
    return rel.value_counts(books.select(identifiers.isbn_country(F.col("isbn")).alias("country")), "country")


def candidates(books: DataFrame, families: DataFrame) -> DataFrame:
    long = books.where(F.length("book_summary") >= 200).join(families.where("fiction").select("book_id"), "book_id", "left_semi")
    return long.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(identifiers.isbn_country(F.col("isbn")) == "india").alias("of_india"))


def profile(tables: dict[str, DataFrame]) -> str:
    """The report. ``tables``: book, author, category, publisher and the links book_to_category, book_to_author, book_to_review."""
    books = latest_scrapes(tables["book"])
    families = book_families(books, tables["book_to_category"], tables["category"])
    publisher = lambda df: rel.value_counts(rel.lookup(df, tables["publisher"], "publisher_id", ["publisher_name"]), "publisher_name")
    sections: list[tuple[str, DataFrame]] = [
        ("1. Rows and ids", row_counts(tables["book"])),
        ("2. Titles", title_counts(books, tables["book_to_author"])),
        ("2. Titles: brackets at the end", top_brackets(books)),
        ("3. Summaries", summary_counts(books)),
        ("4. Categories", families.agg(F.count(F.lit(1)).alias("books"), F.median("n_categories").alias("median_categories"), *(F.count_if(k).alias(k) for k in KEYWORDS))),
        ("4. Categories: most books", rel.value_counts(rel.lookup(tables["book_to_category"].distinct(), tables["category"], "category_id", ["category_name"]), "category_name").limit(40)),
        ("5. Origin by ISBN", origin_counts(books)),
        ("5. Origin by ISBN, fiction", origin_counts(books.join(families.where("fiction").select("book_id"), "book_id", "left_semi"))),
        ("6. Publishers", publisher(books).limit(20)),
        ("6. Publishers of Indian ISBNs", publisher(books.where(identifiers.isbn_country(F.col("isbn")) == "india")).limit(15)),
        ("7. Authors", author_counts(tables["author"], tables["book_to_author"])),
        ("8. Reviews", review_counts(tables["book_to_review"], books, families)),
        ("9. Candidate catalogue", candidates(books, families)),
    ]
    return "# Profile\n\n" + "\n".join(markdown(title, df) for title, df in sections)


def markdown(title: str, df: DataFrame) -> str:
    """A small table as Markdown: one row as key and value, more as a grid."""
    rows = df.collect()
    if len(rows) == 1:
        body = ["| metric | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in rows[0].asDict().items())]
    else:
        body = ["| " + " | ".join(df.columns) + " |", "|---" * len(df.columns) + "|", *("| " + " | ".join(map(str, r)) + " |" for r in rows)]
    return "\n".join([f"## {title}", *body, ""])
