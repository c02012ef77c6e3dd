"""Readers of the raw formats and writers of the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import identifiers
from stemma.sources import schemas


def json_array(spark: SparkSession, path: str, table: str, spread: int | None = None) -> DataFrame:
    """A raw table kept as one JSON array per file, gzip or plain, with ``ord``: the order of the input.

    A gzip file can't be split, so each is one task; ``spread`` deals the rows out again for what follows.
    """
    rows = spark.read.schema(schemas.TABLES[table]).option("multiLine", True).json(path)
    rows = rows.withColumn("ord", F.monotonically_increasing_id())
    return rows.repartition(spread) if spread else rows


def json_lines(spark: SparkSession, path: str, schema=schemas.FETCH_LOG) -> DataFrame:  # noqa: ANN001
    return spark.read.schema(schema).json(path)


def pages_without_book(log: DataFrame) -> DataFrame:
    """Pages that a resumed run need not ask for again."""
    return log.where(F.col("note") == "no_book").select("page_id").distinct()


def category_map(spark: SparkSession, path: str) -> DataFrame:
    """A reviewed category map (CSV) with its keys as text and its flags as booleans."""
    rows = spark.read.schema(schemas.CATEGORY_MAP).option("header", True).csv(path)
    flag = lambda c: F.lower(F.col(c)).try_cast("boolean").alias(c)
    return rows.select(*(flag(c) if c in ("religious", "is_collection") else c for c in rows.columns))


def latest_snapshot(paths: list[str]) -> str:
    """The last of dated snapshot paths."""
    return max(paths)


def people(spark: SparkSession, path: str) -> DataFrame:
    """SPARQL results (JSON) as one row per binding."""
    bound = spark.read.schema(schemas.SPARQL).option("multiLine", True).json(path).select(F.explode("results.bindings").alias("b"))
    value = lambda n: F.coalesce(F.col(f"b.{n}.value"), F.lit(""))
    text = lambda n: F.when(value(n) != "", value(n))
    names = lambda n: F.filter(F.split(value(n), "\\|"), lambda a: a != "")
    return bound.select(
        F.substring_index(value("person"), "/", -1).alias("qid"),
        text("bnLabel").alias("wd_label_bn"),
        text("enLabel").alias("wd_label_en"),
        names("bnAliases").alias("wd_aliases_bn"),
        names("enAliases").alias("wd_aliases_en"),
        identifiers.name_year(value("birthDate")).alias("birth_year"),
        identifiers.name_year(value("deathDate")).alias("death_year"),
        text("countries").alias("wd_countries"),
    )


def facts_of_people(statements: DataFrame) -> DataFrame:
    """What the collector asks the remote endpoint for, on a table of statements (person, property, value, lang).

    Labels and one birth and death date each, aliases and countries joined by bars; only writers with a Bangla or English label.
    """
    of = lambda prop, lang=None: (F.col("property") == prop) & (F.col("lang") == lang if lang else F.lit(True))
    one = lambda c: F.min(F.when(c, F.col("value")))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("value")))), "|")
    rows = statements.groupBy("person").agg(
        one(of("label", "bn")).alias("bnLabel"),
        one(of("label", "en")).alias("enLabel"),
        joined(of("alias", "bn")).alias("bnAliases"),
        joined(of("alias", "en")).alias("enAliases"),
        one(of("birth")).alias("birthDate"),
        one(of("death")).alias("deathDate"),
        joined(of("country")).alias("countries"),
        F.bool_or(of("occupation")).alias("_writes"),
    )
    return rows.where(F.col("_writes") & (F.col("bnLabel").isNotNull() | F.col("enLabel").isNotNull())).drop("_writes")


def sitemap_urls(spark: SparkSession, path: str, pattern: str = "/books/([0-9]+)") -> DataFrame:
    """(page_id, url) of the URLs in sitemaps (XML) whose path names a page."""
    rows = spark.read.format("xml").option("rowTag", "url").schema(schemas.SITEMAP_URL).load(path)
    url = F.btrim("loc")
    page = F.regexp_extract(F.parse_url(url, F.lit("PATH")), pattern, 1)
    return rows.select(page.alias("page_id"), url.alias("url")).where("page_id <> ''")


def sitemaps(spark: SparkSession, path: str, mark: str = "/books-") -> DataFrame:
    """(url) of the sitemaps that a sitemap index (XML) names and whose address holds ``mark``, in its order."""
    rows = spark.read.format("xml").option("rowTag", "sitemap").schema(schemas.SITEMAP_URL).load(path)
    return rows.select(F.btrim("loc").alias("url")).where(F.contains("url", F.lit(mark)))


def listing_codes(bodies: DataFrame, body: str = "body", pattern: str = '"bookcode"\\s*:\\s*"(\\w+)"') -> DataFrame:
    """Distinct book codes in the bodies of listing pages."""
    codes = F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(1))
    return bodies.select(F.explode(codes).alias("page_id")).distinct()


def has_book(html: Column, mark: str = '"bookdetails"') -> Column:
    """Whether a fetched page shows a book."""
    return F.contains(html, F.lit(mark))


def still_to_fetch(candidates: DataFrame, done: DataFrame, empty: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates (page_id, url) that are neither stored nor known to be empty; ``limit`` new ones if given (its feature)."""
    rows = candidates.dropDuplicates(["page_id"]).join(done.select("page_id"), "page_id", "left_anti").join(empty.select("page_id"), "page_id", "left_anti")
    return rows.orderBy("page_id").limit(limit) if limit else rows


# ---------- sinks ----------


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for small tables that people review."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A report as one text file, in whatever store the path names."""
    lines = [(line,) for line in text.removesuffix("\n").split("\n")]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(path)


def write_pages(df: DataFrame, path: str, page: str = "html", page_id: str = "page_id") -> None:
    """Fetched pages as bytes, gzip within Parquet, one folder per site: a page comes back as it was, line ends included."""
    rows = df.select(F.col(page_id).alias("page_id"), F.col(page).cast("binary").alias("body"), "site")
    rows.write.mode("append").partitionBy("site").option("compression", "gzip").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, body, html, site) of pages that ``write_pages`` wrote."""
    return spark.read.parquet(path).select("page_id", "body", F.decode("body", "UTF-8").alias("html"), "site")
