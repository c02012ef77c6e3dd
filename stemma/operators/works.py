"""Works, steps 11 and 12: editions grouped into works, and the catalogue with reasons for what it leaves out."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import bangla, identifiers, summaries
from stemma.functions import strings as S
from stemma.operators import relational as rel
from stemma.operators.storage import settle

SIMILAR = 0.7
#: A word that occurs so often in candidate summaries is common.
COMMON_FROM = 30
EDITION_COLUMNS = """book_id work_id title_clean title_raw main_author_id author_ids binding paper volume volume_used slug subtitle_sig isbn13
pages publisher_name rating_avg rating_count review_count summary_class summary_usable book_url""".split()


def similar_label(signatures: list[str], threshold: float = SIMILAR) -> dict[str, str]:
    """Each signature's cluster: the first earlier one, in sorted order, that is similar; empty ones stay by themselves."""
    heads: list[str] = []
    labels = {"": ""}
    for s in sorted({s for s in signatures if s}):
        labels[s] = next((h for h in heads if SequenceMatcher(None, h, s).ratio() >= threshold), s)
        if labels[s] == s:
            heads.append(s)
    return labels


def cluster_signatures(rows: DataFrame, key: str, signature: str, out: str) -> DataFrame:
    """(key, signature, out): clusters of the different signatures of each key.

    Keys with a single signature need no comparison and stay in the engine; the others go to pandas by key, one row for
    each different signature.
    """
    different = rows.select(key, signature).distinct()
    several = different.groupBy(key).count().where("count > 1").select(key)
    alone = different.join(several, key, "left_anti").withColumn(out, F.col(signature))

    def label(group: pd.DataFrame) -> pd.DataFrame:
        labels = similar_label(group[signature].tolist())
        return group.assign(**{out: group[signature].map(labels)})[[key, signature, out]]

    kind = rows.schema[key].dataType.simpleString()
    many = different.join(several, key, "left_semi").groupBy(key).applyInPandas(label, f"{key} {kind}, {signature} string, {out} string")
    return alone.unionByName(many)


def resolve_authors(books: DataFrame, authors: DataFrame, links: DataFrame) -> DataFrame:
    """Books with ``author_ids`` (all linked, sorted) and ``main_author_id`` (the book's own, else the first linked)."""
    ours = authors.groupBy("rokomari_author_id").agg(F.min("author_id").alias("_ours"))
    pairs = links.select("book_id", F.col("author_id").alias("rokomari_author_id")).distinct().join(ours, "rokomari_author_id", "left")
    linked = pairs.groupBy("book_id").agg(rel.sorted_set("_ours").alias("author_ids"))
    rows = books.join(linked, "book_id", "left").withColumn("author_ids", F.coalesce("author_ids", F.array().cast("array<string>")))
    main = ours.select(F.col("rokomari_author_id").alias("primary_author_id"), F.col("_ours").alias("_main"))
    rows = rows.join(main, "primary_author_id", "left")
    return rows.withColumn("main_author_id", F.coalesce("_main", F.try_element_at("author_ids", F.lit(1)))).drop("_main")


def with_work_ids(books: DataFrame, authors: DataFrame) -> DataFrame:
    """Books with title key, slug, volume, signature, cluster, work key and work id.

    Editions meet in a work by title, main author, volume and signature cluster. Bundles, placeholder and empty titles
    and books without author never meet others.
    """
    people = authors.groupBy("author_id").agg(F.min_by("wd_label_en", rel.file_order(authors, "rokomari_author_id")).alias("_en")).withColumnRenamed("author_id", "main_author_id")
    rows = books.join(people, "main_author_id", "left")
    rows = rows.withColumns({"title_key": identifiers.title_key(F.col("title_clean")), "slug": identifiers.slug_of(F.col("book_url"))})
    author_words = S.word_list(F.lower(F.coalesce("_en", F.lit(""))))
    rows = rows.withColumns(
        {
            "volume_used": F.coalesce("volume", identifiers.slug_volume(F.col("slug"))),
            "subtitle_sig": identifiers.subtitle_signature(F.col("slug"), F.size(S.word_list(F.col("title_key"))), author_words),
        }
    ).drop("_en")
    base = F.concat_ws("|", "title_key", F.coalesce("main_author_id", F.lit("?")), F.coalesce(F.col("volume_used").cast("string"), F.lit("")))
    rows = rel.with_repeated(rows.withColumn("_base", base), ["_base"], "_multi")
    clusters = cluster_signatures(rows.where("_multi"), "_base", "subtitle_sig", "_cluster")
    rows = rows.join(clusters, ["_base", "subtitle_sig"], "left").withColumn("subtitle_cluster", F.coalesce("_cluster", F.lit("")))
    apart = F.coalesce("is_bundle", F.lit(False)) | F.col("title_key").isin(*R.PLACEHOLDER_TITLES, "") | F.col("main_author_id").isNull()
    key = F.when(apart, F.concat(F.lit("single|"), "book_id")).otherwise(F.concat_ws("|", "_base", "subtitle_cluster"))
    rows = settle(rows.withColumn("work_key", key).drop("_base", "_multi", "_cluster"))
    return rows.join(rel.dense_ids(rows, "work_key", "work_id", "bk_%06d"), "work_key")


def _rank(column: str, ranks: dict[str, int], other: int):  # noqa: ANN202
    out = F.lit(other)
    for name, n in ranks.items():
        out = F.when(F.col(column) == name, n).otherwise(out)
    return out


def aggregate_works(editions: DataFrame, authors: DataFrame) -> DataFrame:
    """One row per work. Best edition and most confident origin are picked by ordered minima in the same aggregation."""
    number = F.col("book_id").cast("bigint")
    best_order = F.struct((~F.col("summary_usable")).alias("a"), _rank("summary_class", R.SUMMARY_RANK, 9).alias("b"), (-F.col("summary_len")).alias("c"), number.alias("d"), F.col("book_id").alias("e"))
    origin_order = F.struct((F.col("language") != "bn").alias("a"), _rank("origin_confidence", R.CONFIDENCE_RANK, 9).alias("b"), number.alias("c"), F.col("book_id").alias("d"))
    best = ("title_clean", "title_raw", "volume_used", "slug", "subtitle_sig", "main_author_id", "book_id", "summary_class", "summary_clean", "summary_len", "summary_usable", "pages")
    works = editions.groupBy("work_id").agg(
        F.min_by(F.struct(*best), best_order).alias("_best"),
        F.min_by(F.struct("origin", "origin_rule", "origin_confidence"), origin_order).alias("_origin"),
        rel.first_value("series_hint", number).alias("series_hint"),
        rel.sorted_union(F.col("author_ids")).alias("author_ids"),
        rel.sorted_list("book_id").alias("edition_ids"),
        F.count(F.lit(1)).alias("n_editions"),
        F.bool_or("is_fiction").alias("is_fiction"),
        rel.smallest_mode("format").alias("format"),
        rel.sorted_union(F.split("genre_hints", "\\|")).alias("genre_hints"),
        rel.first_present(F.col("audience"), R.AUDIENCE_ORDER).alias("audience"),
        F.bool_or("religious").alias("religious"),
        F.when(F.bool_or(F.col("language") == "bn"), "bn").otherwise("en").alias("language"),
        F.bool_and("is_bundle").alias("is_bundle"),
        F.bool_or("is_collection_any").alias("is_collection"),
        rel.sorted_set("isbn13").alias("isbn13"),
        F.sum("rating_count").alias("rating_count"),
        F.sum("review_count").alias("review_count"),
        rel.weighted_mean("rating_avg", "rating_count").alias("rating_avg"),
    )
    works = works.withColumn("main_author_id", F.col("_best.main_author_id"))
    hints = authors.groupBy("author_id").agg(F.min_by("origin_hint", rel.file_order(authors, "rokomari_author_id")).alias("_hint")).withColumnRenamed("author_id", "main_author_id")
    works = works.join(hints, "main_author_id", "left")
    use = (F.col("_origin.origin") != "translated") & (F.col("language") == "bn") & F.col("_hint").isin("bangladesh", "west_bengal")
    use = F.coalesce(use, F.lit(False))
    pick = lambda c, instead: F.when(use, instead).otherwise(F.col(f"_origin.{c}")).alias(c)
    return works.select(
        "work_id",
        F.col("_best.title_clean").alias("title_bn"),
        "_best.title_raw",
        F.col("_best.volume_used").alias("volume"),
        F.translate("_best.slug", "-", " ").alias("slug_title"),
        "_best.subtitle_sig",
        *("series_hint", "main_author_id", "author_ids", "edition_ids", "n_editions", "is_fiction", "format", "genre_hints", "audience", "religious", "language"),
        pick("origin", F.col("_hint")),
        pick("origin_rule", F.lit("author_wikidata")),
        pick("origin_confidence", F.lit("high")),
        "is_bundle",
        "is_collection",
        F.col("_best.book_id").alias("summary_source_book_id"),
        "_best.summary_class",
        F.col("_best.summary_clean").alias("summary"),
        "_best.summary_len",
        "_best.summary_usable",
        "_best.pages",
        *("isbn13", "rating_count", "review_count", "rating_avg"),
        F.lit("rokomaribg").alias("source"),
    )


def with_series(works: DataFrame) -> DataFrame:
    """``series_group_id``: works that share title and author. Repeats are counted over all works; bundles get no group."""
    key = F.concat_ws("|", identifiers.title_key(F.col("title_bn")), F.coalesce("main_author_id", F.lit("")))
    rows = rel.with_repeated(works.withColumn("_key", key), ["_key"], "_multi")
    multi = F.col("_multi") & F.col("main_author_id").isNotNull() & ~F.col("is_bundle")
    rows = settle(rows.withColumn("_group", F.when(multi, F.col("_key"))).drop("_multi", "_key"))
    return rows.join(rel.dense_ids(rows, "_group", "series_group_id", "sg_%05d"), "_group", "left").drop("_group")


def common_words(texts: DataFrame, text: str, least: int = COMMON_FROM, words: Callable[[Column], Column] = S.bangla_words) -> DataFrame:
    """(word): words, Bangla ones unless told otherwise, that occur ``least`` times or more."""
    return texts.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").count().where(F.col("count") >= least).select("word")


def displaced_words(texts: DataFrame, key: str, text: str, common: DataFrame) -> DataFrame:
    """(key, n_bad, n_bad_different, n_words): words of 4 characters or more that become common once a sign moves back.

    Every different word is judged once, and the result joined to its occurrences.
    """
    words = texts.select(key, F.explode(S.bangla_words(F.col(text))).alias("word")).where(F.length("word") >= 4)
    seen = words.select("word").distinct().join(common, "word", "left_anti").withColumn("_moved", bangla.unshift_vowels(F.col("word")))
    bad = seen.where(F.col("_moved") != F.col("word")).join(common.withColumnRenamed("word", "_moved"), "_moved", "left_semi").select("word", F.lit(1).alias("_bad"))
    return words.join(bad, "word", "left").groupBy(key).agg(
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("n_bad"),
        F.count_distinct(F.when(F.col("_bad").isNotNull(), F.col("word"))).alias("n_bad_different"),
        F.count(F.lit(1)).alias("n_words"),
    )


def with_catalogue(works: DataFrame) -> DataFrame:
    """Works with list and garbled flags, the reasons against each and whether the catalogue has it."""
    candidate = F.col("is_fiction") & (F.col("language") == "bn") & ~F.col("is_bundle") & F.col("summary_usable")
    works = settle(works.withColumn("_candidate", candidate))
    chosen = works.where("_candidate")
    common = settle(common_words(chosen, "summary"))
    of_summary = displaced_words(chosen, "work_id", "summary", common)
    of_title = displaced_words(chosen, "work_id", "title_bn", common).where("n_bad > 0").select("work_id", F.lit(True).alias("_title"))
    garbled = of_summary.where((F.col("n_bad") / F.greatest("n_words", F.lit(1)) > 0.05) | (F.col("n_bad_different") >= 3)).select("work_id", F.lit(True).alias("_summary"))
    rows = works.join(garbled, "work_id", "left").join(of_title, "work_id", "left")
    rows = rows.withColumns({"list_summary": summaries.is_list_summary(F.col("summary")), "garbled_source_text": F.coalesce("_summary", "_title", F.lit(False))})
    flags = [
        ("not_fiction", ~F.col("is_fiction")),
        ("english_language", F.col("language") != "bn"),
        ("store_bundle", F.col("is_bundle")),
        ("no_usable_summary", ~F.col("summary_usable")),
        ("list_summary", F.col("list_summary")),
        ("garbled_source_text", F.col("garbled_source_text")),
    ]
    rows = rows.withColumn("exclude_reasons", rel.true_names(flags)).withColumn("in_catalogue", F.size("exclude_reasons") == 0)
    return rows.drop("_candidate", "_summary", "_title")


def build_works(books: DataFrame, authors: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(works, editions, authors in use)."""
    editions = settle(with_work_ids(resolve_authors(books, authors, links), authors))
    works = settle(with_catalogue(with_series(aggregate_works(editions, authors))))
    used = works.select(F.explode("author_ids").alias("author_id")).distinct()
    return works, editions.select(*EDITION_COLUMNS), authors.join(used, "author_id", "left_semi")
