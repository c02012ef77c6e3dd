"""Authors, steps 9 and 10: parsed names, and links to an authority file under strict evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.functions import bangla, names
from stemma.functions import strings as S
from stemma.operators import relational as rel

#: Years after death for which works are protected.
TERM = 60
FACTS = ("wd_label_bn", "wd_label_en", "wd_aliases_bn", "wd_aliases_en", "birth_year", "death_year", "wd_countries")


def authority_index(people: DataFrame) -> DataFrame:
    """(name_key, qids): everyone whom a label or alias can mean.

    An alias whose words are all in its own language's label is only a short form, which other people share; it is left out.
    """
    sides = [
        people.select("qid", F.col(f"wd_label_{lang}").alias("label"), F.coalesce(f"wd_aliases_{lang}", F.array().cast("array<string>")).alias("aliases"))
        for lang in ("bn", "en")
    ]
    rows = sides[0].unionByName(sides[1]).withColumn("label_key", names.name_key(F.col("label")))
    labels = rows.select("qid", F.col("label_key").alias("name_key"))
    alias = rows.select("qid", "label_key", F.explode("aliases").alias("alias")).withColumn("name_key", names.name_key(F.col("alias")))
    words = lambda c: S.word_list(F.coalesce(c, F.lit("")))
    own = alias.where(F.size(F.array_except(words(F.col("name_key")), words(F.col("label_key")))) > 0).select("qid", "name_key")
    return labels.unionByName(own).where(F.col("name_key").isNotNull()).groupBy("name_key").agg(rel.sorted_set("qid").alias("qids"))


def country_origin(countries: Column) -> Column:
    """Literary origin from citizenships joined by bars; those of a time before today's border say nothing."""
    parts = F.split(countries, "\\|")
    among = lambda names: F.arrays_overlap(parts, F.array(*map(F.lit, names)))
    return F.when(among(R.BANGLADESH_COUNTRIES), "bangladesh").when(among(R.INDIA_COUNTRIES), "west_bengal")


def match() -> Column:
    """struct(qid, method, candidates): the first of seven findings, from type, key, fiction flag, QIDs and key count."""
    n = F.size(F.coalesce("qids", F.array().cast("array<string>")))
    found = lambda method, count, qid=None: F.struct((F.lit(None).cast("string") if qid is None else qid).alias("qid"), F.lit(method).alias("method"), count.cast("int").alias("candidates"))
    zero, one = F.lit(0), F.lit(1)
    return (
        F.when(F.col("author_type") != "person", found("not_person", zero))
        .when(F.col("name_key").isNull(), found("no_key", zero))
        .when(~F.col("has_fiction"), found("not_fiction_author", zero))
        .when(n == 0, found("no_match", zero))
        .when(n > 1, found("ambiguous_wikidata", n))
        .when(F.col("same_key_count") > 1, found("ambiguous_rokomari", one))
        .otherwise(found("exact_key", one, F.element_at("qids", 1)))
    )


def link_authors(raw: DataFrame, links: DataFrame, books: DataFrame, people: DataFrame, year: int, source: str = "") -> DataFrame:
    """Raw authors with parsed names, linked people and our ids.

    ``year`` is the year against which copyright terms are reckoned. Only authors of fiction are linked. Ids are merged
    only by a shared person, never by the name alone.
    """
    pairs = links.select("book_id", "author_id").distinct()
    counts = pairs.groupBy("author_id").agg(F.count(F.lit(1)).alias("book_count"))
    of_fiction = pairs.join(books.where("is_fiction").select("book_id"), "book_id", "left_semi").select("author_id")
    order = ["ord"] if "ord" in raw.columns else []
    rows = raw.select("author_id", "author", "bio", "follower_count", *order).join(counts, "author_id", "left").fillna({"book_count": 0})
    rows = rel.is_member(rows, of_fiction, "author_id", "has_fiction")
    rows = rows.withColumns({"_name": names.parse_author(F.col("author")), "bio_bn": bangla.clean_text(F.col("bio"))}).select("*", "_name.*")
    rows = rel.with_group_size(rows, ["name_key"], "same_key_count")
    rows = rows.join(authority_index(people), "name_key", "left").withColumn("_match", match())
    rows = rows.withColumns({"wikidata_qid": F.col("_match.qid"), "match_method": F.col("_match.method"), "candidates": F.col("_match.candidates")})
    facts = rel.top1(people.select("qid", *FACTS), ["qid"], [F.col(c).asc_nulls_last() for c in FACTS]).withColumnRenamed("qid", "wikidata_qid")
    rows = rows.join(facts, "wikidata_qid", "left")
    made = rows.withColumns(
        {
            "origin_hint": country_origin(F.col("wd_countries")),
            "public_domain_bd": F.coalesce(F.col("death_year") + TERM < year, F.lit(False)),
            "wikidata_source": F.lit(source),
            "_id": F.when(F.col("wikidata_qid").isNotNull(), F.concat(F.lit("au_"), "wikidata_qid")).otherwise(F.concat(F.lit("au_rk"), "author_id")),
        }
    )
    return made.select(
        F.col("author_id").alias("rokomari_author_id"),
        F.col("author").alias("name_raw"),
        "follower_count",
        "book_count",
        *("name_display", "name_key", "honorifics", "rank_titles", "descriptors", "aliases", "author_type", "bio_bn", "same_key_count", "has_fiction"),
        *("wikidata_qid", "match_method", "candidates", *FACTS, "origin_hint", "public_domain_bd"),
        F.col("_id").alias("author_id"),
        "wikidata_source",
        *order,
    )
