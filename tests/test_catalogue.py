"""The catalogue pipeline from raw files to works, and its parts, on a small set of books that drives every branch."""

import gzip
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stemma import rules as R
from stemma.operators import authors as A
from stemma.operators import categories as C
from stemma.operators import quality, works
from stemma.operators import relational as rel
from stemma.plans import pipeline
from stemma.sources import raw

LONG = "একটি গ্রামের মানুষের জীবন নিয়ে লেখা এই উপন্যাসে সুখ দুঃখের কথা বলা হয়েছে খুব সহজ ভাষায় "
BLURB = LONG * 4


def book(i, title, summary=BLURB, category="1", author="10", **more):
    row = {"book_id": str(i), "book_title": title, "category_id": category, "book_summary": summary, "isbn": None, "book_pages": "120", "author_id": author, "publisher_id": "1", "average_rating": "4.5", "rating_count": "2", "review_count": "1", "book_url": f"https://shop/book/{i}/boi-{title and len(title)}x"}
    return row | more


BOOKS = [
    book(1, "পথের পাঁচালী", BLURB + " Show More", isbn="978-984-7760-49-0", book_url="https://shop/book/1/pother-pachali", average_rating="4", rating_count="3"),
    book(1, "পথের পাঁচালী", "ছোট Show More"),
    book(2, "পথের  পাঁচালী (সাদা)", "সংক্ষিপ্ত কথা", isbn="8170661838", book_url="https://shop/book/2/pather-panchali", average_rating="5", rating_count="1"),
    book(3, "মাসুদ রানা", book_url="https://shop/book/3/masud-rana-dhongso-pahar"),
    book(4, "মাসুদ রানা", book_url="https://shop/book/4/masud-rana-dhongso-pahad"),
    book(5, "মাসুদ রানা", book_url="https://shop/book/5/masud-rana-kurukkhetro"),
    book(6, "নিশুতি", book_url="https://shop/book/6/nishuti-3"),
    book(7, "নিশুতি", book_url="https://shop/book/7/nishuti-4"),
    book(8, "Book"),
    book(9, "বইয়ের প্যাকেজ (রকমারি কালেকশন)"),
    book(10, "লেখকহীন", author=None),
    book(11, "লেখকহীন", author=None),
    book(12, "ইতিহাসের কথা", category="2"),
    book(13, "Salem Lot", "A short English text.", category="3", publisher_id="2", book_pages="0"),
    book(14, "অনুবাদ গল্প", category="4", book_pages="১২০", average_rating="6"),
    book(15, "কলকাতার গল্প", category="5", rating_count="0"),
    book(16, "ভারতের বই", isbn="9788170661832", book_pages="12d"),
    book(17, "ভারতীয় প্রকাশক", publisher_id="2", book_pages="-3"),
    book(18, None, None, rating_count=None),
    book(19, "কুইজ", "কেন? ১. চোরে চোরে? ২. নাগরা? ৩. আদায়? ৪. হাতি? ৫. বাঘ?", author="11"),
    book(20, "আরেক লেখকের", author="12", category="1"),
    book(21, "দুই লেখক", author=None),
]
CATEGORIES = {"1": "Novel", "2": "Islamic History", "3": "Foreign Language Books: Novel", "4": "Translated Books: Novels", "5": "West Bengal Books: Story", "6": "When 8-12: Fables", "7": "Amar Ekushe Boimela"}
AUTHORS = {"10": "মোঃ রফিক (নীল)", "11": "ড. এনামুল হক", "12": "সুনীল গঙ্গোপাধ্যায় (নীললোহিত)", "13": "প্রথমা প্রকাশন", "14": "এনামুল হক", "15": None}
LINKS = {"book_to_category": [("1", "1"), ("1", "6"), ("1", "7"), ("1", "1"), ("14", "1")], "book_to_author": [("1", "10"), ("20", "12"), ("21", "12"), ("21", "10"), ("19", "11"), ("12", "13")], "book_to_review": [("1", "1"), ("1", "2")]}


def person(qid, bn=None, en=None, alias_bn="", countries="", death=None):
    bound = {"person": f"http://x/{qid}", "bnLabel": bn, "enLabel": en, "bnAliases": alias_bn, "countries": countries, "deathDate": death}
    return {k: {"value": v} for k, v in bound.items() if v}


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalogue")
    tables = {
        "book": BOOKS,
        "author": [{"author_id": k, "author": v, "bio": "লেখক", "follower_count": "1"} for k, v in AUTHORS.items()],
        "category": [{"category_id": k, "category_name": v} for k, v in CATEGORIES.items()],
        "publisher": [{"publisher_id": "1", "publisher_name": "প্রকাশনী"}, {"publisher_id": "2", "publisher_name": "Ananda (India)"}],
    }
    for name, pairs in LINKS.items():
        tables[name] = [{"book_id": a, name.removeprefix("book_to_") + "_id": b} for a, b in pairs]
    (root / "raw").mkdir()
    for name, rows in tables.items():
        with gzip.open(root / "raw" / f"{name}.json.gz", "wt", encoding="utf-8") as f:
            json.dump(rows, f, ensure_ascii=False)
    people = [
        person("Q1", "সুনীল গঙ্গোপাধ্যায়", "Sunil Gangopadhyay", "নীললোহিত|সুনীল", "India|British Raj", "2012-10-23T00:00:00Z"),
        person("Q2", "এনামুল হক", countries="Bangladesh"),
        person("Q3", "রফিক"),
        person("Q4", "মোহাম্মদ রফিক", death="1940-01-01"),
    ]
    (root / "people.json").write_text(json.dumps({"results": {"bindings": people}}, ensure_ascii=False), encoding="utf-8")
    at = pipeline.Layout(str(root / "raw"), str(root / "out"), people=str(root / "people.json"), year=2026)
    pipeline.run(spark, at)
    return at


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_books(spark, layout):
    got = rows(layout.result(spark, "books"), "book_id")
    assert len(got) == 21 and got["1"]["dup_count"] == 2 and got["1"]["summary_clean"] == R.nfc(BLURB.strip())
    assert (got["1"]["isbn13"], got["2"]["isbn13"], got["2"]["isbn_origin"]) == ("9789847760490", "9788170661832", "india")
    assert (got["2"]["paper"], got["2"]["title_clean"]) == ("white", R.nfc("পথের পাঁচালী"))
    assert [got[i]["pages"] for i in ("13", "14", "16", "17")] == [None, 120.0, None, None]
    assert [got[i]["rating_avg"] for i in ("1", "14", "15", "18")] == [4.0, None, None, None]
    assert (got["13"]["summary_class"], got["18"]["summary_class"], got["18"]["title_clean"]) == ("english", "empty", None)
    assert got["9"]["is_bundle"] and not got["1"]["is_bundle"]


def test_category_map(spark):
    names = {"Story": ("map", "short_story_collection"), "Comics & Graphic Novels": ("map", "comics"), "Novel, Poem, Short Story & Drama Collection": ("map", None), "History and Tradition": ("exclude", None), "Historical Novel": ("map", "novel"), "Artificial Intelligence & Robotics": ("unknown", None), "Drama Criticism and Others": ("exclude", None), "HSC 1st Year: Islamic History": ("exclude", None), "Amar Ekushe Boimela": ("ignore", None), "Book": ("ignore", None), "Others": ("unknown", None)}
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", C.classify(F.col("n")).alias("c"))
    assert {r.n: (r.c.action, r.c.format) for r in df.collect()} == names
    hints = {"When 12-17: Novel": ("audience", "teen"), "Children and Teens: Horror": ("audience", "children"), "Translated Books: Novels": ("origin_hint", "translated"), "Foreign Language Books: Novel": ("language_hint", "en"), "Horror, Myth and Adventure: Translated & English": ("language_hint", None), "Bangla-English Poem": ("language_hint", None), "Detective, Intelligence and Secret Agency,": ("genre_hints", "detective|spy"), "Novel: Political and Liberation war": ("genre_hints", "liberation_war|social")}
    df = spark.createDataFrame([(n,) for n in hints], "n string").select("n", C.classify(F.col("n")).alias("c"))
    assert {r.n: (hints[r.n][0], r.c[hints[r.n][0]]) for r in df.collect()} == hints


def test_origin_cascade(spark):
    blank = {"language": "bn", "category_origin_hint": None, "publisher_india": False, "isbn_origin": None}
    cases = [({"language": "en", "publisher_india": True}, "language_en"), ({"category_origin_hint": "translated", "publisher_india": True}, "translation_category"), ({"publisher_india": True}, "publisher_india"), ({"category_origin_hint": "west_bengal"}, "west_bengal_category"), ({"isbn_origin": "india"}, "isbn_india"), ({"isbn_origin": "bangladesh"}, "isbn_bangladesh"), ({}, "default")]
    df = spark.createDataFrame([Row(i=i, **(blank | c)) for i, (c, _) in enumerate(cases)], "i int, language string, category_origin_hint string, publisher_india boolean, isbn_origin string")
    assert [r.o.origin_rule for r in df.select("i", C.origin().alias("o")).orderBy("i").collect()] == [want for _, want in cases]


def test_book_level_categories(spark, layout):
    got = rows(layout.result(spark, "books_s8"), "book_id")
    assert (got["1"]["n_categories"], got["1"]["category_actions"], got["1"]["audience"], got["1"]["format"]) == (3, "ignore|map", "children", "novel")
    assert got["1"]["format_conflict"] and got["1"]["excluded_reason"] == "promotion"
    assert (got["12"]["is_fiction"], got["12"]["excluded_reason"]) == (False, "nonfiction")
    assert [got[i]["origin_rule"] for i in ("13", "14", "15", "16", "17", "1", "3")] == ["language_en", "translation_category", "west_bengal_category", "isbn_india", "publisher_india", "isbn_bangladesh", "default"]


def test_authors(spark, layout):
    got = rows(layout.result(spark, "authors"), "rokomari_author_id")
    assert {k: v["match_method"] for k, v in got.items()} == {"10": "exact_key", "11": "ambiguous_rokomari", "12": "exact_key", "13": "not_person", "14": "not_fiction_author", "15": "no_key"}
    assert (got["12"]["author_id"], got["12"]["origin_hint"], got["12"]["public_domain_bd"]) == ("au_Q1", "west_bengal", False)
    assert (got["10"]["author_id"], got["10"]["public_domain_bd"], got["11"]["author_id"]) == ("au_Q4", True, "au_rk11")


def test_authority_index_and_countries(spark, layout):
    index = rows(A.authority_index(raw.people(spark, layout.people)), "name_key")
    assert R.nfc("নীললোহিত") in index and "সুনীল" not in index  # a short form of the label is no key
    cases = {"Pakistan|Bangladesh": "bangladesh", "Dominion of India|British Raj": "west_bengal", "British Raj": None, "Turkey": None}
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", A.country_origin(F.col("c")).alias("o"))
    assert {r.c: r.o for r in df.collect()} == cases


def test_works(spark, layout):
    editions = rows(layout.result(spark, "editions"), "book_id")
    work = {i: e["work_id"] for i, e in editions.items()}
    assert work["1"] == work["2"] and work["3"] == work["4"] != work["5"]
    assert len({work[i] for i in ("6", "7", "8", "9", "10", "11")}) == 6
    got = rows(layout.result(spark, "works"), "work_id")
    merged = got[work["1"]]
    assert (merged["n_editions"], merged["edition_ids"], merged["rating_avg"], merged["rating_count"]) == (2, ["1", "2"], 17 / 4, 4)
    assert (merged["summary_source_book_id"], merged["isbn13"]) == ("1", ["9788170661832", "9789847760490"])
    assert got[work["6"]]["series_group_id"] == got[work["7"]]["series_group_id"] is not None and got[work["9"]]["series_group_id"] is None
    assert got[work["20"]]["origin_rule"] == "author_wikidata" and got[work["20"]]["origin"] == "west_bengal"
    assert got[work["21"]]["author_ids"] == ["au_Q1", "au_Q4"] and got[work["21"]]["main_author_id"] == "au_Q1"
    reasons = {i: got[work[i]]["exclude_reasons"] for i in work}
    assert reasons["1"] == [] and reasons["12"] == ["not_fiction"] and reasons["9"] == ["store_bundle"]
    assert reasons["13"] == ["english_language", "no_usable_summary"] and reasons["19"] == ["no_usable_summary", "list_summary"]
    assert sorted(got) == [f"bk_{i:06d}" for i in range(1, len(got) + 1)]
    assert layout.result(spark, "authors_in_use").count() == 4


def test_all_checks_pass_and_each_can_fail(spark, layout):
    found = pipeline.validate(spark, layout, expected_books=21)
    assert len([f for f in found if f.kind == "hard"]) == 40 and len([f for f in found if f.kind == "soft"]) == 5
    assert [f.name for f in found if not f.passed] == [] and quality.exit_code(found) == 0
    assert "40 of 40 hard checks passed" in quality.report("Checks", found)
    books = layout.result(spark, "books")
    broken = {
        "no button label is left": {"summary_clean": F.lit("x Show More")},
        "no vowel signs in reverse are left": {"summary_clean": F.lit("কাে")},
        "no joiners are left": {"summary_clean": F.lit("ক‌ক")},
        "no summary starts with a combining mark": {"summary_clean": F.lit("ািক")},
        "every isbn13 passes its checksum": {"isbn13": F.lit("9789849156438")},
        "rating_avg is null or from 1 to 5": {"rating_avg": F.lit(7.0)},
        "words of the title come from the raw title": {"title_clean": F.lit("অন্য")},
        "no title is emptied": {"title_clean": F.lit(None).cast("string")},
        "isbn_valid exactly when isbn13 is set": {"isbn_valid": ~F.col("isbn_valid")},
        "usable summaries meet the length rule": {"summary_usable": F.lit(True)},
    }
    for name, change in broken.items():
        bad = {f.name: f for f in quality.book_checks(layout.table(spark, "book"), books.withColumns(change))}
        assert not bad[name].passed, name
    twice = {f.name: f.passed for f in quality.book_checks(layout.table(spark, "book"), books.unionByName(books))}
    assert not twice["book_id is unique"] and not twice["row count equals different raw ids"]


def test_profile(spark, layout):
    text = pipeline.report(spark, layout)
    assert "## 1. Rows and ids" in text and "| rows | 22 |" in text and "| ids | 21 |" in text and "## 9. Candidate catalogue" in text


def test_reports(spark, layout):
    made = pipeline.write_reports(spark, layout)
    assert set(made) == {"cleaning", "placing", "linking", "catalogue", "checks", "profile"}
    assert "| raw_rows | 22 |" in made["cleaning"] and "| fiction | " in made["placing"] and "| exact_key | 2 | " in made["linking"]
    assert "| not_fiction | 1 |" in made["catalogue"] and "40 of 40" in made["checks"]


def test_garbled(spark):
    common = spark.createDataFrame([(R.nfc(w),) for w in ("গেছেন", "মানুষের", "বাংলাদেশ", "জাতির", "টিম")], "word string")
    texts = spark.createDataFrame([(1, R.nfc("লেখক মারা গছেনে রখে গছেনে বাংলাদশে জাতরি")), (2, R.nfc("টমি আর জনি নদীর ধারে খেলতে গেল"))], "k int, t string")
    got = rows(works.displaced_words(texts, "k", "t", common), "k")
    assert (got[1]["n_bad"], got[1]["n_bad_different"]) == (4, 3) and got[2]["n_bad"] == 0


def test_similar_signatures():
    labels = works.similar_label(["", "dhongso-pahar", "dhongso-pahad", "kurukkhetro"])
    assert labels[""] == "" and labels["dhongso-pahar"] == labels["dhongso-pahad"] != labels["kurukkhetro"]


def test_dense_ids_over_many_tasks(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("k")).repartition(7).unionByName(spark.createDataFrame([("k1",), (None,)], "k string"))
    got = {r.k: r.n for r in rel.dense_ids(df, "k", "n", "x_%04d").collect()}
    assert got == {k: f"x_{i:04d}" for i, k in enumerate(sorted(f"k{i}" for i in range(1000)), 1)}
