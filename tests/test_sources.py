"""Readers, sinks, manifest, paged listings and streams."""

import gzip
import hashlib
import json

from pyspark.sql import functions as F

from stemma.operators import relational as rel
from stemma.sources import collect, listing, manifest, raw
from stemma.streaming import resume


def test_json_array_keeps_the_order_and_declared_types(spark, tmp_path):
    rows = [{"book_id": i, "book_title": f"t{i}", "extra": 1} for i in (3, 1, 2)]
    with gzip.open(tmp_path / "book.json.gz", "wt") as f:
        json.dump(rows, f)
    got = raw.json_array(spark, str(tmp_path / "book.json.gz"), "book", spread=3)
    assert dict(got.dtypes)["book_id"] == "string" and "extra" not in got.columns
    assert [r.book_id for r in got.orderBy("ord").collect()] == ["3", "1", "2"]


def test_log_and_what_is_left_to_fetch(spark, tmp_path):
    lines = [{"page_id": "1", "note": "no_book"}, {"page_id": "2", "status": 200}, {"page_id": "1", "note": "no_book"}]
    (tmp_path / "log.jsonl").write_text("\n".join(map(json.dumps, lines)))
    empty = raw.pages_without_book(raw.json_lines(spark, str(tmp_path / "log.jsonl")))
    assert [r.page_id for r in empty.collect()] == ["1"]
    wanted = spark.createDataFrame([(str(i), f"u{i}") for i in (1, 2, 3, 4, 4)], "page_id string, url string")
    done = spark.createDataFrame([("2",)], "page_id string")
    assert [r.page_id for r in raw.still_to_fetch(wanted, done, empty).orderBy("page_id").collect()] == ["3", "4"]
    assert raw.still_to_fetch(wanted, done, empty, limit=1).count() == 1


def test_sitemap(spark, tmp_path):
    (tmp_path / "map.xml").write_text("<urlset><url><loc> https://x.com/books/12/a </loc></url><url><loc>https://x.com/about</loc></url></urlset>")
    assert [tuple(r) for r in raw.sitemap_urls(spark, str(tmp_path / "map.xml")).collect()] == [("12", "https://x.com/books/12/a")]


def test_people_and_their_facts(spark, tmp_path):
    bound = {"person": {"value": "http://e/Q7"}, "bnLabel": {"value": "ক"}, "bnAliases": {"value": "খ||গ"}, "birthDate": {"value": "1899-05-24T00:00:00Z"}, "deathDate": {"value": "t123"}}
    (tmp_path / "p.json").write_text(json.dumps({"results": {"bindings": [bound]}}))
    (got,) = raw.people(spark, str(tmp_path / "p.json")).collect()
    assert (got.qid, got.wd_label_bn, got.wd_label_en, got.wd_aliases_bn, got.birth_year, got.death_year) == ("Q7", "ক", None, ["খ", "গ"], 1899, None)
    facts = [("Q1", "label", "ক", "bn"), ("Q1", "alias", "y", "en"), ("Q1", "alias", "x", "en"), ("Q1", "occupation", "writer", None), ("Q1", "country", "India", None), ("Q2", "label", "z", "en")]
    (row,) = raw.facts_of_people(spark.createDataFrame(facts, "person string, property string, value string, lang string")).collect()
    assert (row.person, row.bnLabel, row.enAliases, row.countries, row.deathDate) == ("Q1", "ক", "x|y", "India", None)


def test_category_map_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "Novel", 3, "map", "fiction", "novel", None, None, None, None, False, True)], "category_id string, category_name string, books bigint, action string, rule string, format string, genre_hints string, audience string, origin_hint string, language_hint string, religious boolean, is_collection boolean")
    raw.write_csv(df, str(tmp_path / "map"))
    assert raw.category_map(spark, str(tmp_path / "map")).collect() == df.collect()


def test_manifest(spark, tmp_path):
    (tmp_path / "shop" / "pages").mkdir(parents=True)
    (tmp_path / "shop" / "a.json").write_bytes(b"abc")
    for i in range(3):
        (tmp_path / "shop" / "pages" / f"{i}.html").write_bytes(b"x" * i)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "b.csv").write_bytes(b"b")
    found = manifest.files(spark, str(tmp_path))
    sources = spark.createDataFrame([("shop", "http://shop", "CC")], "folder string, source_url string, license string")
    old = spark.createDataFrame([("shop/a.json", "0" * 64, "http://old", None, "2020-01-01")], "path string, sha256 string, source_url string, license string, fetched_at string")
    got = {r.path: r for r in manifest.build(found, old, sources, "2026-01-02").collect()}
    assert set(got) == {"shop/a.json", "shop/pages/", "other/b.csv"}
    a, pages, b = got["shop/a.json"], got["shop/pages/"], got["other/b.csv"]
    assert (a.sha256, a.bytes, a.source_url, a.license, a.fetched_at, a.changed) == (hashlib.sha256(b"abc").hexdigest(), 3, "http://old", "CC", "2020-01-01", True)
    assert (pages.files, pages.bytes, pages.changed) == (3, 3, False) and (b.source_url, b.fetched_at) == ("UNKNOWN", "2026-01-02")
    assert {r.path for r in manifest.build(found, None, sources, "d").collect()} == set(got)


def fetched(category, page):
    return (f'{{"bookcode" : "{category}{page}"}}', 2) if category != "none" else ("", 1)


def pages_of(keys):
    assert len(keys) <= 2
    return [(k, k.upper()) for k in keys]


def test_batch_source(spark):
    spark.dataSource.register(listing.BatchSource)
    got = spark.read.format("stemma_batches").option("keys", "a|b|c").option("size", "2").option("fetcher", "tests.test_sources:pages_of").load()
    assert got.rdd.getNumPartitions() == 2 and sorted(map(tuple, got.collect())) == [("a", "A"), ("b", "B"), ("c", "C")]


def test_listing_source(spark):
    spark.dataSource.register(listing.ListingSource)
    bodies = spark.read.format("stemma_listing").option("categories", "a,b,none").option("fetcher", "tests.test_sources:fetched").load()
    assert sorted((r.category, r.page) for r in bodies.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert sorted(r.page_id for r in raw.listing_codes(bodies).collect()) == ["a1", "a2", "b1", "b2"]


def test_page_predicate_and_sinks(spark, tmp_path):
    pages = spark.createDataFrame([('{"bookdetails": 1}', "s"), ("nothing", "s")], "html string, site string")
    assert [r.b for r in pages.select(raw.has_book(F.col("html")).alias("b")).collect()] == [True, False]
    whole = spark.createDataFrame([("1", "a\r\nb\n\nc", "s"), ("2", "é", "t")], "page_id string, html string, site string")
    raw.write_pages(whole, str(tmp_path / "pages"))
    assert sorted((r.page_id, r.html, r.site) for r in raw.read_pages(spark, str(tmp_path / "pages")).collect()) == sorted(map(tuple, whole.collect()))
    raw.append_log(pages, str(tmp_path / "log"))
    raw.append_log(pages, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    raw.write_text(spark, "# Title\n\nbody\n", str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*")
    assert part.read_text() == "# Title\n\nbody\n"
    raw.write_table(pages, str(tmp_path / "table"), ["site"])
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
    assert raw.latest_snapshot(["d/2026-01-02/x", "d/2026-03-01/x", "d/2025-12-31/x"]) == "d/2026-03-01/x"


def test_streams_add_each_key_once(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    entry = lambda i, at: json.dumps({"page_id": str(i), "fetched_at": at, "status": 200, "bytes": 10})
    (folder / "1.json").write_text(entry(1, "2026-01-01T00:00:00") + "\n" + entry(1, "2026-01-01T00:01:00") + "\n" + entry(2, "2026-01-01T00:02:00"))
    label = lambda df: df.withColumn("label", F.lit("x"))
    run = lambda: resume.append_new(resume.log_stream(spark, str(folder)), target, str(tmp_path / "cp"), "page_id", label).awaitTermination()
    run()
    (folder / "2.json").write_text(entry(2, "2026-01-02T00:00:00") + "\n" + entry(3, "2026-01-02T00:00:00"))
    run()
    assert sorted(r.page_id for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]
    counts = resume.status_counts(resume.log_stream(spark, str(folder)))
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(n) AS n, sum(bytes) AS b FROM counts").first().asDict() == {"n": 5, "b": 50}
    first = resume.first_entries(resume.log_stream(spark, str(folder)))
    resume.to_json_log(first.select("page_id"), str(tmp_path / "first"), str(tmp_path / "cp2")).awaitTermination()
    assert sorted(r.page_id for r in spark.read.schema("page_id string").json(str(tmp_path / "first")).collect()) == ["1", "2", "3"]


def test_relational_helpers(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), (None, 3, 7.0), (None, 4, 1.0)], "k string, o int, v double")
    assert {r.o: r.n for r in rel.with_group_size(df, ["k"], "n").collect()} == {1: 2, 2: 2, 3: None, 4: None}
    assert {r.o: r.d for r in rel.with_repeated(df, ["k"], "d").collect()} == dict.fromkeys((1, 2, 3, 4), True)
    assert {r.o: r.d for r in rel.with_repeated(df, ["k", "v"], "d").collect()} == dict.fromkeys((1, 2, 3, 4), False)
    dim = spark.createDataFrame([(2, "a", "y", "b"), (1, "a", "z", None), (3, None, "x", "c")], "ord int, k string, p string, q string")
    assert [(r.k, r.p, r.q) for r in rel.lookup(df.where("o < 2"), dim, "k", ["p", "q"]).collect()] == [("a", "z", None)]
    assert {r.k: r.f for r in df.groupBy("k").agg(rel.first_value("v", "o").alias("f")).collect()} == {"a": 5.0, None: 7.0}
    assert rel.same_set(df.select("k"), df.select("k")) and not rel.same_set(df.select("k"), df.select("k").where("k = 'a'"))
    assert rel.exact_sample(df, 3, "o").count() == 3 and rel.exact_sample(df, 9, "o").count() == 4


def test_sitemap_index(spark, tmp_path):
    names = ["https://x/books-1.xml", "https://x/authors.xml", " https://x/books-2.xml "]
    (tmp_path / "i.xml").write_text("<sitemapindex>" + "".join(f"<sitemap><loc>{n}</loc></sitemap>" for n in names) + "</sitemapindex>")
    assert sorted(r.url for r in raw.sitemaps(spark, str(tmp_path / "i.xml")).collect()) == ["https://x/books-1.xml", "https://x/books-2.xml"]


def test_crawl_resumes_and_stops(tmp_path):
    asked, slept = [], []

    def fetch(url):
        asked.append(url)
        if "gone" in url:
            return 404, b""
        if "no" in url:
            return 200, b"nothing"
        return 200, b"a book\r\n"

    todo = [("1", "u/1"), ("2", "u/no"), ("3", "u/gone"), ("4", "u/4")]
    run = lambda fetch, todo, **more: collect.crawl(todo, fetch, str(tmp_path), lambda h: "book" in h, sleep=slept.append, **more)
    assert run(fetch, todo, limit=1) == {"new": 1, "blocked": 0, "errors": 0} and asked == ["u/1"]
    assert run(fetch, todo)["new"] == 1 and asked == ["u/1", "u/no", "u/gone", "u/4"]
    assert run(fetch, todo)["new"] == 0 and asked[4:] == ["u/gone"]  # neither stored nor empty
    assert gzip.decompress((tmp_path / "pages" / "1.html.gz").read_bytes()) == b"a book\r\n"
    notes = [json.loads(line).get("note") for line in (tmp_path / "fetch_log.jsonl").read_text().splitlines()]
    assert notes == [None, "no_book", "http_error", None, "http_error"]
    many = [(f"b{i}", f"u/b{i}") for i in range(50)]
    slept.clear()
    assert run(lambda _: (429, b""), many)["blocked"] == 5 and slept == [30.0] * 4

    def fails(_):
        raise OSError("no answer")

    assert run(fails, many)["errors"] == 20


def test_listing_cache_and_wiki(tmp_path):
    calls = []

    def fetch(category, page):
        calls.append((category, page))
        return f"{category}{page}", 2

    for _ in range(2):
        get = collect.cached(fetch, str(tmp_path / "listings"))
        assert get("nov", 1) == ("nov1", 2)
    assert calls == [("nov", 1)]
    (tmp_path / "titles.json").write_text(json.dumps([f"t{i}" for i in range(120)]))
    titles = collect.read_titles(str(tmp_path / "titles.json"))
    asked = []

    def ask(params):
        asked.append(params["titles"].split("|"))
        return json.dumps({"query": {"pages": [{"title": t} for t in asked[-1]]}})

    assert collect.collect_wiki(titles, ask, str(tmp_path / "pages.jsonl"), sleep=lambda _: None) == 120
    assert [len(a) for a in asked] == [50, 50, 20]
    assert [json.loads(line)["title"] for line in (tmp_path / "pages.jsonl").read_text().splitlines()] == titles
