import html as h
import random
import re

import pandas as pd
import pytest

from stemma.llm import html_text, urls

# ---------- urls ----------

CASES = [
    ("https://a.com/en/5", "a.com", "/en/5", "com/en/", "block"),
    ("https://x.example.com/en/712?q", "x.example.com", "/en/712", "example.com/en/7", "allow"),
    ("HTTP://WWW.Example.COM/en/6#t", "www.example.com", "/en/6", "com/en/", "block"),
    ("http://b.net/de/8", "b.net", "/de/8", "net/de/", "allow"),
    ("http://example.net/de/7", "example.net", "/de/7", "net/de/", "allow"),
    ("http://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"),
    ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
    ("http://c.org/es/", "c.org", "/es/", "org/es/", "block"),
    ("http://c.org/es", "c.org", "/es", None, "allow"),
    ("http://c.com?/en/", "c.com", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://", "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("https://cheappillsonline.org/fr/1", "cheappillsonline.org", "/fr/1", None, "block"),
    ("https://best-casino.org/fr/poker", "best-casino.org", "/fr/poker", None, "block"),
    ("https://city-library.org/fr/guide", "city-library.org", "/fr/guide", None, "allow"),
]


def test_judge(spark):
    rows = [(i, c[0], "x") for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = urls.judge(df).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [c[1:] for c in CASES]
    assert urls.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize(("run", "words"), [("cheappillsnow", ("cheap", "pills", "now")), ("dailynews", ("daily", "news")), ("qzxv", ("qzxv",)), ("casinowin", ("casino", "win")), ("a", ("a",)), ("qqqcasino", ("qqq", "casino"))])
def test_segment(run, words):
    assert urls.Scorer(urls.seed_model()).segment(run) == words


def test_segment_is_the_best_split():
    """Against all splits of short runs."""
    scorer = urls.Scorer(urls.seed_model())
    lexicon = scorer.model.lexicon
    floor = min(lexicon.values())

    def cost(parts):
        total, unknown = 0.0, False
        for p in parts:
            if p in lexicon and len(p) > 1:
                total, unknown = total + lexicon[p], False
            else:
                if unknown:
                    return -1e9  # neighbours that no word covers are one stretch
                total, unknown = total + floor - 2.0 - 2.0 * len(p), True
        return total

    def splits(run):
        for mask in range(1 << (len(run) - 1)):
            cut = [0, *(i + 1 for i in range(len(run) - 1) if mask >> i & 1), len(run)]
            yield tuple(run[a:b] for a, b in zip(cut, cut[1:], strict=False))

    draw = random.Random(1)
    vocabulary = [w for w in lexicon if 2 < len(w) < 6]
    for _ in range(12):
        run = (draw.choice(vocabulary) + draw.choice(["", "zq", "x"]) + draw.choice(vocabulary))[:11]
        assert cost(scorer.segment(run)) == pytest.approx(max(map(cost, splits(run))))


def made_urls(n, draw):
    """(url, whether it is bad): hosts of words written together, most of them no seeds; the same plumbing for both kinds."""
    bad_words = "casino poker pills viagra slots replica handbag outlet naked celeb essay cheap payday loan".split()
    good_words = "library museum school recipes garden weather city news rowing chess pottery choir harbour orchard".split()
    for i in range(n):
        bad = draw.random() < 0.25
        name = draw.choice(["", "-"]).join(draw.sample(bad_words if bad else good_words, 3))
        yield f"http://{draw.choice(['www', 'm', 'blog'])}.{name}.{draw.choice(['org', 'info'])}/{draw.choice(['en', 'fr'])}/{draw.choice(['a', 'b'])}{i}.html", bad


def test_learned_from_the_urls(spark):
    """Precision and recall on hosts that share no name with those learned from; words that are no seeds are learned."""
    draw = random.Random(21)
    rows = list(made_urls(1500, draw))
    known, fresh = rows[:1000], rows[1000:]
    names = {u.split("/")[2].split(".")[1] for u, _ in known}
    fresh = [(u, b) for u, b in fresh if u.split("/")[2].split(".")[1] not in names]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(known)], "page_id bigint, url string")
    model = urls.learn(df.select(urls.host_of("url").alias("host"), urls.path_of("url").alias("path")).distinct())
    scorer, seeds = urls.Scorer(model), urls.Scorer(urls.seed_model())

    def rates(scorer):
        said = [(scorer.score(u.split("/")[2], u.split("/", 3)[3]) > 0, b) for u, b in fresh]
        hits = sum(s and b for s, b in said)
        return hits / max(1, sum(s for s, _ in said)), hits / sum(b for _, b in said)

    precision, recall = rates(scorer)
    assert precision >= 0.95 and recall >= 0.95 and recall > rates(seeds)[1]
    assert scorer.segment("nakedcelebessay") == ("naked", "celeb", "essay")
    assert all(abs(model.odds[w]) < 1 for w in ("www", "blog", "html"))
    assert model.odds["handbag"] > 1 > -1 > model.odds["pottery"]


def test_pages_of_one_host_count_once(spark):
    one = [(f"big{i % 3}.org", f"/library/{i}") for i in range(300)]
    df = spark.createDataFrame([*one, ("a.library.org", "/"), ("b.library.org", "/")], "host string, path string")
    assert urls._host_counts(df)["library"] == 5  # hosts


# ---------- html ----------


def page(title, paragraphs, menu="Home", extra="", head=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f'<!DOCTYPE html><html><head><title>{title}</title>{head}<style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">{menu}</a></li></ul></nav><div class="ad">Buy {title}</div><article><h1>{title}</h1>{body}{extra}</article><footer>&copy; x</footer></body></html>'


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        (page("A &amp; B", ["one  two\n three", "<b>bold</b> and <i>more</i>"]), "A & B\none two three\nbold and more"),
        ("<article><p>a<p>b<br>c<ul><li>d<li>e</ul>", "a\nb\nc\nd\ne"),
        ("<article><p>x &lt;y&gt; &eacute; &#233; &nbsp; z</p><script>no</script><!-- no --><aside>no</aside><form>no</form></article>", "x <y> é é z"),
        ('<main><header><h1>Head</h1></header><p>in</p><div class="comments"><p>reader</p></div><div id="cookie-notice">n</div></main>', "Head\nin"),
        ("<div><div class='sidebar'>s</div><div><p>first long paragraph here</p><p>second long paragraph here</p></div></div>", "first long paragraph here\nsecond long paragraph here"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><p hidden>no</p>", "1\n2\n3"),
        ("<article><p>cut in the mid", "cut in the mid"),
    ],
)
def test_extract(html, text):
    assert html_text.extract(html, None) == text


def test_template_of_same_host_pages(spark):
    rows = [(i, f"https://host.example.com/{i}", page(f"T{i}", [f"text {i} words", f"more {i}"], extra='<div class="x">Read our terms</div>'), "z") for i in range(12)]
    rows += [(100, None, page("N", ["n"]), "z"), (101, "https://other.org/1", None, "z"), (102, "https://single.org/1", page("S", ["s"], extra="<div>kept</div>"), "z"), (102, "https://single.org/1", page("S", ["s"], extra="<div>kept</div>"), "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, template string").repartition(4)
    got = html_text.main_text(df).collect()
    assert len(got) == 16
    by_id = {r.page_id: r for r in got}
    assert by_id[3].text == "T3\ntext 3 words\nmore 3" and by_id[3].n_chars == len(by_id[3].text)  # what never varies is template
    assert by_id[100].text == "N\nn" and by_id[101].text == "" and by_id[102].text == "S\ns\nkept"
    assert html_text.main_text(df.limit(0)).count() == 0


def test_equal_pages_are_no_template(spark):
    rows = [(i, "https://copies.org/1", page("Same", ["every page says this"])) for i in range(30)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).select("text").distinct().collect()
    assert [r.text for r in got] == ["Same\nevery page says this"]


def test_copies_of_a_page_beside_others_keep_their_text(spark):
    """Equal articles on any number of pages, whatever the menu says; other pages of the host vary."""
    said = "<ul><li>only here</li></ul><blockquote>a saying</blockquote>"
    rows = [(i, f"https://copies.org/{i}", page("Same", ["every copy says this"], extra=said)) for i in range(12)]
    rows += [(20 + i, f"https://copies.org/{i}", f"<nav>menu {i}</nav>" + page("Same", ["every copy says this"], extra=said)) for i in range(12)]
    rows += [(50 + i, f"https://copies.org/x{i}", page(f"T{i}", [f"text {i}"])) for i in range(12)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)).where("page_id < 50")
    assert [r.text for r in got.select("text").distinct().collect()] == ["Same\nevery copy says this\nonly here\na saying"]


def test_tree_matching():
    """Size of the largest match against all order-preserving matches."""

    def leaf(label, *kids):
        return [label, False, 1, 0, 0, list(kids)]

    def brute(a, b):
        if a[0] != b[0]:
            return 0

        def best(x, y):
            if not x or not y:
                return 0
            return max(best(x[1:], y), best(x, y[1:]), brute(x[0], y[0]) + best(x[1:], y[1:]) if x[0][0] == y[0][0] else 0)

        return 1 + best(a[5], b[5])

    draw = random.Random(4)

    def tree(depth):
        return leaf(draw.choice("ab"), *(tree(depth - 1) for _ in range(draw.randint(0, 3) if depth else 0)))

    for _ in range(60):
        a, b = tree(2), tree(2)
        assert html_text._match(a, b) == brute(a, b)
    both = html_text.merge(leaf("r", leaf("a"), leaf("b")), leaf("r", leaf("b"), leaf("c")))
    assert [k[0] for k in both[5]] == ["a", "b", "c"] and [k[2] for k in both[5]] == [1, 2, 1]


def plainly(p):
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", p, re.S)[1]
    blocks = [" ".join(h.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", inner)]
    return "\n".join(b for b in blocks if b)


def unnamed(p):
    """Without the article's tag and without classes."""
    return re.sub(r' class="[^"]*"', "", re.sub("<(/?)(?:article|main)>", r"<\1div>", p))


def faceless(p):
    """Also without the tags of menu, footer, heading and links; every container holds paragraphs."""
    p = re.sub("<(/?)(?:nav|footer)>", r"<\1div>", unnamed(p))
    p = re.sub("<div>([^<]*)</div>", r"<div><p>\1</p></div>", re.sub("<(/?)h1>", r"<\1p>", p))
    return re.sub("</?a\\b[^>]*>", "", p)


@pytest.mark.parametrize("change", [lambda p: p, unnamed, faceless])
def test_driver_pages_against_a_plain_parser(spark, change):
    """The template finds the article whether or not tags and classes name it."""
    df = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(int(i), u, change(p)) for i, u, p in zip(df.page_id, df.url.str.replace("://[^/]*", "://one.org", regex=True), df.html, strict=True)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == {int(i): plainly(p) for i, p in zip(df.page_id, df.html, strict=True)}


def test_the_template_decides(spark):
    """Withheld, it changes the text: short articles beside long adverts are found only by what other pages of the host say."""
    df = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    alone = [html_text.extract(faceless(p), None) == plainly(p) for p in df.html]
    assert not all(alone) and sum(alone) > len(alone) // 2
    boiler = [page(f"T{i}", [f"text {i} words", f"more {i}"], extra="<div>Follow us</div>") for i in range(3)]
    for n in (2, 3):
        rows = [(i, "https://h.org/", boiler[i]) for i in range(n)]
        got = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
        assert all(r.text == f"T{r.page_id}\ntext {r.page_id} words\nmore {r.page_id}" for r in got)
    assert html_text.extract(boiler[0], None).endswith("Follow us")


def test_depth_and_templates_are_bounded(spark):
    deep = "<div>" * 10_000 + "<p>at the bottom</p>" + "</div>" * 10_000
    open_tags = "<b>" * 10_000 + "<p>words" * 50
    rows = [(1, "http://deep.org/1", deep), (2, "http://deep.org/2", page("T", ["t"])), (3, "http://deep.org/3", open_tags), (4, "http://deep.org/4", "<ul>" + "<li><ul>" * 5_000 + "item")]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)).collect()}
    assert got == {1: "at the bottom", 2: "T\nt", 3: "\n".join(["words"] * 50), 4: "item"}

    def size(t):
        return 1 + sum(map(size, t[5]))

    tree = None
    for i in range(40):
        odd = "".join(f'<section class="s{chr(97 + i % 26)}{chr(97 + j)}"><p>{i} {j}</p></section>' for j in range(24))
        one = html_text._stored(html_text.skeleton([html_text.parse(page(f"T{i}", [f"p{i}"], extra=odd))]))
        tree = html_text.prune(html_text.merge(tree, one) if tree else one)
    assert size(tree) <= html_text.MAX_NODES and html_text.extract(page("A", ["b"]), html_text.json.dumps(tree)) == "A\nb"
