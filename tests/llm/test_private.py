import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stemma.llm import pii, secrets_scan
from tests.llm.tables import ROWS, documents, empty

KEY = "key of the tests"


# ---------- a plain version of the permutation ----------


def plain_feistel(a, b, size_a, size_b, tweak):
    for i in range(pii.ROUNDS):
        size = size_b if i % 2 else size_a
        digest = hashlib.sha256(f"{KEY}|{tweak}|{i}|{b}".encode()).hexdigest()
        a, b = b, (a + int(digest[:15], 16) % size) % size
    return a, b


def plain_digits(d, tweak):
    u = len(d) // 2
    a, b = plain_feistel(int(d[:u]), int(d[u:]), 10**u, 10 ** (len(d) - u), f"{tweak}|{len(d)}")
    return f"{a:0{u}d}{b:0{len(d) - u}d}"


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in pii.replaced(df, KEY).orderBy("doc_id").collect()]


def test_digits_are_permuted_as_said(spark):
    values = ["12", "999", "4041894974608795", "0000000000", "123456789012345678901234567890"]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    got = {r.d: r.p for r in df.select("d", pii.permute_digits(F.col("d"), F.lit("t"), KEY).alias("p")).collect()}
    assert got == {v: plain_digits(v, "t") for v in values}


def test_permutation_is_one_to_one(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert df.select(pii.permute_digits(F.col("d"), F.lit("t"), KEY).alias("p")).distinct().count() == 1000
    days = spark.range(0, 73049, 7).select(F.date_format(F.date_add(F.lit(pii.FIRST_DAY).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    moved = days.select(pii._date(F.col("d"), KEY)[1].alias("m"))
    assert moved.distinct().count() == days.count() and moved.where(F.try_to_date("m", "yyyy-MM-dd").isNull() | (F.col("m") < "1900-01-01") | (F.col("m") > "2099-12-31")).count() == 0


def test_formats(spark):
    card, phone, address, ssn, iban = "4041894974608795", "+1 (988) 555-2485", "70.123.182.155", "123-45-6789", "DE89370400440532013000"
    got = run(spark, [f"card {card} and {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}.", f"call {phone}", f"at {address}, {address}.", f"id {ssn}", f"to {iban}", "born 1985-02-28, 31.12.1999, 12/31/1999", "mail a.b.34@mail7.example.com or x@mail7.example.com."])
    a, b = re.fullmatch(r"card (\d{16}) and (\d{4} \d{4} \d{4} \d{4})\.", got[0]).groups()
    assert a == b.replace(" ", "") != card and luhn(a)
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}", got[1]) and phone not in got[1]
    x, y = re.fullmatch(r"at ([\d.]+), ([\d.]+)\.", got[2]).groups()
    assert x == y != address and all(int(o) < 256 for o in x.split("."))
    assert re.fullmatch(r"id (?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", got[3]) and ssn not in got[3]
    made = got[4].removeprefix("to ")
    assert made[:2] == "DE" and len(made) == len(iban) and made != iban
    assert int("".join(str(int(c, 36)) for c in made[4:] + made[:4])) % 97 == 1
    iso, german, american = re.fullmatch(r"born (\d{4}-\d\d-\d\d), (\d\d\.\d\d\.\d{4}), (\d\d/\d\d/\d{4})", got[5]).groups()
    assert german.split(".")[2] == american.split("/")[2] and german.split(".")[0] == american.split("/")[1]  # one day in two formats
    p, q = re.fullmatch(r"mail (\S+) or (\S+)\.", got[6]).groups()
    assert p.split("@")[1] == q.split("@")[1] and p != q and "example" not in p


def test_what_fails_validation_stays(spark):
    texts = ["bad 4041894974608796", "not 999.1.1.1 nor 1.2.3.4.5", "000-12-3456 and 666-12-3456", "1985-02-30 and 1985-13-01", "DE88370400440532013000", "version 3.0, CC BY-NC 4.0.", "a@b", "", "no digits"]
    assert run(spark, texts) == texts


def test_values_stay_linked_and_keys_differ(spark):
    df = spark.createDataFrame([(1, "x 4041894974608795"), (2, "y 4041894974608795 z")], "doc_id bigint, text string")
    one = [r.text.split()[1] for r in pii.replaced(df, "k1").orderBy("doc_id").collect()]
    two = [r.text.split()[1] for r in pii.replaced(df, "k2").orderBy("doc_id").collect()]
    assert one[0] == one[1] != two[0] == two[1]


def test_pii_rows(spark):
    got = pii.replaced(documents(spark), KEY).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in ROWS)
    assert pii.replaced(empty(spark), KEY).count() == 0
    counted = pii.replaced(spark.createDataFrame([(1, "1.2.3.4 a@b.com 1.2.3.4")], "doc_id bigint, text string"), KEY).first()
    assert (counted.n_ip, counted.n_email, counted.n_card) == (2, 1, 0)


def test_pii_uses_no_python(spark):
    plan = pii.replaced(documents(spark), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Scan")[0].replace("Exchange RoundRobin", "").replace("REPARTITION", "")


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 300_000, "1" * 300_000, "a." * 150_000, "1 " * 150_000, "+1 " * 100_000, "a@" * 100_000]
    assert run(spark, texts) == texts


# ---------- secrets ----------


def plain_base(text):
    spans = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            spans.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 32:
            spans.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(spans))


PIECES = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "abcdefgh", "short", "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "0f", "\n", "é", "😀", "."]


def test_base_spans_against_plain_patterns():
    draw = random.Random(8)
    for _ in range(4000):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 25)))
        spans = secrets_scan.find_spans(text)
        assert secrets_scan.listed([s for s in spans if s[2] != "novel"]) == plain_base(text)
        assert spans == sorted(spans, key=lambda s: (s[0], secrets_scan.KINDS.index(s[2]), s[1]))


@pytest.mark.parametrize(
    ("text", "novel"),
    [
        ("the signing key 3fK9zPq81LmXw02AbQ here", ["3fK9zPq81LmXw02AbQ"]),
        ("Authorization: Bearer q8Zx81kdPq0aLmW7tR2", ["q8Zx81kdPq0aLmW7tR2"]),
        ("session_manager_v2 is the session session_manager_v2 object", []),
        ("the key figures of 2024 and the token of thanks", []),
        ("no context 3fK9zPq81LmXw02AbQ here", []),
        ("token = \"04dbebab91ab85687d33\" stays a base span only", []),
    ],
)
def test_novelty(text, novel):
    assert [text[a:b] for a, b, k in secrets_scan.find_spans(text) if k == "novel"] == novel


def test_random_strings_are_novel_and_identifiers_are_not():
    draw = random.Random(9)
    fresh = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(24)) for _ in range(50)]
    assert sum(secrets_scan.is_novel("api key: ", s, "") for s in fresh) >= 48
    words = secrets_scan._IDENTIFIERS
    named = ["_".join(draw.choice(words) for _ in range(3)) for _ in range(50)]
    assert sum(secrets_scan.is_novel("api key: ", s, "") for s in named) <= 5


B64 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_"


@pytest.mark.parametrize("length", [40, 64, 65, 100, 200, 400, 1000])
def test_long_secrets_are_novel(length):
    draw = random.Random(length)
    for before, after in (("api key: ", ""), ("For the nightly export send the bearer ", " with each request, as the manual of the service says.")):
        for _ in range(20):
            found = draw.choice(B64[:62]) + "".join(draw.choice(B64) for _ in range(length - 1))
            text = before + found + after
            assert (len(before), len(before) + length, "novel") in secrets_scan.find_spans(text)


KINDS_OF = {"digits": "0123456789", "hex": "0123456789ABCDEF", "one case": "abcdefghijklmnopqrstuvwxyz", "both cases": B64[:52], "mixed": B64}


@pytest.mark.parametrize(("kind", "length", "least"), [("digits", 18, 95), ("hex", 20, 95), ("one case", 20, 60), ("one case", 40, 60), ("both cases", 20, 90), ("mixed", 20, 90), ("mixed", 12, 75)])
def test_every_alphabet_is_measured(kind, length, least):
    """Of 100 random strings in five contexts."""
    draw, around = random.Random(length), [("the private key: ", " and so on"), ("Authorization: Bearer ", "\nnext"), ('session_key = "', '"\nx = 1'), ("auth ", " then"), ("For years we had a look at the old private key ", " and went home late in the evening.")]
    made = ["".join(draw.choice(KINDS_OF[kind]) for _ in range(length)) for _ in range(100)]
    assert sum(secrets_scan.is_novel(around[i % 5][0], m, around[i % 5][1]) for i, m in enumerate(made)) >= least


def test_letters_alone_and_digits_alone():
    assert secrets_scan.redact("private key ZqPwXkRtYuVbNmLsDfGhJkQw") == "private key [SECRET]"
    assert secrets_scan.redact("auth 918273645546372819") == "auth [SECRET]"


def test_forms_are_secrets_in_any_context():
    draw = random.Random(10)
    for length in (20, 100, 400):
        jwt = "eyJ" + ".".join("".join(draw.choice(B64) for _ in range(length)) for _ in range(3))
        assert secrets_scan.redact(f"see {jwt} here") == "see [SECRET] here"
    assert secrets_scan.redact("see ghp_" + "xY" * 18 + " here") == "see [SECRET] here"


def test_random_letters_are_novel_and_words_are_not():
    assert secrets_scan.redact("Authorization: Bearer qXvLmTzWkRpYbHdNsJ") == "Authorization: Bearer [SECRET]"
    for word in ("responsibilities", "Datenschutzgrundverordnung", "INTERNATIONALIZATION", "getUserSessionToken", "session_manager_token"):
        assert secrets_scan.find_spans(f"the key {word} here") == []


def test_scan_rows(spark):
    got = secrets_scan.span_digests(secrets_scan.scan(documents(spark))).collect()
    want = [(str(i), hashlib.sha256(plain_base(t or "").encode()).hexdigest()) for i, t in ROWS]
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == sorted(want)
    (nine,) = [r for r in got if r.doc_id == 9]
    assert (nine.n_assign, nine.n_access, nine.n_hex, nine.spans) == (1, 0, 1, "assign:14:64,hex:23:63") or nine.spans == plain_base(ROWS[-1][1])
    assert secrets_scan.scan(empty(spark)).count() == 0


def test_redact(spark):
    docs = documents(spark)
    df = secrets_scan.redact_documents(docs.withColumn("n", F.length("text").cast("bigint")), length_col="n")
    assert df.columns == [*docs.columns, "n"] and df.where("_redacted <> 'other'").count() == 0
    got = {r.doc_id: (r.text, r.n) for r in df.where("doc_id IN (1, 9)").collect()}
    assert got[1] == (ROWS[0][1], len(ROWS[0][1])) and "04dbeb" not in got[9][0] and "[SECRET]" in got[9][0] and got[9][1] == len(got[9][0])
    assert df.where("text IS NULL").count() == 2 and df.count() == len(ROWS)


def test_every_date_is_permuted(spark):
    """Old and far dates too, among themselves; different dates stay different."""
    rows = [(i, f"on {d} x") for i, d in enumerate(["1899-05-06", "2150-01-02", "0001-01-01", "9999-12-31", "1899-12-31", "2100-01-01", "1900-01-01", "2099-12-31", "31.12.1812", "2000-02-30"])]
    got = {r.doc_id: r.text.split()[1] for r in pii.replaced(spark.createDataFrame(rows, "doc_id bigint, text string"), KEY).collect()}
    assert all(got[i] != t.split()[1] for i, t in rows[:9]) and got[9] == "2000-02-30"
    year = lambda i: int(re.search("[0-9]{4}", got[i])[0])
    assert all(1900 <= year(i) <= 2099 for i in (6, 7)) and not any(1900 <= year(i) <= 2099 for i in (0, 1, 2, 3, 4, 5, 8))
    many = spark.sql("SELECT id AS doc_id, concat('d ', date_add(DATE'1895-01-01', CAST(id AS INT)), ' e') AS text FROM range(4000)")
    assert pii.replaced(many, KEY).select("text").distinct().count() == 4000


def test_no_key_no_pseudonyms(spark):
    with pytest.raises(ValueError, match="need a key"):
        pii.replaced(documents(spark))
