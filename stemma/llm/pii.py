"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation, in DataFrame functions only.

Numbers and dates that pass their validation (Luhn, IBAN check digits, calendar, address and number ranges) are permuted
within the set of valid values of the same format, ten rounds with SHA-256 as the round function. A permutation keeps
different values different, and the same key maps equal values to equal pseudonyms, so they stay linked across documents
without a table of what was seen. Check digits are computed anew and separators stay where they were. Mail addresses
have no such set of values; their parts become keyed digests, equal domains alike.

Each text is split at the matches of one pattern; the gaps and the pseudonyms are joined again. Rows without a digit or
an at sign skip this. There is no shuffle, and rows of any length work on their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "iban", "card", "ssn", "date", "phone", "ip")
ROUNDS = 10
#: Session setting that names the key.
KEY_CONF = "spark.stemma.pii.key"

#: The formats, tried in this order at each place.
FORMATS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}(?: [0-9]{4}){3})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "phone": r"(?<![0-9A-Za-z+(])(?:\+[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3}[ -][0-9]{3,4}|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
}
ANY = "|".join(FORMATS.values())

#: Days from 1900-01-01 up to 2099-12-31 as the product of two numbers, and those before and after, from 0001-01-01 up to
#: 9999-12-31: dates of living memory stay such. Valid areas and groups of an SSN, and its serials.
FIRST_DAY, DATE_SPLIT = "1900-01-01", (17, 4297)
OLDEST_DAY, FAR_SPLIT = "0001-01-01", (170, 21053)
SSN_SPLIT = (898 * 99, 9999)


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, tweak: Column, key: str) -> Column:
    """Permute the pair (a, b) of numbers below the two sizes; equal pairs and tweaks give equal results.

    A round replaces (a, b) by (b, a + f(b)), modulo the size that belongs to a; after an even number of rounds both
    are back in their places. Result: struct(a, b).
    """

    def turn(state: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), state["b"].cast("string")), 256)
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        size = F.when(i % 2 == 0, size_a).otherwise(size_b)
        return F.struct(state["b"].alias("a"), F.pmod(state["a"] + F.pmod(number, size), size).alias("b"))

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permute_digits(digits: Column, tweak: Column, key: str) -> Column:
    """Permute a string of 2 to 30 digits among the strings of its length."""

    def of(d: Column) -> Column:
        left = F.floor(F.length(d) / 2).cast("int")
        power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("bigint")
        cut = F.substr(d, F.lit(1), left), F.substr(d, left + 1)
        made = feistel(cut[0].cast("bigint"), cut[1].cast("bigint"), power(left), power(F.length(d) - left), F.concat_ws("|", tweak, F.length(d).cast("string")), key)
        return _let(made, lambda m: F.concat(F.lpad(m["a"].cast("string"), left, "0"), F.lpad(m["b"].cast("string"), F.length(d) - left, "0")))

    return _let(digits, of)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """The characters of ``form`` with its digits replaced by ``digits`` in turn."""

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(state["out"], F.when(is_digit, F.substr(digits, state["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (state["k"] + is_digit.cast("int")).alias("k"),
        )

    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), put, lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _luhn_digit(payload: Column) -> Column:
    """The digit after ``payload`` that makes the whole valid."""
    tries = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(payload, d.cast("string")))
    return F.substring(F.element_at(F.filter(tries, _luhn), 1), -1, 1)


def _card(m: Column, key: str) -> tuple[Column, Column]:
    payload = _digits(m).substr(F.lit(1), F.length(_digits(m)) - 1)
    made = _let(permute_digits(payload, F.lit("card"), key), lambda p: F.concat(p, _luhn_digit(p)))
    return _luhn(_digits(m)), _refill(m, made)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a number written with digits and letters (A is 10)."""

    def turn(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), turn)


def _iban(m: Column, key: str) -> tuple[Column, Column]:
    country, body = F.substring(m, 1, 2), F.substr(m, F.lit(5))
    valid = (_mod97(F.concat(body, F.substring(m, 1, 4))) == 1) & (F.length(_digits(body)) >= 2)
    made = _let(
        _refill(body, permute_digits(_digits(body), F.concat(F.lit("iban"), country), key)),
        lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b),
    )
    return valid, made


def _ssn(m: Column, key: str) -> tuple[Column, Column]:
    part = lambda at, n: F.substring(m, at, n).cast("int")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = (area - 1 - (area > 666).cast("int")) * 99 + group - 1
    made = feistel(index, serial - 1, F.lit(SSN_SPLIT[0]), F.lit(SSN_SPLIT[1]), F.lit("ssn"), key)

    def written(p: Column) -> Column:
        place = F.floor(p["a"] / 99) + 1
        return F.format_string("%03d-%02d-%04d", place + (place > 665).cast("int"), p["a"] % 99 + 1, p["b"] + 1)

    return valid, _let(made, written)


def _date(m: Column, key: str) -> tuple[Column, Column]:
    iso, sep = m.rlike("^[0-9]{4}-"), F.substring(m, 3, 1)
    ymd = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, mo, d), "yyyy-MM-dd")
    year, one, two = F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)
    day_first = ymd(year, two, one)
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).otherwise(F.coalesce(day_first, ymd(year, one, two)))
    near, far, oldest = DATE_SPLIT[0] * DATE_SPLIT[1], FAR_SPLIT[0] * FAR_SPLIT[1], F.lit(OLDEST_DAY).cast("date")
    since = F.datediff(F.lit(FIRST_DAY).cast("date"), oldest)
    index = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    valid = day.isNotNull() & (index >= -since) & (index < far + near - since)

    def permuted(i: Column, split: tuple[int, int], tweak: str) -> Column:
        made = feistel(F.floor(i / split[1]), i % split[1], F.lit(split[0]), F.lit(split[1]), F.lit(tweak), key)
        return _let(made, lambda p: (p["a"] * split[1] + p["b"]).cast("int"))

    outside = _let(permuted(F.when(index < 0, index + since).otherwise(index + since - near), FAR_SPLIT, "far date"), lambda k: k + F.when(k >= since, near).otherwise(0) - since)
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), F.when(index.between(0, near - 1), permuted(index, DATE_SPLIT, "date")).otherwise(outside))

    def written(d: Column) -> Column:
        p = lambda form: F.date_format(d, form)
        short = F.when(day_first.isNotNull(), F.concat(p("dd"), sep, p("MM"))).otherwise(F.concat(p("MM"), sep, p("dd")))
        return F.when(iso, p("yyyy-MM-dd")).otherwise(F.concat(short, sep, p("yyyy")))

    return valid, _let(moved, written)


def _phone(m: Column, key: str) -> tuple[Column, Column]:
    country = F.regexp_extract(m, r"^\+[0-9]{1,3}", 0)
    rest = F.substr(m, F.length(country) + 1)
    return F.length(_digits(m)).between(7, 15), F.concat(country, _refill(rest, permute_digits(_digits(rest), F.concat(F.lit("phone"), country), key)))


def _ip(m: Column, key: str) -> tuple[Column, Column]:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    half = lambda i: F.element_at(octets, i) * 256 + F.element_at(octets, i + 1)
    made = feistel(half(1), half(3), F.lit(65536), F.lit(65536), F.lit("ip"), key)
    valid = F.forall(octets, lambda o: o <= 255)
    return valid, _let(made, lambda p: F.concat_ws(".", *(x.cast("string") for h in "ab" for x in (F.floor(p[h] / 256), p[h] % 256))))


def _email(m: Column, key: str) -> tuple[Column, Column]:
    whole = F.lower(m)
    tag = lambda what, of, n: F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(what), of), 256), 1, n)
    domain = F.substring_index(whole, "@", -1)
    return F.lit(True), F.concat(F.lit("u"), tag("mail", whole, 16), F.lit("@d"), tag("domain", domain, 10), F.lit(".invalid"))


_MAKERS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "date": _date, "phone": _phone, "ip": _ip}


def pseudonym(match: Column, key: str) -> Column:
    """struct(kind, value) for one match; kind is null and value the match itself if no format's validation passes."""
    out = F.struct(F.lit(None).cast("string").alias("kind"), match.alias("value"))
    for kind in reversed(KINDS):
        valid, made = _MAKERS[kind](match, key)
        out = F.when(match.rlike(f"^(?:{FORMATS[kind]})$") & valid, F.struct(F.lit(kind).alias("kind"), made.alias("value"))).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str | None = None, text_col: str = "text", found_col: str = "found") -> DataFrame:
    """All columns, with personal data in the texts replaced, and ``found_col``: the kinds replaced, in order.

    The key is the argument or the session's ``spark.stemma.pii.key``; without one this raises. Null texts stay null; empty
    ones have nothing to replace. Matches that fail validation stay as they are.
    """
    key = key or docs.sparkSession.conf.get(KEY_CONF, "")
    if not key:
        raise ValueError(f"pseudonyms need a key: pass one or set {KEY_CONF}")
    if found_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column {found_col}; name another")
    text, found = F.col(text_col), F.col(found_col)
    some = text.rlike("[0-9@]")
    parts = docs.withColumn(found_col, F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>")))
    made = parts.withColumn(found_col, F.transform(found, lambda m: pseudonym(m, key)))
    pieces = F.zip_with(F.split(text, ANY, -1), found, lambda g, r: F.concat(g, F.coalesce(r["value"], F.lit(""))))
    joined = F.when(F.size(found) > 0, F.array_join(pieces, "")).otherwise(text)
    kinds = F.filter(F.transform(found, lambda r: r["kind"]), lambda k: k.isNotNull())
    return made.withColumn(text_col, joined).withColumn(found_col, kinds)


def replaced(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text with pseudonyms, and the number of replaced values of each kind."""
    rows = pseudonymise(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), key, "_text")
    number = lambda kind: F.size(F.filter("found", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")
    return rows.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), *map(number, KINDS))
