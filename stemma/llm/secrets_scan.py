"""Secret scans: exact patterns, and novelty against a primed zstandard dictionary.

Three patterns give the base spans. The method adds spans of kind ``novel``: strings in a sensitive context (a word such
as key, auth or credential shortly before) that the compressor can't explain. A candidate's novelty is its marginal
cost: bytes of the compressed context with the candidate minus bytes of the context alone, per character, with a
dictionary of code and identifiers primed into the compressor. Ordinary names and words cost little, since the dictionary
or the surrounding text holds their parts; random strings cost nearly their entropy.

Every text is scanned whole, row by row; nothing is exchanged between rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stemma.llm.cluster import unused

KINDS = ("assign", "access", "hex", "novel")
#: The base patterns and the least length of what counts.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched whole, so the shorter ones need not be found first
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: Least length of a candidate, and most characters other than letters, digits and line ends between the sensitive word and it.
LEAST_NOVEL, GAP = 12, 24
#: A sensitive word, the gap, and the candidate.
CONTEXT = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|auth(?:orization)?|bearer|credential|private|session|signature|webhook|access)s?"""
    rf"""[^A-Za-z0-9\n]{{1,{GAP}}}(?:(?ai:id|value|is|bearer|basic|key)[^A-Za-z0-9\n]{{1,8}})*(?P<found>[A-Za-z0-9+/_=-]{{{LEAST_NOVEL},}})"""
)
#: Strings that are secrets by their form, in any context.
FORMS = re.compile(r"\b(?P<found>gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{16,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)")
#: Characters of surrounding text that prime the measurement, before and after.
AROUND = 256
#: Characters of filling before the surroundings.
FILLING = 300
#: Compressed bytes for each character from which a candidate is novel, by what it is made of. Nearly all random strings of 20
#: characters and more cost that much, letters of one case in four of five cases; words and identifiers cost less.
NOVELTY = {"digits": 0.58, "hex": 0.6, "one case": 0.72, "both cases": 0.73, "mixed": 0.74}
#: Characters of a window. Longer than two, a candidate is measured window by window, since the cost of a character falls
#: with the length (to 0.75 bytes for random base64) and would say little about long strings.
WINDOW = 32
_IDENTIFIERS = """
    abstract access account action address admin alias allow append args array assert async attribute auth author await
    backend base batch begin block body boolean buffer build bytes cache call catch char check child class clean click
    client close cluster code collect color column command commit compare config connect const content context control
    convert count create current cursor data database date debug decode default define delete depth describe destroy
    device dict digest directory disable display document domain double download element else email enable encode end
    engine entry enum environ error event example except execute exists export extend false fetch field file filter final
    find first float flush folder format found from function future general generate get global group handle hash header
    height hidden host html http identifier image import include index info init input insert instance integer interface
    internal invoke item iterator join json key label language last layout length level library limit line link list
    listen load local lock logger loop main manager map mark master match matrix max member memory menu merge message
    method middle min mode model module name native network next node none normal null number object offset open
    operator option order origin output override owner package page param parent parse password path pattern payload
    pending permission pipe plugin point policy port position post prefix prepare previous print private process
    product profile project property protected protocol provider proxy public query queue random range read receive
    record recursive redirect reference refresh register release remote remove render replace report request require
    reset resource response result resume return reverse root route row rule runtime sample save schema scope score script
    search secret section select self send sequence server service session setting shape shared signal size sleep
    socket sort source stack start state static status step stop storage store stream string struct style submit suffix
    summary switch symbol sync system table tag target task template temp test text thread throw time timeout title
    token total trace track transaction transform tree trigger true type undefined union unique update upload url user
    util valid value variable vector version view visible void volume wait warning weight while widget width window
    worker wrapper write yield zone
""".split()


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    """Primed with identifiers in the usual spellings and with lines of code and settings around them."""
    words = _IDENTIFIERS
    pairs = list(zip(words, words[7:] + words[:7], strict=True))
    spelled = [f"{a}_{b} {a}{b.title()} {a.upper()}_{b.upper()} {a}-{b}" for a, b in pairs]
    lines = [f'{a}.{b}("{a}", {b}={a})\n"{a}_{b}": "{b}",\nexport {a.upper()}={b}\nconst {b} = new {a.title()}();' for a, b in pairs[::5]]
    data = "\n".join([*spelled, *lines, " ".join(words), "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"]).encode()
    primed = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(19, source_size=1024, dict_size=len(data), min_match=3, write_checksum=False, write_content_size=False)
    return zstandard.ZstdCompressor(dict_data=primed, compression_params=how)


@lru_cache(maxsize=1)
def _filling() -> bytes:
    """Letters as frequent as in identifiers, in random order, some of them capitals, and digits: they settle what a character
    that no match explains costs, which would depend on how much text there is around it otherwise."""
    draw, letters = random.Random(11), "".join(_IDENTIFIERS)
    return "".join(draw.choice(draw.choice((letters, letters, letters, letters.upper(), "0123456789"))) for _ in range(FILLING)).encode()


def novelty(before: str, candidate: str, after: str) -> float:
    """Marginal compressed bytes for each character of ``candidate`` between its surroundings.

    The cheaper of two spellings counts: as written, and as the lower-case words of an identifier.
    """
    c = _compressor()
    plain = _filling() + f"\n{before}\n{after}\n".encode()
    words = " ".join(re.findall("[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", candidate)).lower()
    least = min(len(c.compress(plain + x.encode())) for x in (candidate, words))
    return (least - len(c.compress(plain))) / len(candidate)


def windows(candidate: str) -> list[str]:
    """The candidate, or its different half-overlapping windows if it is longer than two of them."""
    if len(candidate) <= 2 * WINDOW:
        return [candidate]
    starts = [*range(0, len(candidate) - WINDOW, WINDOW // 2), len(candidate) - WINDOW]
    return list(dict.fromkeys(candidate[a : a + WINDOW] for a in starts))


def made_of(part: str) -> str:
    """The alphabet that decides how much a random string of this kind costs."""
    lower, upper, digit = (re.search(c, part) is not None for c in ("[a-z]", "[A-Z]", "[0-9]"))
    if not (lower or upper):
        return "digits"
    if digit and lower != upper and re.fullmatch("[0-9A-Fa-f]+", part):
        return "hex"
    return "mixed" if digit else "both cases" if lower and upper else "one case"


def is_novel(before: str, candidate: str, after: str) -> bool:
    """Every candidate is measured, whatever it is made of."""
    return any(novelty(before, w, after) >= NOVELTY[made_of(w)] for w in windows(candidate))


def _novel(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    seen: set[tuple[int, int]] = set()
    for pattern in (CONTEXT, FORMS):
        for m in pattern.finditer(text):
            start, end = m.span("found")
            found = m["found"]
            if (start, end) in seen or any(a < end and start < b for a, b in taken):
                continue
            if pattern is FORMS or is_novel(text[max(0, start - AROUND) : start], found, text[end : end + AROUND]):
                seen.add((start, end))
                yield start, end


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed in KINDS. Null texts have none."""
    if not text:
        return []
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    spans += [(a, b, "novel") for a, b in _novel(text, [(a, b) for a, b, _ in spans])]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, _ in find_spans(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, spans as array of (start, end, kind). Null and empty texts have an empty array."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"start": s, "end": e, "kind": k} for s, e, k in find_spans(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["_id", "spans"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, spans array<struct<start:bigint,end:bigint,kind:string>>"
    return rows.mapInArrow(of, schema).withColumnRenamed("_id", id_col)


def span_digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From ``scan``: id, n_assign, n_access, n_hex, base_sha256, spans (text)."""
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return scanned.select(id_col, *(of_kind(k) for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns, with secrets in the texts replaced by a mark; ``length_col`` gets the new length."""

    @F.pandas_udf(StringType())
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(redact, na_action="ignore")

    name = unused(docs, "_redacted")
    made = docs.withColumn(name, redacted(F.col(text_col)))
    if length_col:
        same = F.col(name).eqNullSafe(F.col(text_col))
        made = made.withColumn(length_col, F.when(same, F.col(length_col)).otherwise(F.length(name).cast(docs.schema[length_col].dataType)))
    return made.withColumn(text_col, F.col(name)).select(*docs.columns)
