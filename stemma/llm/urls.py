"""URL filters: rules by host and path, then a naive Bayes over segmented host and path words.

Names in hosts are often written together (``cheappillsnow``). A unigram Viterbi splits every run of letters into the
words of a lexicon; a stretch that no word covers stays one unknown word, at a cost that grows with its length. A
multinomial naive Bayes sums the log odds of the known words of host and path.

Both are learned from the urls themselves. The lexicon counts on how many hosts a run of letters stands alone. The naive
Bayes starts from the seed words below and goes through ROUNDS of expectation maximisation: every different url is scored,
its words count for both classes by that score, averaged for each host so that no host counts for its number of pages, and
the sums become the next model. Words that come with both kinds of pages alike (www, en, html) turn out neutral by that. The
smoothing is the one under which the words of held-out hosts (crc32 of the host modulo 5 is 0) are likeliest. The model
holds the LEXICON words on most hosts; words seen on one host only say nothing about others.

Hosts and paths are parsed in DataFrame functions, counts are aggregated on the executors, and the model is some megabytes
at most. Verdicts need no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.cluster import cut
from stemma.llm.html_text import host_of

#: The rules in use, (verdict, host and path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Seed words: what the classes begin with.
BLOCKED = """
    casino-win casino online poker slots jackpot win roulette betting free-bets bet bets sportsbet bookmaker odds wager gamble
    cheap-pills pills viagra cialis pharmacy meds drugs cheap rx no prescription weight loss diet pills
    adult-x adult xxx porn sex cams escort nude webcam hot girls dating hookup
    spam-farm spam farm link-farm links backlinks seo traffic bulk buy followers likes
    ads-track ads ad adserver tracker track tracking click clicks banner pixel popunder popup affiliate redirect
    free money fast cash loan loans payday crypto giveaway bonus prize winner lottery replica watches fake warez crack keygen torrent
"""
ALLOWED = """
    news daily times herald press journal magazine post article story world local sport weather
    docs documentation wiki encyclopedia library archive manual guide tutorial reference learn school university edu course research science
    store market books music film art museum gallery travel hotel food recipes kitchen garden home family health clinic hospital
    bank insurance tax law government city council office service support help contact about team company group
    software code data cloud developer open source project api status forum community calendar photo video
    search category product author profile item list
"""
#: Words that only help to split; they say nothing about a verdict.
NEUTRAL = "the and of for to in on my your our best top new now all one web site live pro plus club zone hub app get go big super mega max today here"
#: Hosts that a seed word counts as.
SEED_WEIGHT = 3.0
#: Words in the model at most, hosts that a word of the data is on at least, and its letters at least.
LEXICON, LEAST_HOSTS, LEAST_LETTERS = 50_000, 2, 3
#: Rounds of expectation maximisation, smoothings to choose from, and the share of bad hosts to begin with and its bounds.
ROUNDS, SMOOTHINGS, PRIOR, PRIORS = 2, (0.05, 0.2, 0.5, 1.0, 2.0), 0.15, (0.05, 0.3)


def _words(text: str) -> list[str]:
    return re.findall("[a-z]+", text.lower())


@dataclass
class Model:
    """Log probabilities of the lexicon's words, log odds of words between bad and good pages, and the log odds of all pages."""

    lexicon: dict[str, float]
    odds: dict[str, float]
    prior: float


def lexicon(counts: dict[str, float]) -> dict[str, float]:
    """Log probabilities of the seed words and of words counted on hosts."""
    seeds = Counter([*_words(BLOCKED), *_words(ALLOWED), *_words(NEUTRAL)])
    total = Counter({w: SEED_WEIGHT * n for w, n in seeds.items() if len(w) > 1 or w == "x"})
    total.update(counts)
    whole = sum(total.values())
    return {w: math.log(n / whole) for w, n in total.items()}


def log_odds(bad: dict[str, float], good: dict[str, float], smoothing: float) -> dict[str, float]:
    """Log odds of words from the hosts that they count for in each class, and the seeds."""
    b, g = (Counter({w: SEED_WEIGHT for w in _words(seeds)}) for seeds in (BLOCKED, ALLOWED))
    b.update(bad)
    g.update(good)
    kinds = len(b | g)
    n_bad, n_good = sum(b.values()) + smoothing * kinds, sum(g.values()) + smoothing * kinds
    return {w: math.log((b[w] + smoothing) / n_bad) - math.log((g[w] + smoothing) / n_good) for w in b | g}


def best_smoothing(bad: dict[str, float], good: dict[str, float], held_bad: dict[str, float], held_good: dict[str, float]) -> float:
    """The smoothing under which the held-out words of both classes are likeliest."""

    def likelihood(s: float) -> float:
        total = 0.0
        for seen, held, seeds in ((bad, held_bad, BLOCKED), (good, held_good, ALLOWED)):
            known = Counter({w: SEED_WEIGHT for w in _words(seeds)})
            known.update(seen)
            whole = sum(known.values()) + s * (len(known) + 1)
            total += sum(n * math.log((known[w] + s) / whole) for w, n in held.items())
        return total

    return max(SMOOTHINGS, key=likelihood)


def seed_model(counts: dict[str, float] | None = None) -> Model:
    return Model(lexicon(counts or {}), log_odds({}, {}, 0.5), math.log(PRIOR / (1 - PRIOR)))


class Scorer:
    """A model at work in one task, with a memo of its splits."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.longest, self.floor = max(map(len, model.lexicon)), min(model.lexicon.values())
        self.segment = lru_cache(maxsize=100_000)(self._segment)
        self.score = lru_cache(maxsize=20_000)(self._score)

    def _segment(self, run: str) -> tuple[str, ...]:
        """The likeliest split of a run of letters. Letters that no word covers stay together."""
        known_words = self.model.lexicon
        unknown = lambda n: self.floor - 2.0 - 2.0 * n
        best: list[tuple[float, int, bool]] = [(0.0, 0, True)]  # score, where the last word begins, whether it is known
        for end in range(1, len(run) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                word = known_words.get(run[start:end])
                if word is not None and (end - start > 1 or len(run) == 1):
                    options.append((best[start][0] + word, start, True))
            score, start, known = best[end - 1]
            # an unknown stretch goes on at the cost of a letter, or begins
            options.append((score - 2.0, start, False) if not known else (score + unknown(1), end - 1, False))
            best.append(max(options))
        out, end = [], len(run)
        while end:
            out.append(run[best[end][1] : end])
            end = best[end][1]
        return tuple(reversed(out))

    def tokens(self, host: str, path: str) -> list[str]:
        return [w for run in re.findall("[a-z]+", f"{host} {path}".lower()) for w in self.segment(run)]

    def _score(self, host: str, path: str) -> float:
        """Log odds that a page is to be blocked. Unknown words don't count."""
        return self.model.prior + sum(self.model.odds.get(w, 0.0) for w in self.tokens(host, re.sub("[0-9]+", "", path)))


def _host_counts(urls: DataFrame) -> dict[str, float]:
    """On how many hosts a run of letters stands alone, for the LEXICON most spread ones."""
    runs = urls.select("host", F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "host", "path")), F.lit("([a-z]+)"), F.lit(1))).alias("w"))
    seen = runs.where(F.length("w").between(LEAST_LETTERS, 40)).distinct().groupBy("w").count().where(F.col("count") >= LEAST_HOSTS)
    return {r["w"]: float(r["count"]) for r in seen.orderBy(F.desc("count"), "w").limit(LEXICON).collect()}


def _class_counts(urls: DataFrame, model: Model) -> list[dict[str, float]]:
    """Hosts that each word counts for: [bad, good] of hosts to learn from, [bad, good] of held-out hosts, and the share of bad hosts."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            hosts, words, chances = [], [], []
            for host, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = {w for w in scorer.tokens(host, path) if w in model.lexicon}
                chance = 1 / (1 + math.exp(-max(-30.0, min(30.0, scorer.score(host, path)))))
                hosts += [host] * (len(own) + 1)
                words += [*own, ""]  # the empty word counts the host itself
                chances += [chance] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(words, pa.string()), pa.array(chances, pa.float64())], ["host", "w", "p"])

    by_host = urls.select("host", "path").mapInArrow(of, "host string, w string, p double").groupBy("host", "w").agg(F.avg("p").alias("p"))
    held = F.crc32(F.col("host").cast("binary")) % 5 == 0
    part = lambda p, own: F.sum(F.when(own, p).otherwise(0.0))
    good = 1 - F.col("p")
    sums = by_host.groupBy("w").agg(part(F.col("p"), ~held).alias("b"), part(good, ~held).alias("g"), part(F.col("p"), held).alias("hb"), part(good, held).alias("hg"))
    rows = sums.collect()  # no more words than the lexicon has
    return [{r["w"]: r[k] for r in rows if r["w"]} for k in ("b", "g", "hb", "hg")] + [{k: sum(r[k] for r in rows if not r["w"]) for k in ("b", "g", "hb", "hg")}]


def learn(urls: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of a table of different (host, path)."""
    counts = _host_counts(urls)
    model = seed_model(counts)
    for _ in range(rounds):
        bad, good, held_bad, held_good, hosts = _class_counts(urls, model)
        smoothing = best_smoothing(bad, good, held_bad, held_good)
        every = [{w: a[w] + h[w] for w in a} for a, h in ((bad, held_bad), (good, held_good))]
        n = sum(hosts.values())
        share = min(PRIORS[1], max(PRIORS[0], (hosts["b"] + hosts["hb"]) / n)) if n else PRIOR
        model = Model(model.lexicon, log_odds(*every, smoothing), math.log(share / (1 - share)))
    return model


def path_of(url_col: str = "url") -> Column:
    """Path of a url: what follows the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct(verdict, rule) of the longest rule that fits the host or a parent domain and begins the path; else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    Null urls and those without ``://`` have an empty host and path; the method judges them by its prior (allow). Repeated
    rows stay and count once in learning; without rows the seed words alone make the model. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    model = learn(cut(rows.select("host", "path").where("host <> ''").distinct()))

    @F.pandas_udf("string")
    def learned(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for hosts, paths in parts:
            yield pd.Series(["block" if scorer.score(h, p) > 0 else "allow" for h, p in zip(hosts, paths, strict=True)], dtype="object")

    ruled = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("_rule.verdict", learned("host", "path"))
    return ruled.select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
