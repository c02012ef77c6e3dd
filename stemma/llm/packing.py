"""Best-fit packing of token pieces into sequences of fixed capacity, by Best-two-fit on the histogram of lengths.

A piece is at most ``capacity`` tokens long, so all that the packing depends on is how many pieces there are of each
length: a table of at most ``capacity`` rows, whatever the corpus. Best-two-fit runs on those counts. It fills a bin
with the longest pieces that still fit; then, if a gap is left, it takes out the bin's smallest piece if two unpacked
pieces fit the widened gap more tightly. The choices stay the same until a length runs out, so a filled bin is used as
often as the counts allow, and some thousand patterns describe all bins.

The pieces then find their places on the executors: the rank of a piece among those of its length, in runs of some
hundreds (a third of all pieces may have one length), says which pattern, which of its copies and which place. The
table of patterns is broadcast: it has at most 2 * capacity patterns of at most 64 different lengths each.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.llm.bpe import default_vocabulary, transducer
from stemma.llm.cluster import cut

CAPACITY = 2048
#: Id that ends each document.
SEPARATOR = 0
#: Pieces of one length ranked by one task, and runs whose counts one task adds up.
RUN, RUNS = 500, 2000
#: Documents whose ids a worker holds at once.
HELD = 256


@lru_cache(maxsize=1)
def _encoding():  # noqa: ANN202
    """The vocabulary of byte_bpe_50k.json as ranks: the same ids, encoded several times faster."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})


def encoded(text: str) -> np.ndarray:
    """Ids of a text. Where the library's pattern overflows (a million white space characters in a row), the transducer's."""
    try:
        ids = _encoding().encode(text, allowed_special="all")
    except ValueError:
        return np.frombuffer(b"".join(transducer(default_vocabulary()).encode(text)), "<u4")
    return np.array(ids, "<u4")


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole if they fit, else full pieces after a first one of the rest."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids and the separator. Null texts count as empty."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, HELD) for whole in batches for at in range(0, len(whole), HELD)):
            keys, rows = [], []
            for at, text in enumerate(b.column(1)):
                ids = np.append(encoded(text.as_py() or ""), np.array(SEPARATOR, "<u4"))
                for k, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    keys.append(at)
                    rows.append((k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys, pa.int64())), *made], ["_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(of, f"_id {rows.schema['_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns (number of bins, {length: pieces of it in each}) that use up ``counts``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    sizes, patterns = np.arange(capacity + 1), []
    while left.any():
        own, gap = np.zeros(capacity + 1, np.int64), capacity
        while len(fits := np.flatnonzero(left[: gap + 1] > own[: gap + 1])):
            n = min(int(left[fits[-1]] - own[fits[-1]]), gap // int(fits[-1]))
            own[fits[-1]] += n
            gap -= n * int(fits[-1])
        if gap and own.sum() > 1:
            smallest = int(np.flatnonzero(own)[0])
            own[smallest] -= 1
            free, room = left - own, gap + smallest
            largest = np.maximum.accumulate(np.where(free > 0, sizes, 0))  # longest free piece up to each length
            first = np.flatnonzero(free[: room + 1] > 0)
            second = largest[room - first]
            second = np.where((second == first) & (free[first] < 2), largest[np.maximum(first - 1, 0)], second)
            both = np.where(second > 0, first + second, 0)
            best = int(both.argmax()) if len(both) else -1
            if best >= 0 and both[best] > smallest:
                own[first[best]] += 1
                own[second[best]] += 1
            else:
                own[smallest] += 1
        used = np.flatnonzero(own)
        times = int((left[used] // own[used]).min())
        left -= times * own
        patterns.append((times, {int(s): int(own[s]) for s in used[::-1]}))
    return patterns


def _places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, pieces in each bin, first bin, offset)."""
    taken: dict[int, int] = {}
    rows, bins = [], 0
    for times, own in patterns:
        offset = 0
        for length, n in own.items():
            at = taken.get(length, 0)
            rows.append((length, at, at + times * n, n, bins, offset))
            taken[length] = at + times * n
            offset += n * length
        bins += times
    return rows


def _ahead(sizes: DataFrame, runs: int) -> DataFrame:
    """(length, _run, _ahead) from (length, _run, count): the pieces in the runs before. Runs are added up block by block."""
    rows = sizes.withColumn("_block", F.floor(F.col("_run") / runs))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("count").over(before("length", "_block").orderBy("_run")), F.lit(0)).alias("_inner")
    outer = F.coalesce(F.sum("_all").over(before("length").orderBy("_block")), F.lit(0)).alias("_outer")
    blocks = rows.groupBy("length", "_block").agg(F.sum("count").alias("_all")).select("length", "_block", outer)
    return rows.select("length", "_block", "_run", inner).join(blocks, ["length", "_block"]).select("length", "_run", (F.col("_inner") + F.col("_outer")).alias("_ahead"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, run: int = RUN, runs: int = RUNS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty and give a piece with the separator alone. Repeated rows are packed each; null identifiers
    stay null. An empty input gives an empty result. Other columns of the input are not read. Texts may be of any length, and
    hold any run of white space.
    """
    spark = docs.sparkSession
    made = cut(pieces(docs, id_col, text_col, capacity)).withColumn("_tag", F.monotonically_increasing_id())
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = spark.createDataFrame([(n, -(-c // run)) for n, c in counts.items()], "length bigint, _runs bigint")
    places = spark.createDataFrame(_places(best_two_fit(counts, capacity)), "length bigint, _from bigint, _to bigint, _each bigint, _bin bigint, _at bigint")
    rows = made.join(F.broadcast(table), "length").withColumn("_run", F.pmod(F.xxhash64("_tag"), "_runs"))
    ahead = _ahead(rows.groupBy("length", "_run").count(), runs)
    within = F.row_number().over(Window.partitionBy("length", "_run").orderBy("_tag")) - 1
    ranked = rows.withColumn("_within", within).join(ahead, ["length", "_run"]).withColumn("_rank", F.col("_ahead") + F.col("_within"))
    nth = F.col("_rank") - F.col("_from")
    found = ranked.join(F.broadcast(places), "length").where("_rank >= _from AND _rank < _to")
    return found.select(
        F.col("_id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_bin") + F.floor(nth / F.col("_each"))).cast("bigint").alias("sequence_id"),
        (F.col("_at") + F.pmod(nth, "_each") * F.col("length")).cast("bigint").alias("offset"),
    )
