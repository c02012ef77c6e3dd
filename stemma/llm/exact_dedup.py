"""Exact dedup as a tree merge of sorted digest runs, in DataFrame functions only.

Every input partition starts as one run: its rows reduced to (digest, smallest identifier, count). In each round
``fan_in`` neighbouring runs (binomial numbering: run number divided by the fan-in) exchange their rows by
(run, digest) and are merged. The carried value is a struct, so Spark merges by sorting: partial and final
SortAggregate over runs ordered by digest, which spill instead of growing. After ceil(log_fan_in(partitions)) rounds
one run remains, spread over all shuffle partitions by digest.

A row moves through the rounds as about 80 bytes whatever its text's length, and copies collapse before each exchange,
so a group that holds a third of all rows costs one row for each task. The last step joins the groups of two or more
rows back to the rows; there a hot digest is split by adaptive skew handling (a plain sort-merge join, both sides
exchanged by the join keys).

Verification: runs only merge entries whose SHA-256, byte length and 64-bit XXH64 all agree, so entries that shared
one digest by accident would stay apart at every level.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.cluster import cut, unused

#: Runs merged at once in each round.
FAN_IN = 16
_KEY = ("_sha", "_bytes", "_check")


def normalised(text: Column) -> Column:
    """Null as empty; every run of the six ASCII white space characters as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: identifier, digest, verification values and a row tag; no text."""
    norm = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("_id"), norm.alias("_norm")).select(
        "_id",
        F.unhex(F.sha2("_norm", 256)).alias("_sha"),
        F.octet_length("_norm").cast("bigint").alias("_bytes"),
        F.xxhash64("_norm").alias("_check"),
        F.monotonically_increasing_id().alias("_tag"),
    )


def merge_tree(rows: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """Merge the runs (one per partition of ``rows``) round by round into one entry per distinct text."""
    bits = max(1, int(math.log2(fan_in)))
    level = rows.select(
        F.shiftright("_tag", 33).alias("_run"),  # monotonically_increasing_id keeps the partition number there
        *_KEY,
        F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_tag").alias("tag")).alias("_best"),
        F.lit(1).cast("bigint").alias("_n"),
    )
    for _ in range(max(1, math.ceil(math.log2(max(2, runs)) / bits))):
        level = (
            level.withColumn("_run", F.shiftright("_run", bits))
            .groupBy("_run", *_KEY)
            .agg(F.min("_best").alias("_best"), F.sum("_n").alias("_n"))
        )
    return level.drop("_run")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal to each other. Of equal texts the row with the smallest identifier stays; null
    identifiers come after all others, and of rows that also repeat the identifier exactly one stays. ``keep_id`` is
    null only if no row of the group has an identifier. An empty input gives an empty result; other columns of the
    input are not read, so their names can't clash.
    """
    rows = cut(digest_runs(docs, id_col, text_col))
    groups = merge_tree(rows, rows.rdd.getNumPartitions(), fan_in).where("_n > 1")
    return rows.join(groups, list(_KEY), "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_best.id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("_best.tag") == F.col("_tag"), F.lit(True)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows are told apart by identifier and digest, nulls included; of rows that repeat both, one stays. Texts are exchanged
    once at most: only if such rows occur are they set aside and reduced in a second branch.
    """
    name = unused(docs, "_key")
    key = lambda sha: F.struct(F.col(id_col).alias("id"), sha.alias("sha"))
    flags = exact_duplicates(docs, id_col, text_col, fan_in).where(~F.col("kept"))
    dropped = cut(flags.select(key(F.col("text_sha256")).alias(name), F.col(id_col).eqNullSafe(F.col("keep_id")).alias("repeats")).distinct())
    gone, twice = dropped.where("NOT repeats").select(name), dropped.where("repeats").select(name)
    rows = docs.withColumn(name, key(F.sha2(normalised(F.col(text_col)), 256))).join(gone, name, "left_anti")
    if not twice.isEmpty():
        rows = rows.join(twice, name, "left_anti").unionByName(rows.join(twice, name, "left_semi").dropDuplicates([name]))
    return rows.select(*docs.columns)
