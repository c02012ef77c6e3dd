"""Manifest of raw files: digests and sizes, bulk folders rolled up, known facts carried forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders whose files are counted, not listed.
BULK = ("pages", "listings")


def _empty_files(spark: SparkSession, root: str) -> DataFrame:
    """Files without content, which Spark's binary reader passes over; found by listing the folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    found, rows = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True), []
    while found.hasNext():
        status = found.next()
        if status.getLen() == 0:
            rows.append((status.getPath().toString(),))
    return spark.createDataFrame(rows, "path string").select("path", F.lit(b"").alias("content"), F.lit(0).cast("bigint").alias("length"))


def digests(contents: DataFrame) -> DataFrame:
    """(path, sha256, bytes) of rows (path, content)."""
    return contents.select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("bytes"))


def files(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, bytes) of every file below a folder, hashed on the executors; the manifest itself is left out."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "content", "length")
    both = read.unionByName(_empty_files(spark, root))
    relative = F.regexp_replace("path", "^(?:[a-z0-9]+:)?/*" + root.split("://")[-1].strip("/").replace(".", "\\.") + "/", "")
    return digests(both.select(relative.alias("path"), "content")).where("path <> 'MANIFEST.json'")


def build(found: DataFrame, old: DataFrame | None, sources: DataFrame, today: str) -> DataFrame:
    """Manifest entries with ``changed``: whether a known file has another digest now.

    ``sources``: (folder, source_url, license) by the first part of a path; facts already recorded come first.
    """
    bulk = F.arrays_overlap(F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(1))), F.array(*map(F.lit, BULK))) & F.col("path").contains("/")
    single = found.where(~bulk).withColumn("files", F.lit(None).cast("bigint"))
    folders = (
        found.where(bulk)
        .groupBy(F.regexp_replace("path", "[^/]+$", "").alias("path"))
        .agg(F.lit(None).cast("string").alias("sha256"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
    )
    rows = single.unionByName(folders).withColumn("folder", F.split("path", "/")[0]).join(sources, "folder", "left")
    if old is None:
        known = rows.select("path").limit(0).selectExpr("path", *(f"cast(null as string) as old_{c}" for c in ("sha256", "source_url", "license", "fetched_at")))
    else:
        known = old.select("path", *(F.col(c).alias(f"old_{c}") for c in ("sha256", "source_url", "license", "fetched_at")))
    rows = rows.join(known, "path", "left")
    kept = lambda c, default: F.coalesce(f"old_{c}", default).alias(c)
    return rows.select(
        "path",
        "sha256",
        "files",
        "bytes",
        kept("source_url", F.coalesce("source_url", F.lit("UNKNOWN"))),
        kept("license", F.coalesce("license", F.lit("UNKNOWN"))),
        kept("fetched_at", F.lit(today)),
        F.coalesce(F.col("old_sha256") != F.col("sha256"), F.lit(False)).alias("changed"),
    )
