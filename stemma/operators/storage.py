"""Where operators put intermediate rows that must not be computed twice."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that ``spark.checkpoint.dir`` names; a temporary one only in local sessions."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="stemma-"))
    return df.checkpoint(eager=True)
