"""Iterated joins: a table that a round has made is cut from its lineage in the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint in spark.checkpoint.dir; a folder of our own only in local mode, where none is set."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="statuta-")
            spark.conf.set("spark.checkpoint.dir", folder)
        context.setCheckpointDir(folder)
    return df.checkpoint()
