"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(rows: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder that the session names; a local session without one gets its own."""
    spark = rows.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return rows.checkpoint()
