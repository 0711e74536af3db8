"""Cutting lineage in loops, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame) -> DataFrame:
    """checkpoint() in the folder that the session names in spark.checkpoint.dir; a temporary one only where a session of one process
    (local mode) names none."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quorumtext-"))
    return df.checkpoint()
