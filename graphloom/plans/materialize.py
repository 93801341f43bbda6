"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def materialized(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of df, in the folder of spark.checkpoint.dir; a temporary one only on a single machine where that is unset."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not (sc.master.startswith("local") and "cluster" not in sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="graphloom-"))
    return df.checkpoint(eager=True)
