"""Lineage cut through the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df written to the folder in spark.checkpoint.dir; only on a local master may that be unset: then a temporary folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        path = sc.getConf().get("spark.checkpoint.dir")
        if not path and sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="quillgraph-"))
    return df.checkpoint(eager=True)
