"""Lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to the shared folder named by ``spark.checkpoint.dir``.

    The folder comes from the session.  Where none is set, a local master gets a temporary
    one, removed at exit; on a cluster that is an error, because executors cannot read
    each other's temporary folders.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="veilwork-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
