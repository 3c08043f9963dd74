"""Sending the package to the Python workers."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or what the context was given.

    Only a session whose executors are threads of this process (``local[...]``) may do without;
    on a cluster an unset folder is an error, never a folder of one machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.match(r"local(\[.*\])?$", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="sheafline-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder, which outlives any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sheafline-"), "sheafline.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _sent.add(sc.applicationId)
