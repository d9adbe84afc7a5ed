"""Where jobs put intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in the cluster's shared ``spark.checkpoint.dir``.  Only a local
    session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.mkdtemp(prefix='carelake-')}/{purpose}"
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
