"""Scratch space shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting: a temporary folder of this machine
    would be invisible to the executors of a real cluster.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="kerbline-")
    raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/kerbline-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table and read back.

    For a result that several branches of one plan need: every branch then reads the
    same rows, a lost executor costs no recomputation, and the optimizer gets real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
