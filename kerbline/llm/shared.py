"""Tables and folders that every executor can reach."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder that is removed when Python ends;
    a cluster session without it is refused, as executors would not see each other's files.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="kerbline-llm-")
        atexit.register(shutil.rmtree, _local[app], True)
    return "file://" + _local[app]


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/kerbline-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once however often it
    is used, and safe from lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return reread(df.sparkSession, path, df.schema)


def reread(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that go to Python at once, at most: texts are long, and Spark's default is 10,000.
BATCH_ROWS = 500


def _tidy(run):
    """A task function that gives freed memory back when it ends: Python processes wait for the next
    task for a while, and then would hold it beside those that work."""

    @wraps(run)
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidy


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with small batches.  The session's batch size is lowered, never raised;
    the setting counts when the result is computed, so it stays."""
    settings = df.sparkSession.conf
    if not 0 < int(settings.get(ARROW_ROWS)) <= BATCH_ROWS:
        settings.set(ARROW_ROWS, str(BATCH_ROWS))
    return df.mapInArrow(_tidy(run), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stands for a null id where ids are compared: larger than every other id.
LAST_ID = 2**63 - 1


def known_id(column: str):
    """``column`` as a long that is never null; null ids count as larger than all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))
