"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for an unset local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="cadastra-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that no other run uses. It is not created yet."""
    path = f"{scratch_root(spark)}/cadastra-{label}-{uuid.uuid4().hex}"
    if label not in LASTING:
        _made.append(path)
    return path


#: Labels of folders that may be needed by a later run: merged rows of an upsert that is not confirmed.
LASTING = ("upsert",)
_made: list[str] = []


def discard_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has asked for, and return how many there were.

    For the end of a job: frames that were staged cannot be read any more, so their results must have been
    written or collected.
    """
    conf, path_class = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    deleted = 0
    while _made:
        path = path_class(_made.pop())
        deleted += bool(path.getFileSystem(conf).delete(path, True))
    return deleted


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table: cuts lineage and survives lost executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
