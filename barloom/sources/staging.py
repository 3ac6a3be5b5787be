"""Tables written between steps that are read more than once, in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def delete_at_exit(path: str) -> None:
    """Delete a folder when this process ends: results that read it are of no use after it."""
    if not _written:
        atexit.register(_clear)
    _written.append(path)


def _clear() -> None:
    jvm = SparkContext._jvm
    for path in _written:
        try:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)
        except Exception:  # the JVM is gone: the folder is left to its owner
            return


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under spark.checkpoint.dir, deleted when this process ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
        own = tempfile.mkdtemp(prefix="barloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    delete_at_exit(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet under spark.checkpoint.dir and read back: computed once, and safe when executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
