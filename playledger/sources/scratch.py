"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Of a row group of held rows: what a task gathers before it writes, and the least that a task reads.
_HELD_BYTES = 32 << 20


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="playledger-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the one that the cluster sets in ``spark.checkpoint.dir``.

    Only a local session may lack the setting; it then gets a temporary folder, which goes when Python ends.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def held(rows: DataFrame, folder: str) -> DataFrame:
    """The rows, written once to the shared folder, in place of what it holds, and read from there.

    A cached task's rows are one block, which grows with a file that cannot be split, and is gone with its executor. Files are
    written as the rows come, and a reader opens the columns that it needs.
    """
    rows.write.mode("overwrite").option("parquet.block.size", _HELD_BYTES).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes the folder, if there is one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
