"""Cutting lineage in the folder that all machines of the cluster share, and taking away what was written there."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Side tables of at most so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 2_000_000

_written: dict[str, SparkSession] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``.

    Only where that is unset and all of Spark is one process on this machine, as in tests, a temporary
    folder is made; on a cluster the setting is required, as executors share no local folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written as Parquet below the checkpoint folder and read again.

    What was written goes with :func:`release`, or when Python ends.
    """
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark)}/stored-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    _written[path] = spark
    back = spark.read.schema(frame.schema).parquet(path)
    back.stored_at = path
    return back


def release(*frames: DataFrame) -> None:
    """Deletes what :func:`stored` wrote for these frames; nothing may read them any more."""
    for frame in frames:
        spark = _written.pop(frame.stored_at, None)
        if spark is not None:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _release_all() -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        for path, spark in list(_written.items()):
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small_side(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, marked for broadcast if it has at most so many rows."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame
