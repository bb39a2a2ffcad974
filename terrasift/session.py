"""Session settings that several operators need."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none and its master is local (tests, a laptop) is a local folder made and
    used; on a cluster, executors would each write to their own disk, so a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="terrasift-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, removed by ``clear_scratch`` or when the driver's process ends."""
    path = f"{shared_folder(spark)}/{what}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    if not _MADE:
        atexit.register(_at_exit, spark)
    _MADE.append(path)
    return path


def _at_exit(spark: SparkSession) -> None:
    try:
        clear_scratch(spark)
    except Exception:  # the JVM is gone
        _MADE.clear()


def stored(df: DataFrame, what: str) -> DataFrame:
    """The frame written to and read from the shared folder: computed once, safe against lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_scratch(spark: SparkSession) -> None:
    """Removes what this process's operators wrote to the shared folder; results not yet stored elsewhere go with it."""
    while _MADE:
        remove(spark, _MADE.pop())


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once per context, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_terrasift_shipped", False):
        return
    home, held = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    target = f"{shared_folder(spark)}/terrasift-{uuid.uuid4().hex[:12]}.zip"
    p = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(held.getvalue()))
    out.close()
    sc.addPyFile(target)
    sc._terrasift_shipped = True


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package sent ahead."""

    @wraps(f)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return f(spark, folder)

    return run
