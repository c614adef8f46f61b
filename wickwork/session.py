"""Session settings that the library counts on."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "wickwork", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per context, wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_wickwork_shipped", False):
        return
    root = Path(__file__).resolve().parent
    handle, path = tempfile.mkstemp(prefix="wickwork-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*")):
            if f.suffix in (".py", ".json"):
                z.write(f, f.relative_to(root.parent))
    context.addPyFile(path)
    context._wickwork_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a local session gets a temporary one (tests); a cluster gets an error."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or getattr(context, "_wickwork_shared", None)
    if not found:
        if not (context.master.startswith("local") and "cluster" not in context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="wickwork-")
        context._wickwork_shared = found
        remove_at_exit(spark, found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    atexit.register(remove, spark, path)
