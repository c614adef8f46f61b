"""What several operators share: reading tables, cutting lineage, splitting words."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.session import remove, remove_at_exit, shared_folder

#: White space between words: the complement of ``[^\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset in a local session (tests); on a cluster that is an error."""
    return shared_folder(spark)


def _collect(spark: SparkSession) -> None:
    """Shuffle files go when their plans are garbage, so that long jobs don't pile them up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and checkpointed in the shared folder, so that losing executors loses nothing before it. It stays dealt as it was."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    out = df.checkpoint(eager=True)
    del df
    _collect(spark)
    return out


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame) -> DataFrame:
    """df, computed once and written as a table in the shared folder: smaller than a checkpoint, but no longer dealt by key. It goes when the program ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    schema, before = df.schema, spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # the write's shuffle files go with its end
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    del df
    remove_at_exit(spark, path)
    _collect(spark)
    out = spark.read.schema(schema).parquet(path)
    out._kept_at = path
    _KEPT.append(path)
    return out


_KEPT: list[str] = []


def release(df: DataFrame) -> None:
    """Deletes a table that keep made, and that nothing will read again."""
    path = df.__dict__.pop("_kept_at", None)
    if path:
        remove(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, in the end, the tables that keep makes inside, but for those that were kept last."""
    before = len(_KEPT)
    yield
    for path in _KEPT[before:-1]:
        remove(spark, path)
    del _KEPT[before:-1]


def redealt(key: Column) -> Column:
    """A long key, computed anew: an aggregate's frame then no longer counts as dealt by it, so a join deals both sides itself,
    and adaptive execution can split the partitions of a hot key. Under an aggregate it can't."""
    return key.bitwiseXOR(F.lit(0).cast("long"))


def spaced(text: Column, but: str = "") -> Column:
    """text with a space for each white space character; replace() scans bytes, where translate() looks up each character."""
    for c in SPACES[1:].replace(but, ""):
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(spaced(text), " "), "")
