"""The folder that all executors share, and tables in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Rows of a part of a table that lies by key, which a task sorts at once; and of one that is too small to be parted for the cores' sake.
PART, LEAST_PART = 1_000_000, 50_000
#: The setting by which the files of a shuffle go with the job that wrote them, and not with the driver's garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only where that is unset, below a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/ledgerline-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder. Rules with many steps are written before rows are chosen by
    their result: a filter that is pushed below them would repeat each step's expression in the next."""
    path = _noted(shared_path(df.sparkSession, name))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def laid(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` as a table of the shared folder whose rows lie by ``key``, in parts of a bounded size: what groups by the key
    reads a part in a task and shuffles nothing. Rows go to their parts as they are written, by column and compressed, which
    takes a fraction of what they take in a shuffle; sorted by key, so that keys take little."""
    spark, path, table = df.sparkSession, _noted(shared_path(df.sparkSession, name)), f"spark_catalog.default.ledgerline_{uuid.uuid4().hex}"
    n = df.count()
    parts = max(1, -(-n // PART), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_PART)))
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(parts, key).sortBy(key).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # only its name: what is written stays in its folder
    return found


def _noted(path: str) -> str:
    if (paths := _passing.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Tables that are written in this block go at its end, or when what the block gives is called, and shuffles go with the job
    that they are part of: for work whose result stands by then, so that its disk is free when the result is checked and read."""
    before, paths = spark.conf.get(_CLEAN, None), []
    token = _passing.set(paths)
    spark.conf.set(_CLEAN, "true")

    def gone() -> None:
        while paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at.getParent(), True)

    try:
        yield gone
    finally:
        _passing.reset(token)
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
        gone()
