"""What several operators of this subpackage share: shared scratch tables and text columns."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The setting that bounds Arrow batches, and its value where the session has none of its own.
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
#: Bits of a row's hash by which sampling counts rows, coarse and fine.
COARSE, FINE = 8, 12


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests, a single machine) a temporary folder takes its place.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table of its own in the shared folder and read again.

    Lineage ends here, so a lost executor never makes earlier stages run again.
    """
    return settled_at(df, name)[0]


def settled_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``settled`` with the place of the table, for ``removed`` once a later table has taken its part."""
    path = f"{shared_dir(df.sparkSession)}/ledgerline-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table that ``settled_at`` wrote and nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at.getParent(), True)


#: What this Python worker keeps between tasks, by name.
_kept: dict[object, object] = {}


#: glibc's way to give freed memory back to the system; other systems do without.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def let_go() -> None:
    """Forgets what this worker keeps, and gives its memory back."""
    _kept.clear()
    gc.collect()
    if _trim:
        _trim(0)


def kept_by_worker(name: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a Python worker. It keeps one thing at a time, so that the models of
    operators that follow one another in it do not add up."""
    if name not in _kept:
        let_go()
        _kept[name] = make()
    return _kept[name]


def in_arrow(rows: DataFrame, run: Callable[[Iterator], Iterator], schema: str, keeps: bool = False) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` on batches of a few megabytes.

    Batches are bounded by the session's setting. Where that still has Spark's own 64 MB, of which a task
    holds several copies in and out of Python, it is set to ``BATCH_BYTES`` for the session. Unless ``run``
    itself ``keeps`` something between tasks, whatever the worker kept before is let go first. Workers wait for
    further tasks, so each gives back at its end what it no longer needs.
    """
    if rows.sparkSession.conf.get(_BATCH) in ("64m", "64MB", "67108864", "67108864b"):
        rows.sparkSession.conf.set(_BATCH, BATCH_BYTES)

    def tidy(batches: Iterator) -> Iterator:
        if _kept and not keeps:
            let_go()
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(tidy, schema)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character left alone.

    Texts of one byte per character take the fast built-in; others go through ``translate``.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def text_or_empty(column: str = "text") -> Column:
    """The text column as a string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def least_hashed(rows: DataFrame, group: str, ties: list[str], most: int) -> DataFrame:
    """Of each value of ``group`` (a string column of few values) the ``most`` rows of least __h, then ``ties``.

    Rows are counted by the first bits of the hash, then, where the limit falls, by the next ones, so
    that only about ``most`` rows of a group are ever ranked, whatever share of the table it has. The
    driver sees 256 counts and then 4,096 for a value. Null groups have no rows; fewer rows are all taken.
    """
    first, second = F.shiftrightunsigned("__h", 64 - COARSE), F.shiftrightunsigned("__h", 64 - COARSE - FINE)

    def limits(counts: DataFrame, before: dict[str, int]) -> dict[str, tuple[int, int]]:
        """By group the bucket in which its limit falls, and the rows before that bucket."""
        out, total = {}, dict(before)
        for r in counts.orderBy("g", "b").collect():
            if r["g"] not in out or out[r["g"]][1] + out[r["g"]][2] < most:
                out[r["g"]] = (r["b"], total.get(r["g"], 0), r["n"])
                total[r["g"]] = total.get(r["g"], 0) + r["n"]
        return {k: (b, n) for k, (b, n, _) in out.items()}

    def within(df: DataFrame, found: dict[str, tuple[int, int]], test: Callable[[Column], Column]) -> DataFrame:
        """Rows whose bucket passes the test against their group's."""
        if len(found) == 1:
            ((value, (bucket, _)),) = found.items()
            return df.filter((F.col(group) == value) & test(F.lit(bucket)))
        limits_of = rows.sparkSession.createDataFrame([(k, b) for k, (b, _) in found.items()], f"{group} string, __bucket bigint")
        return df.join(F.broadcast(limits_of), group).filter(test(F.col("__bucket"))).drop("__bucket")

    count = F.count("*").alias("n")
    known = rows.filter(F.col(group).isNotNull())
    coarse = limits(known.groupBy(F.col(group).alias("g"), first.alias("b")).agg(count), {})
    if not coarse:
        return rows.limit(0)
    inside = within(known, coarse, lambda b: first == b)
    fine = limits(inside.groupBy(F.col(group).alias("g"), second.alias("b")).agg(count), {k: n for k, (_, n) in coarse.items()})
    near = within(known, fine, lambda b: second <= b)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.shiftrightunsigned("__h", 1), "__h", *ties))
    return near.withColumn("__rank", rank).filter(F.col("__rank") <= most).repartition("__rank").select(*rows.columns)


def columns_numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns __c0, __c1, ..., which clash with no working column, and the new name of each (the first of equal ones)."""
    names = [f"__c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(reversed([*zip(df.columns, names)]))
