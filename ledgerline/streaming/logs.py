"""Incremental forms over Structured Streaming: new inputs, states, deltas, counters, caps, late changes.

Streams run with ``availableNow`` and write Parquet to the shared folder, with their checkpoint beside it,
so that a run that was stopped goes on where it was. State is kept per key by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.shared import shared_path
from ledgerline.sources.scan import load_counts, scoped_load
from ledgerline.streaming.keyed import stepped


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str, per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a folder, each read once."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def run_to_table(stream: DataFrame, name: str, mode: str = "append", at: str | None = None) -> DataFrame:
    """Runs a stream to the end of what is there and reads the table it wrote.

    Complete results replace the table batch by batch; appended ones go through the exactly-once file sink. A stream
    that is run ``at`` the same path again goes on where it was, with its state.
    """
    spark, schema = stream.sparkSession, stream.schema
    base = at or shared_path(spark, name)
    out, marks = f"{base}/table", f"{base}/checkpoint"
    writer = stream.writeStream.option("checkpointLocation", marks).trigger(availableNow=True).outputMode(mode)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:
        query = writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def new_or_changed(stream: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Rows whose key and content hash were not seen before."""
    hashed = stream.withColumn("content_hash", F.sha2(F.to_json(F.struct(*content)), 256))
    return hashed.dropDuplicates([*keys, "content_hash"])


def stream_states(stream: DataFrame, key: str, seq: str, before: str, after: str, allowed: Sequence[tuple[str, str]], initial: str) -> DataFrame:
    """Each row with the state it was judged against and whether it was accepted.

    A row is accepted if it starts from its key's current state (a null ``before`` from any) and the pair is
    allowed; rejected rows leave the state as it is. Rows of a key are taken in the order of ``seq`` within a batch.
    """
    pairs = frozenset(allowed)

    def judge(state: tuple, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        current, states, accepted = state[0], [], []
        for b, a in zip(rows[before], rows[after]):
            ok = (b is None or b == current) and (current, a) in pairs
            states.append(current)
            accepted.append(ok)
            current = a if ok else current
        return (current,), pd.DataFrame({seq: rows[seq].to_numpy(), "state": states, "wanted": rows[after].to_numpy(), "accepted": accepted})

    text = lambda c: F.col(c).cast("string") if c in stream.columns else F.lit(None).cast("string")
    seq_kind = stream.schema[seq].dataType.simpleString()
    return stepped(stream.withColumns({before: text(before), after: text(after)}), key, seq, [before, after], judge, "state string", (initial,), f"{seq} {seq_kind}, state string, wanted string, accepted boolean")


def stream_deltas(stream: DataFrame, key: str, seq: str, mark: str) -> DataFrame:
    """A row for each change of a key's fingerprint against the one before (T3); the first counts as a change. Rows without a fingerprint say nothing."""

    def diff(state: tuple, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        marks = rows[mark].to_numpy(dtype=object)
        was = np.concatenate([np.array([state[0]], object), marks[:-1]])
        changed = marks != was
        out = pd.DataFrame({seq: rows[seq].to_numpy()[changed], "was": was[changed], "now": marks[changed]})
        return (marks[-1] if len(marks) else state[0],), out

    seq_kind = stream.schema[seq].dataType.simpleString()
    rows = stream.withColumn(mark, F.col(mark).cast("string")).dropna(subset=[mark])
    return stepped(rows, key, seq, [mark], diff, "last string", (None,), f"{seq} {seq_kind}, was string, now string")


def stream_cap(stream: DataFrame, key: str, seq: str, counts: Column, cap: int) -> DataFrame:
    """Counted rows with their number in the key and whether the cap admits them (T5)."""

    def admit(state: tuple, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        used = state[0] + np.arange(len(rows), dtype=np.int64)
        return (int(state[0] + len(rows)),), pd.DataFrame({seq: rows[seq].to_numpy(), "used_before": used, "admitted": used < cap})

    seq_kind = stream.schema[seq].dataType.simpleString()
    return stepped(stream.filter(counts), key, seq, [], admit, "used bigint", (0,), f"{seq} {seq_kind}, used_before bigint, admitted boolean")


def stream_counters(stream: DataFrame, group: str) -> DataFrame:
    """Running counters per group, for complete mode (T4)."""
    return stream.groupBy(group).agg(F.count("*").alias("n"))


def stream_load(stream: DataFrame, rules: Sequence[tuple[str, Column]], name: str, at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that no rule rejects, a row of counters per batch) of a stream, each row read once.

    Each batch is written under its number, with the counters that were observed while it was; a batch that is run again
    after a failure takes the place of its first run, so neither rows nor counts are doubled.
    """
    spark = stream.sparkSession
    base = at or shared_path(spark, name)

    def load(batch: DataFrame, number: int) -> None:
        kept, seen = scoped_load(batch, rules)
        kept.write.mode("overwrite").parquet(f"{base}/rows/batch={number}")
        load_counts(spark, seen).write.mode("overwrite").parquet(f"{base}/counts/batch={number}")

    stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(load).start().awaitTermination()
    rows = spark.read.schema(stream.schema).option("basePath", f"{base}/rows").parquet(f"{base}/rows/batch=*")
    return rows, spark.read.option("basePath", f"{base}/counts").parquet(f"{base}/counts/batch=*")


def late_changes(changes: DataFrame, versions: DataFrame, key: str, changed: str, made: str) -> DataFrame:
    """Changes, as a stream, that come after a version of their key was made (T6): a join with the table of versions.

    No change is dropped as late; ``withWatermark`` on the stream is the caller's choice.
    """
    last = versions.groupBy(key).agg(F.max(made).alias("made"))
    return changes.join(last, key).filter(F.col(changed) > F.col("made"))


def stale_versions(versions: DataFrame, changes: DataFrame, key: str, made: str, changed: str, id_col: str, horizon: str | None = None, delay: str | None = None) -> DataFrame:
    """Versions, as a stream, that a later change of their key makes stale (T6): key and id, each once.

    Both sides are streams, joined on the key and on time order. As it stands, no row is ever late and Spark keeps all
    of both sides. With ``horizon`` (how long after a version a change still counts) and ``delay`` (how late rows may
    come), both intervals, watermarks let Spark drop state that nothing can meet any more, and rows later than that.
    """
    v = versions.select(F.col(key).alias("__key"), F.col(id_col).alias("__id"), F.col(made).alias("__made"))
    c = changes.select(F.col(key).alias("__of"), F.col(changed).alias("__changed"))
    on = (F.col("__key") == F.col("__of")) & (F.col("__changed") > F.col("__made"))
    if horizon and delay:
        v, c = v.withWatermark("__made", delay), c.withWatermark("__changed", delay)
        on = on & (F.col("__changed") <= F.col("__made") + F.expr(f"INTERVAL {horizon}"))
        return v.join(c, on).select(F.col("__key").alias(key), F.col("__id").alias(id_col), "__made").dropDuplicatesWithinWatermark([key, id_col]).drop("__made")
    return v.join(c, on).select(F.col("__key").alias(key), F.col("__id").alias(id_col)).dropDuplicates([key, id_col])
