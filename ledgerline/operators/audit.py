"""Change capture and audit: diffs of fields, protected fields, logs of changed decisions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.latest import latest_per_key


def field_diffs(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """keys, campo, antes, depois of every changed field (C1). A null that comes in changes nothing."""
    o = old.select(*keys, F.struct(*fields).alias("__o"))
    n = new.select(*keys, F.struct(*fields).alias("__n"))
    text = lambda side, f: F.col(f"{side}.{f}").cast("string")
    cells = F.array(*[F.struct(F.lit(f).alias("campo"), text("__o", f).alias("antes"), text("__n", f).alias("depois")) for f in fields])
    return o.join(n, list(keys)).select(*keys, F.explode(cells).alias("__c")).select(*keys, "__c.*").filter("depois is not null and not antes <=> depois")


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str], protected: Sequence[str] = ()) -> DataFrame:
    """The table after an upsert, with acao inserido, atualizado or inalterado.

    Nulls never overwrite; ``protected`` fields of a row that exists stay as people left them.
    """
    o = old.select(*keys, *[F.col(f).alias(f"__o_{f}") for f in fields], F.lit(1).alias("__o"))
    n = new.select(*keys, *[F.col(f).alias(f"__n_{f}") for f in fields], F.lit(1).alias("__n"))
    j = o.join(n, list(keys), "full")
    value = lambda f: F.when(F.col("__o").isNull(), F.col(f"__n_{f}")).otherwise(F.col(f"__o_{f}") if f in protected else F.coalesce(f"__n_{f}", f"__o_{f}"))
    changed = reduce(lambda a, b: a | b, [~value(f).eqNullSafe(F.col(f"__o_{f}")) for f in fields], F.lit(False))
    act = F.when(F.col("__o").isNull(), "inserido").when(F.col("__n").isNotNull() & changed, "atualizado").otherwise("inalterado")
    return j.select(*keys, *[value(f).alias(f) for f in fields], act.alias("acao"))


def changed_decisions(now: DataFrame, log: DataFrame, key: str, columns: Sequence[str], log_id: str) -> DataFrame:
    """Decisions that differ from the last one logged for their key, null-safe."""
    last = latest_per_key(log, [key], [F.col(log_id).desc()]).select(F.col(key).alias("__k"), F.struct(*columns).alias("__was"), F.lit(1).alias("__in"))
    j = now.join(last, F.col(key) == F.col("__k"), "left")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__was.{c}")) for c in columns])
    return j.filter(F.col("__in").isNull() | ~same).drop("__k", "__was", "__in")


def material_change(before: str, after: str, fields: Sequence[str]) -> Column:
    """Whether any of the fields of two structs differ, null-safe (C4)."""
    return reduce(lambda a, b: a | b, [~F.col(f"{before}.{f}").eqNullSafe(F.col(f"{after}.{f}")) for f in fields], F.lit(False))


def fingerprint(*columns: str | Column) -> Column:
    """Hash of a record's state."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def difference(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other has not."""
    return rows.join(other.select(key).distinct(), key, "left_anti")


def common(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Keys of both."""
    return rows.select(key).intersect(other.select(key))


def united(frames: Sequence[DataFrame]) -> DataFrame:
    """One table of several, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_of_each(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The row of least position of each key."""
    return latest_per_key(df, keys, [F.col(position).asc()])
