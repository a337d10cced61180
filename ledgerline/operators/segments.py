"""Ordered scans of hot keys in segments: row numbers, running sums, previous values, last known values.

A window over a key puts all its rows into one task. Here each key is cut into segments along its order, say by day or by
blocks of a sequence number. Windows run within a segment; what a segment passes on (rows, sums, its last value) is
one row of it, and the running totals and last values of those rows are carried into each segment by a join on the
same key as its windows, so that rows are shuffled once. A key of any size costs as many tasks as it has segments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scanned(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column, number: str | None = None, sums: Mapping[str, Column] | None = None, previous: Mapping[str, Column] | None = None, known: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``df`` with, per key and along ``order``: ``number`` (the row's place, from 1), ``sums`` (of the rows before it, nulls
    as 0; null where there is none), ``previous`` (the value of the row before it) and ``known`` (the last value, its
    own included, that is not null).

    ``segment`` must never fall along the order, and be null only where the first column of the order is. Nulls
    come first and null keys are a key. The order should be total, or equal rows may change places. Working columns are
    named __k, __seg and __s0, __s1, ...
    """
    sums, previous, known = dict(sums or {}), dict(previous or {}), dict(known or {})
    d = df.withColumn("__seg", segment).withColumn("__k", F.struct(*keys, "__seg"))
    cells = {f"__s{i}": v for i, v in enumerate([*sums.values(), *previous.values(), *known.values()])}
    d = d.withColumns(cells) if cells else d
    of_sum, of_previous, of_known = (list(zip(part, names)) for part, names in zip((sums, previous, known), _cut(list(cells), len(sums), len(previous), len(known))))
    w = Window.partitionBy("__k").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)
    own = {}
    if number:
        own["__number"] = F.row_number().over(w).cast("long")
    own |= {f"{c}_own": F.sum(F.coalesce(c, F.lit(0))).over(before) for _, c in of_sum}
    own |= {f"{c}_own": F.lag(F.struct(c)).over(w) for _, c in of_previous}
    own |= {f"{c}_own": F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for _, c in of_known}
    passed = [F.count("*").alias("__n")]
    passed += [F.sum(F.coalesce(c, F.lit(0))).alias(f"{c}_all") for _, c in of_sum]
    passed += [F.max_by(F.struct(c), place).alias(f"{c}_all") for _, c in of_previous]
    passed += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"{c}_all") for _, c in of_known]
    ends = d.groupBy("__k").agg(*passed)
    along = Window.partitionBy(*[F.col(f"__k.{k}") for k in keys]).orderBy("__k.__seg")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n")]
    carry += [F.sum(f"{c}_all").over(earlier).alias(f"{c}_in") for _, c in of_sum]
    carry += [F.lag(f"{c}_all").over(along).alias(f"{c}_in") for _, c in of_previous]
    carry += [F.last(f"{c}_all", ignorenulls=True).over(earlier).alias(f"{c}_in") for _, c in of_known]
    j = d.withColumns(own).join(ends.select("__k", *carry), "__k")
    out = {}
    if number:
        out[number] = F.col("__n") + F.col("__number")
    out |= {name: F.when(F.col(f"{c}_own").isNull(), F.col(f"{c}_in")).when(F.col(f"{c}_in").isNull(), F.col(f"{c}_own")).otherwise(F.col(f"{c}_own") + F.col(f"{c}_in")) for name, c in of_sum}
    out |= {name: F.coalesce(f"{c}_own", f"{c}_in")[c] for name, c in of_previous}
    out |= {name: F.coalesce(f"{c}_own", f"{c}_in") for name, c in of_known}
    return j.select(*[F.col(c) for c in df.columns if c not in out], *[v.alias(n) for n, v in out.items()])


def _cut(names: list[str], *sizes: int) -> list[list[str]]:
    out, at = [], 0
    for n in sizes:
        out.append(names[at : at + n])
        at += n
    return out


def blocks(seq: Column, size: int) -> Column:
    """Segments of a sequence number: as many numbers to each."""
    return F.floor(seq / size)
