"""Counters, totals and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consolidated(acts: DataFrame, key: str, member: Sequence[str], order: Sequence[str], keep: int | None = None) -> DataFrame:
    """Cases from acts (A1): key, size, first (the least member in ``order``), members in order.

    Members are kept with the case up to ``keep`` (None: all); ``size`` counts all. Cases that may be
    unbounded should keep few and leave the rest in the acts table, which has the key.
    """
    ordered = [*order, *[m for m in member if m not in order]]
    s = F.struct(*ordered)
    if keep is not None:
        rows = acts.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*ordered)))
        return rows.groupBy(key).agg(F.count("*").alias("size"), F.min(s).alias("first"), F.array_sort(F.collect_list(F.when(F.col("__rn") <= keep, s))).alias("members"))
    return acts.groupBy(key).agg(F.count("*").alias("size"), F.min(s).alias("first"), F.array_sort(F.collect_list(s)).alias("members"))


def any_flags(flags: Sequence[str]) -> list[Column]:
    """Whether any row of a group has each flag; nulls are false (A3)."""
    return [F.bool_or(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags]


def flags_or(df: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """Per key whether any row has each flag; nulls are false (A3)."""
    return df.groupBy(key).agg(*any_flags(flags))


def best_member(df: DataFrame, key: str, rank: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Per key the values of the row of greatest rank; ranks must be a total order (A4, A5)."""
    best = F.max_by(F.struct(*values), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]))
    return df.groupBy(key).agg(best.alias("__best")).select(key, *[F.col(f"__best.{v}").alias(v) for v in values])


def case_extent(df: DataFrame, key: str, process: str, place: str, day: str) -> DataFrame:
    """Per case its distinct processes and places and latest day."""
    return df.groupBy(key).agg(F.count_distinct(process).alias("processes"), F.count_distinct(place).alias("places"), F.max(day).alias("last_day"))


def run_counters(df: DataFrame, outcome: Column, outcomes: Sequence[str]) -> DataFrame:
    """One row of disjoint counters and whether they add up to the rows analysed."""
    t = df.select(outcome.alias("__o"))
    c = t.agg(F.count("*").alias("analysed"), *[F.count_if(F.col("__o") == o).alias(o) for o in outcomes])
    return c.withColumn("adds_up", F.col("analysed") == sum((F.col(o) for o in outcomes), F.lit(0)))


def dismissal_counts(df: DataFrame, reason: Column) -> DataFrame:
    """Rows per dismissal reason, ``elegivel`` for none, and the total."""
    return df.select(F.coalesce(reason, F.lit("elegivel")).alias("reason")).rollup("reason").agg(F.count("*").alias("n")).select(F.coalesce("reason", F.lit("total")).alias("reason"), "n")


def distribution_sets(df: DataFrame, group: str, value: str, overall: str = "TODOS") -> DataFrame:
    """Counts of a value per group and overall, in one pass."""
    g = df.cube(group, value).agg(F.count("*").alias("n"), F.grouping(group).alias("__g"), F.grouping(value).alias("__v"))
    return g.filter("__v = 0").select(F.when(F.col("__g") == 1, F.lit(overall)).otherwise(F.col(group)).alias(group), value, "n")


def transition_matrix(df: DataFrame, group: str, before: Column, after: Column) -> DataFrame:
    """Counts of before->after per group (A10)."""
    return df.select(group, F.concat(F.coalesce(before.cast("string"), F.lit("-")), F.lit("->"), F.coalesce(after.cast("string"), F.lit("-"))).alias("change")).groupBy(group, "change").agg(F.count("*").alias("n"))


def tag_groups(df: DataFrame, tags: str, sep: str = ";") -> DataFrame:
    """Rows per prefix (before ':') of their tags."""
    t = df.select(F.explode(F.split(F.col(tags), sep)).alias("t")).select(F.trim("t").alias("t")).filter("t <> ''")
    return t.select(F.split_part("t", F.lit(":"), F.lit(1)).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def call_totals(calls: DataFrame, key: str, status: str, event: str, cost: str, tokens: str, success: str = "sucesso") -> DataFrame:
    """Per run: calls, successes, failures, events served, tokens and cost of successes."""
    ok = F.col(status) == success
    return calls.groupBy(key).agg(
        F.count("*").alias("calls"), F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"), F.count_distinct(F.when(ok, F.col(event))).alias("events_served"),
        F.coalesce(F.sum(F.when(ok, F.col(tokens))), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.when(ok, F.col(cost))), F.lit(0.0)).alias("cost"),
    )


def kept_base(totals: DataFrame, base: str, current: str) -> DataFrame:
    """The base of totals set once and kept when they are computed again."""
    return totals.withColumn(base, F.coalesce(F.col(base), F.col(current)))


def evidence_quality(events: DataFrame, evidence: DataFrame, documents: DataFrame, key: str, excerpt: str, url: str) -> DataFrame:
    """Per event: 2 for each evidence with an excerpt, 1 for others, 1 per document, 1 for a url.

    Children are aggregated on their own before they meet, or each would multiply the other.
    """
    e = evidence.groupBy(key).agg(F.sum(F.when(F.coalesce(F.col(excerpt), F.lit("")) != "", 2).otherwise(1)).alias("__e"))
    d = documents.groupBy(key).agg(F.count("*").alias("__d"))
    q = F.coalesce("__e", F.lit(0)) + F.coalesce("__d", F.lit(0)) + F.when(F.coalesce(F.col(url), F.lit("")) != "", 1).otherwise(0)
    return events.join(e, key, "left").join(d, key, "left").withColumn("evidence_quality", q.cast("long")).drop("__e", "__d")


def last_material_change(checks: DataFrame, key: str, result: str, at: str, material: str = "mudanca_material") -> DataFrame:
    """Per key the last time of a material change."""
    return checks.filter(F.col(result) == material).groupBy(key).agg(F.max(at).alias("last_change"))


def calls_per_lot(calls: DataFrame, lot: str, event: str) -> DataFrame:
    """Calls per lot and the most of one event in it."""
    each = calls.groupBy(lot, event).agg(F.count("*").alias("__n"))
    return each.groupBy(lot).agg(F.sum("__n").alias("calls"), F.max("__n").alias("most_of_one_event"))


def consumption(calls: DataFrame, tenant: str, at: str, cost: str, now: Column) -> DataFrame:
    """Cost per tenant on the day and in the month of ``now``."""
    same = lambda unit: F.date_trunc(unit, F.col(at)) == F.date_trunc(unit, now)
    return calls.groupBy(tenant).agg(F.coalesce(F.sum(F.when(same("day"), F.col(cost))), F.lit(0.0)).alias("day_cost"), F.coalesce(F.sum(F.when(same("month"), F.col(cost))), F.lit(0.0)).alias("month_cost"))


def retries(jobs: DataFrame, keys: Sequence[str], at: str, status: str) -> DataFrame:
    """Attempts per key and the last status."""
    return jobs.groupBy(*keys).agg(F.count("*").alias("attempts"), F.max_by(status, F.struct(at, status)).alias("last_status"))
