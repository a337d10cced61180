"""Latest row per key, version chains and states: one window each, always with a total order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.segments import scanned


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in ``order`` (W1-W3, W11, W12). ``rank`` names a column for the place, from 1."""
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def ranked_in_parts(df: DataFrame, per: Sequence[str], leading: Sequence[tuple[Column, bool]], rest: Sequence[Column], rank: str) -> DataFrame:
    """``df`` with its place, from 1, within ``per`` by the ``leading`` keys (value, whether it descends), then ``rest``.

    For few groups of very many rows: rows are counted by their leading keys, the running totals of these counts are
    the offsets, and only rows with equal leading keys are ranked together, so no task sorts a whole group.
    """
    names = [f"__k{i}" for i in range(len(leading))]
    d = df.withColumns({n: v for n, (v, _) in zip(names, leading)})
    order = [F.col(n).desc() if down else F.col(n).asc() for n, (_, down) in zip(names, leading)]
    counts = d.groupBy(*per, *names).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*per).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    keys = [*per, *names]
    offsets = counts.select(*[F.col(k).alias(f"__at_{k}") for k in keys], F.coalesce(before, F.lit(0)).alias("__before"))
    inside = d.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*rest)))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__at_{k}")) for k in keys])
    return inside.join(offsets, on).withColumn(rank, (F.col("__before") + F.col("__rn")).cast("int")).select(*df.columns, rank)


def currently_valid(links: DataFrame, key: str, start: str, end: str, tie: str) -> DataFrame:
    """Per key the open link (end blank or null) of latest start, compared as text; a null start wins."""
    open_ = links.filter(F.coalesce(F.trim(F.col(end).cast("string")), F.lit("")) == "")
    return latest_per_key(open_, [key], [F.col(start).cast("string").desc_nulls_first(), F.col(tie).asc_nulls_last()])


def current_score(scores: DataFrame, event: str = "event_id", current: str = "vigente", created: str = "created_at", tie: str = "id") -> DataFrame:
    """Per event the score row that counts: current first, then newest, nulls last."""
    return latest_per_key(scores, [event], [F.col(current).desc_nulls_last(), F.col(created).desc_nulls_last(), F.col(tie).desc()])


def state_of_key(log: DataFrame, key: str, seq: str, state: str, since: str) -> DataFrame:
    """Per key the last state, its time and the number of rows (W8): one aggregation, no sort."""
    last = F.max_by(F.struct(F.col(state).alias("state"), F.col(since).alias("since")), F.col(seq))
    return log.groupBy(key).agg(last.alias("__last"), F.count("*").alias("steps")).select(key, F.col("__last.state").alias("state"), F.col("__last.since").alias("since"), "steps")


def continuity(log: DataFrame, key: str, seq: str, before: str, after: str, initial: str, segment: Column | None = None) -> DataFrame:
    """``log`` with expected (the state the previous row led to) and continuous (whether it is the row's own before).

    Where one key may hold a large share of all rows, ``segment`` (see ``segments.scanned``) spreads it.
    """
    if segment is None:
        d = log.withColumn("expected", F.lag(after, 1, initial).over(Window.partitionBy(key).orderBy(seq)))
    else:
        # A row's null after is a value like any other; only a key's first row has none before it.
        d = scanned(log, [key], [seq], segment, number="__nth", previous={"expected": F.col(after)})
        d = d.withColumn("expected", F.when(F.col("__nth") == 1, F.lit(initial)).otherwise(F.col("expected"))).drop("__nth")
    return d.withColumn("continuous", F.col(before).eqNullSafe(F.col("expected")))


def version_chain(df: DataFrame, key: str, order: Sequence[str], id_col: str, segment: Column | None = None) -> DataFrame:
    """version (from 1) and previous (id of the version before) per key (W10); ``segment`` spreads hot keys."""
    if segment is not None:
        return scanned(df, [key], order, segment, number="version", previous={"previous": F.col(id_col)}).withColumn("version", F.col("version").cast("int"))
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("version", F.row_number().over(w)).withColumn("previous", F.lag(id_col).over(w))


def newest_flag(df: DataFrame, key: str, version: str) -> DataFrame:
    """is_newest: whether a row has its key's highest version."""
    return df.withColumn("is_newest", F.col(version) == F.max(version).over(Window.partitionBy(key)))


def running_cap(log: DataFrame, key: str, seq: str, counts: Column, cap: int, base: Column | None = None, segment: Column | None = None) -> DataFrame:
    """Rows with used_before (counted rows earlier in the key, plus ``base``) and admitted: it counts and there is room (W7);
    ``segment`` spreads hot keys."""
    one = F.when(counts, 1).otherwise(0)
    if segment is None:
        d = log.withColumn("used_before", F.sum(one).over(Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)))
    else:
        d = scanned(log, [key], [seq], segment, sums={"used_before": one})
    used = F.coalesce("used_before", F.lit(0)) + (F.lit(0) if base is None else base)
    return d.withColumn("used_before", used.cast("long")).withColumn("admitted", ~counts | (F.col("used_before") < cap))


def changed_after(versions: DataFrame, changes: DataFrame, key: str, made: str, changed: str, id_col: str) -> DataFrame:
    """Versions with stale: whether their key has a change later than they were made (W14). One maximum per key, no fan-out."""
    last = changes.groupBy(key).agg(F.max(changed).alias("__changed"))
    return versions.join(last, key, "left").withColumn("stale", F.coalesce(F.col("__changed") > F.col(made), F.lit(False))).drop("__changed")


def rotated_versions(log: DataFrame, keys: Sequence[str], order: Sequence[str], signature: Sequence[str]) -> DataFrame:
    """Version rotation that skips repeats: rows that differ from the one before in ``signature``, with
    version and is_current (V1)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    sign = F.struct(*signature)
    changed = log.withColumn("__before", F.lag(sign).over(w)).filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(sign)).drop("__before")
    return changed.withColumn("version", F.row_number().over(w)).withColumn("is_current", F.lead(F.lit(1)).over(w).isNull())


def all_versions(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rotation without skipping: every row a version, the last one current (V2)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return log.withColumn("version", F.row_number().over(w)).withColumn("is_current", F.lead(F.lit(1)).over(w).isNull())


def current_parameters(versions: DataFrame, created: str, tie: str) -> DataFrame:
    """All parameter versions with is_current for exactly one, the newest, then the greatest ``tie``, which tells them apart (V5)."""
    newest = versions.agg(F.max(F.struct(created, tie)).alias("__newest"))  # one row
    return versions.crossJoin(F.broadcast(newest)).withColumn("is_current", F.struct(created, tie) == F.col("__newest")).drop("__newest")


def relabelled(df: DataFrame, column: str, when: Column, to: str) -> DataFrame:
    """One column set anew where a condition holds (V6)."""
    return df.withColumn(column, F.when(when, F.lit(to)).otherwise(F.col(column)))


def migrated_ids(rows: DataFrame, mapping: DataFrame, id_col: str, old: str, new: str) -> DataFrame:
    """Provisional ids replaced by real ones with an outcome (V4): ``migrado`` where the real id was free,
    ``conflito`` where a row has it already or a smaller provisional id of the rows is to become it too (the
    id stays), ``mantido`` where nothing is mapped. Of several real ids for one provisional id the least counts."""
    taken = rows.select(F.col(id_col).alias("__taken")).distinct()
    m = mapping.groupBy(F.col(old).alias("__old")).agg(F.min(new).alias("__new"))
    claims = m.join(taken.withColumnRenamed("__taken", "__old"), "__old", "left_semi").groupBy(F.col("__new").alias("__claimed")).agg(F.min("__old").alias("__first"))
    j = rows.join(m, F.col(id_col) == F.col("__old"), "left").join(taken, F.col("__new") == F.col("__taken"), "left").join(claims, F.col("__new") == F.col("__claimed"), "left")
    outcome = F.when(F.col("__new").isNull(), "mantido").when(F.col("__taken").isNotNull() | (F.col("__first") != F.col("__old")), "conflito").otherwise("migrado")
    return j.withColumn("outcome", outcome).withColumn(id_col, F.when(F.col("outcome") == "migrado", F.col("__new")).otherwise(F.col(id_col))).drop("__old", "__new", "__taken", "__claimed", "__first")
