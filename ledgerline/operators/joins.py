"""Joins with their keys, sides and null rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.segments import scanned


def enriched(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Left joins of a fact with one-row-per-key dimensions, each pruned to its columns first.

    Sides are left to the planner: small ones are broadcast by their measured size only.
    """
    return reduce(lambda df, d: df.join(d[0].select(d[1], *d[2]), d[1], "left"), dimensions, fact)


def place_summary(links: DataFrame, places: DataFrame, key: str, place_key: str, name: str, state: str, wanted: str) -> DataFrame:
    """Per key its distinct place names, sorted and joined by '; ', and whether one lies in a state (A2)."""
    j = links.join(places, place_key, "left")
    return j.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(name)), "; ").alias("places"), F.bool_or(F.coalesce(F.upper(F.col(state)) == wanted.upper(), F.lit(False))).alias("in_state"))


def known_keys(tables: Sequence[tuple[DataFrame, Sequence[Column]]], key: str = "key") -> DataFrame:
    """Distinct keys in every form in which they are stored (J8): one column per form, blanks left out."""
    parts = [df.select(F.explode(F.array(*[c.cast("string") for c in forms])).alias(key)) for df, forms in tables]
    return reduce(lambda a, b: a.unionByName(b), parts).filter(F.trim(F.col(key)) != "").distinct()


def split_keys(df: DataFrame, column: str, sep: str = ";", key: str = "key") -> DataFrame:
    """Distinct keys of a column that lists several."""
    return df.select(F.explode(F.split(F.col(column), sep)).alias("__k")).select(F.trim("__k").alias(key)).filter(F.col(key) != "").distinct()


def not_processed(items: DataFrame, done: DataFrame, forms: Sequence[str], key: str = "key") -> DataFrame:
    """Items none of whose key forms is known."""
    return reduce(lambda df, f: df.join(done.select(F.col(key).alias(f"__{f}")), F.col(f) == F.col(f"__{f}"), "left_anti"), forms, items)


def only_known(items: DataFrame, known: DataFrame, column: str, key: str = "key") -> DataFrame:
    """Items whose key is known."""
    return items.join(known.select(F.col(key).alias(column)).distinct(), column, "left_semi")


def inventory_diff(today: DataFrame, before: DataFrame, key: str, hash_col: str) -> DataFrame:
    """today with status novo, alterado or identico against the inventory before (J9). Of repeated keys there the least hash counts."""
    old = before.groupBy(F.col(key).alias("__k")).agg(F.min(hash_col).alias("__h"))
    status = F.when(F.col("__k").isNull(), "novo").when(~F.col(hash_col).eqNullSafe(F.col("__h")), "alterado").otherwise("identico")
    return today.join(old, F.col(key) == F.col("__k"), "left").withColumn("status", status).drop("__k", "__h")


def antecedents(df: DataFrame, holder: str, item: str, day: str | None = None) -> DataFrame:
    """Per item the other items of the same holder, as a count and the smallest and largest.

    Holders are aggregated, and their least and greatest items taken aside for a second aggregation, which finds those next
    to them: a holder of very many items costs its rows, in as many tasks as they lie in, and not their square.
    """
    each = df.filter(F.col(holder).isNotNull() & F.col(item).isNotNull()).select(holder, item).distinct()
    ends = each.groupBy(F.col(holder).alias("__h")).agg(F.min(item).alias("__lo"), F.max(item).alias("__hi"), F.count("*").alias("__n")).filter("__n > 1")
    j = each.join(ends, F.col(holder) == F.col("__h"))
    inner = j.groupBy(F.col("__h").alias("__g")).agg(F.min(F.when(F.col(item) != F.col("__lo"), F.col(item))).alias("__lo2"), F.max(F.when(F.col(item) != F.col("__hi"), F.col(item))).alias("__hi2"))
    j = j.join(inner, F.col("__h") == F.col("__g"))
    other = lambda end, next_: F.when(F.col(item) != F.col(end), F.col(end)).otherwise(F.col(next_))
    return j.select(holder, item, (F.col("__n") - 1).alias("others"), other("__lo", "__lo2").alias("first_other"), other("__hi", "__hi2").alias("last_other"))


def antecedent_edges(df: DataFrame, item: str, criteria: Sequence[str], segment: Callable[[Column], Column] | None = None) -> DataFrame:
    """Edges origem -> relacionado with the criterion they share (J11): each item to the one before it of the
    same value, which links all of a value without pairing them; blank values link nothing. ``segment`` makes of an item the part
    of the order that it lies in (``segments.scanned``), so that a value of very many items is spread over many tasks."""
    parts = []
    for c in criteria:
        rows = df.filter(F.trim(F.col(c).cast("string")) != "").select(item, F.col(c).cast("string").alias("value")).distinct()
        if segment is None:
            rows = rows.withColumn("relacionado", F.lag(item).over(Window.partitionBy("value").orderBy(item)))
        else:
            rows = scanned(rows, ["value"], [item], segment(F.col(item)), previous={"relacionado": F.col(item)})
        parts.append(rows.select(F.col(item).alias("origem"), "relacionado", F.lit(c).alias("criterio"), "value").filter("relacionado is not null"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def shared_value_classes(df: DataFrame, item: str, criteria: Sequence[str]) -> DataFrame:
    """Items that share a value, without pairing them (J10, J11): item, criterio, value, class_id (the smallest
    item of the class) and links (how many others share the value). Blank values link nothing.

    Every link is between two members of one class. Classes are aggregated before the join back, so that a
    value of very many items costs its rows; adaptive execution splits a hot one.
    """
    rows = [df.filter(F.trim(F.col(c).cast("string")) != "").select(F.col(item).alias("item"), F.lit(c).alias("criterio"), F.col(c).cast("string").alias("value")) for c in criteria]
    each = reduce(lambda a, b: a.unionByName(b), rows).distinct()
    classes = each.groupBy("criterio", "value").agg(F.min("item").alias("class_id"), (F.count("*") - 1).alias("links")).filter("links > 0")
    return each.join(classes, ["criterio", "value"]).select("item", "criterio", "value", "class_id", "links")


def diagnosed(asked: DataFrame, stored: DataFrame, scores: DataFrame, known: DataFrame, key: str, process: str, current: str, seq: str) -> DataFrame:
    """Asked ids with the process that their current score row names, and what is missing (J19): nao_armazenado,
    sem_score_vigente, processo_desconhecido or ok. Of several current rows the last by ``seq`` counts."""
    now = scores.filter(F.col(current)).groupBy(key).agg(F.max_by(process, F.struct(seq, process)).alias(process))
    here = stored.select(F.col(key).alias("__stored")).distinct()
    named = known.select(F.col(process).alias("__known")).distinct()
    j = asked.join(here, F.col(key) == F.col("__stored"), "left").join(now.withColumnRenamed(key, "__key"), F.col("__stored") == F.col("__key"), "left").join(named, F.col(process) == F.col("__known"), "left")
    state = F.when(F.col("__stored").isNull(), "nao_armazenado").when(F.col(process).isNull(), "sem_score_vigente").when(F.col("__known").isNull(), "processo_desconhecido").otherwise("ok")
    return j.select(key, process, state.alias("situacao"))


def upserted_edges(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and new edges, one per key, the old one staying."""
    both = old.withColumn("__age", F.lit(0)).unionByName(new.withColumn("__age", F.lit(1)))
    return both.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy("__age", *[c for c in old.columns if c not in keys]))).filter("__rn = 1").drop("__rn", "__age")


def as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, since: str, values: Sequence[str], fact_id: Sequence[str], segment: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each fact with the newest version of its key at or before its time; null values if there is none.

    Facts and versions of a key are put into one order of time and the last version is carried forward:
    one shuffle and one sort, and no pair of a fact with the versions it does not use. ``segment`` makes of a time
    the part of the order that it lies in (``segments.scanned``), so that a hot key is spread over many tasks.
    """
    v = versions.select(F.col(key), F.col(since).alias("__t"), F.lit(0).alias("__fact"), F.struct(*values).alias("__v"))
    f = facts.withColumn("__t", F.col(at)).withColumn("__fact", F.lit(1))
    both = f.withColumn("__v", F.lit(None).cast(v.schema["__v"].dataType)).unionByName(v, allowMissingColumns=True)
    if segment is not None:
        carried = scanned(both, [key], ["__t", "__fact"], segment(F.col("__t")), known={"__v": F.col("__v")}).filter("__fact = 1")
        return carried.select(*facts.columns, *[F.col(f"__v.{x}").alias(x) for x in values])
    w = Window.partitionBy(key).orderBy("__t", "__fact").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).filter("__fact = 1")
    return carried.select(*facts.columns, *[F.col(f"__v.{x}").alias(x) for x in values])


def unmatched(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Children whose keys no parent has: the violations of an existence check."""
    return children.join(parents.select(*keys).distinct(), list(keys), "left_anti")


def rule_lookup(rows: DataFrame, rules: DataFrame, on: Sequence[str], null_safe: Sequence[str], version: str, values: Sequence[str], row_id: str) -> DataFrame:
    """Each row with the newest version of its rule; null matches null in ``null_safe`` columns."""
    keys = [*on, *null_safe]
    newest = rules.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(version).desc(), *values))).filter("__rn = 1").select(*[F.col(k).alias(f"__{k}") for k in keys], *values)
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in on] + [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in null_safe])
    return rows.join(newest, cond, "left").drop(*[f"__{k}" for k in keys])


def is_latest(proposals: DataFrame, versions: DataFrame, key: str, version: str) -> DataFrame:
    """Proposals with is_latest: whether they are made on the highest version of their key."""
    top = versions.groupBy(key).agg(F.max(version).alias("__top"))
    return proposals.join(top, key, "left").withColumn("is_latest", F.col(version).eqNullSafe(F.col("__top"))).drop("__top")


def matched_cases(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of both tables with presence: so_antigo, so_novo or ambos."""
    o, n = old.select(*keys).distinct().withColumn("__o", F.lit(1)), new.select(*keys).distinct().withColumn("__n", F.lit(1))
    return o.join(n, list(keys), "full").select(*keys, F.when(F.col("__n").isNull(), "so_antigo").when(F.col("__o").isNull(), "so_novo").otherwise("ambos").alias("presence"))
