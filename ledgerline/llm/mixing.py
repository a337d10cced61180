"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic). Raking scales the cells' keep probabilities
so that the expected tokens of every source, language and topic meet their target shares of the
token budget; a probability never exceeds 1, so what a scarce margin lacks is left to the others of
the same sweep. Documents are then kept by a seeded hash of their id below the probability of their
cell, which is calibrated: the expected mixture is the raked one at any size.
"""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import columns_numbered, settled, text_or_empty

MARGINS = ("source", "lang", "topic")
#: Cells up to which raking runs on the driver and the result is broadcast; beyond, both stay in Spark.
MAX_CELLS = 100_000
#: Sweeps at most, the same on the driver and in Spark, so that the number of cells changes no result; raking that has not come to rest by then warns. Change of a probability at which it rests.
SWEEPS, TOLERANCE = 500, 1e-6
#: Share of all tokens to keep, and the power that flattens the corpus shares into targets.
BUDGET, FLATTEN = 0.7, 0.7


def topic_of(text: Column) -> Column:
    """A coarse topic from a document's form; null texts are ``empty``."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(t == "", "empty").when(F.contains(t, F.lit(" | ")), "table").when(t.rlike("[#*$%&]{3}"), "symbols").when(F.contains(t, F.lit("!! ")), "shouting")
        .when(F.length(t) < 1000, "short").when(F.length(t) < 5000, "medium").otherwise("long")
    )


def with_cells(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """id, source, lang, topic, n_tokens (words). Null sources and languages are margins of their own, ''."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("__id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        topic_of(text).alias("topic"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
    )


def flattened(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin: its token shares to the power, made to sum to 1."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).select(margin, F.pow(F.col("t").cast("double"), F.lit(power)).alias("p"))
    whole = sums.agg(F.sum("p")).first()[0] or 1.0
    return sums.select(margin, (F.col("p") / F.lit(whole)).alias("share"))


def rake(tokens: np.ndarray, groups: list[np.ndarray], targets: list[np.ndarray], start: float) -> np.ndarray:
    """Keep probabilities of cells: ``groups`` numbers each cell's value of a margin, ``targets`` has tokens by number."""
    p = np.full(len(tokens), start)
    for _ in range(SWEEPS):
        before = p.copy()
        for group, target in zip(groups, targets):
            now = np.bincount(group, p * tokens, len(target))
            p = np.minimum(1.0, p * np.divide(target, now, out=np.ones_like(target), where=now > 0)[group])
        if len(p) == 0 or np.abs(p - before).max() < TOLERANCE:
            return p
    warnings.warn(f"raking has not come to rest in {SWEEPS} sweeps", stacklevel=2)
    return p


def rake_in_spark(cells: DataFrame, targets: dict[str, DataFrame], start: float, total: float) -> DataFrame:
    """``rake`` for any number of cells: each sweep is a table of the shared folder."""
    state = cells.withColumn("p", F.lit(start))
    for sweep in range(SWEEPS):
        new = state.withColumnRenamed("p", "was").withColumn("p", F.col("was"))
        for margin, share in targets.items():
            now = new.groupBy(margin).agg(F.sum(F.col("p") * F.col("tokens")).alias("now")).join(share, margin)
            factor = now.select(margin, F.when(F.col("now") > 0, F.col("share") * total / F.col("now")).otherwise(F.lit(1.0)).alias("f"))
            new = new.join(factor, margin).withColumn("p", F.least(F.lit(1.0), F.col("p") * F.col("f"))).drop("f")
        new = settled(new, f"rake-{sweep}")
        state = new.drop("was")
        if new.filter(F.abs(F.col("p") - F.col("was")) >= TOLERANCE).isEmpty():
            return state
    warnings.warn(f"raking has not come to rest in {SWEEPS} sweeps", stacklevel=2)
    return state


def keep_probabilities(rows: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, power: float = FLATTEN, max_cells: int = MAX_CELLS) -> DataFrame:
    """Cells (source, lang, topic, tokens) with p. ``targets``: shares by margin and value; a margin
    without an entry takes its flattened corpus shares, a value without one gets nothing. Empty tables have no cells."""
    cells = settled(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "mixing-cells")
    total = budget * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    shares = {}
    for m in MARGINS:
        if targets and m in targets:
            given = [F.struct(F.lit(k).alias(m), F.lit(float(v)).alias("share")) for k, v in targets[m].items()]
            known = cells.sparkSession.range(1).select(F.inline(F.array(*given)))
            shares[m] = cells.select(m).distinct().join(known, m, "left").select(m, F.coalesce("share", F.lit(0.0)).alias("share"))
        else:
            shares[m] = flattened(cells, m, power)
    if cells.limit(max_cells + 1).count() > max_cells:
        return rake_in_spark(cells, shares, budget, total)
    table = cells.orderBy(*MARGINS).toPandas()
    groups, aims = [], []
    for m in MARGINS:
        share = {r[m]: r["share"] for r in shares[m].collect()}
        values = sorted(share)
        number = {v: i for i, v in enumerate(values)}
        groups.append(np.array([number[v] for v in table[m]], int))
        aims.append(np.array([share[v] * total for v in values], float))
    table["p"] = rake(table["tokens"].to_numpy(float), groups, aims, budget)
    schema = "source string, lang string, topic string, tokens bigint, p double"
    return F.broadcast(cells.sparkSession.createDataFrame(table, schema)) if len(table) else cells.withColumn("p", F.lit(budget))


def uniform(id_column: Column, seed: str) -> Column:
    """A number in [0, 1) from the seed and the id as text; null ids hash as ''."""
    h = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(id_column.cast("string"), F.lit(""))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, power: float = FLATTEN, seed: str = "mix-0", id_col: str = "doc_id", max_cells: int = MAX_CELLS, **columns: str) -> DataFrame:
    """One row per document: id, source, lang, topic, n_tokens, probability, kept.

    Null and empty texts have no tokens and the probability of their cell; null sources and languages are
    values of their own; repeated ids share one fate; other columns are not read. No row gives none.
    """
    rows = with_cells(docs, id_col, **columns)
    chosen = keep_probabilities(rows, targets, budget, power, max_cells).select(*MARGINS, "p")
    out = rows.join(chosen, list(MARGINS))
    return out.select(F.col("__id").alias(id_col), *MARGINS, "n_tokens", F.col("p").alias("probability"), (uniform(F.col("__id"), seed) < F.col("p")).alias("kept"))


def margin_report(documents: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, power: float = FLATTEN) -> DataFrame:
    """What the result of ``mixed`` comes to: margin, value, tokens, target, expected (by the probabilities), kept.

    As no probability exceeds 1, scarce values stay below their targets, and so does the sum; ``expected``
    says by how much, ``kept`` what the draw made of it.
    """
    kept = F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("kept")
    cells = settled(documents.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("probability") * F.col("n_tokens")).alias("expected"), kept), "mixing-report")
    total = budget * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    parts = []
    for m in MARGINS:
        share = flattened(cells, m, power)
        if targets and m in targets:
            given = F.create_map(*[F.lit(x) for k, v in targets[m].items() for x in (k, float(v))])
            share = share.select(m, F.coalesce(F.try_element_at(given, F.col(m)), F.lit(0.0)).alias("share"))
        sums = cells.groupBy(m).agg(F.sum("tokens").alias("tokens"), F.sum("expected").alias("expected"), F.sum("kept").alias("kept")).join(share, m)
        parts.append(sums.select(F.lit(m).alias("margin"), F.col(m).alias("value"), "tokens", (F.col("share") * total).alias("target"), "expected", "kept"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def sample_mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, power: float = FLATTEN, seed: str = "mix-0", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", max_cells: int = MAX_CELLS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names; text is read, never shuffled."""
    chosen = keep_probabilities(with_cells(docs, id_col, text_col, source_col, lang_col), targets, budget, power, max_cells)
    chosen = chosen.select(F.col("source").alias("__s"), F.col("lang").alias("__l"), F.col("topic").alias("__t"), F.col("p").alias("__p"))
    numbered, name = columns_numbered(docs)
    value = lambda c: F.coalesce(F.col(name[c]).cast("string"), F.lit(""))
    on = [value(source_col) == F.col("__s"), value(lang_col) == F.col("__l"), topic_of(value(text_col)) == F.col("__t")]
    kept = numbered.join(chosen, reduce(lambda a, b: a & b, on)).filter(uniform(F.col(name[id_col]), seed) < F.col("__p"))
    return kept.select(*numbered.columns).toDF(*docs.columns)
