"""Four combinators that carry the rule operators: ordered decisions, capped sums, cascades, violation lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def first_match(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """The value of the first rule whose condition holds; a null condition does not."""
    if not rules:
        return _col(otherwise)
    chain = None
    for condition, value in rules:
        chain = F.when(condition, _col(value)) if chain is None else chain.when(condition, _col(value))
    return chain.otherwise(_col(otherwise))


def listed(rules: Sequence[tuple[Column, object]]) -> Column:
    """The values of all rules whose condition holds, in the order of the rules."""
    return F.array_compact(F.array(*[F.when(condition, _col(value)) for condition, value in rules])) if rules else F.array().cast("array<string>")


#: A list of violation codes is such a list of texts.
violations = listed


def active(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def weighted(flags: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Sum of the weights of the flags that hold."""
    return reduce(lambda a, b: a + b, [F.when(active(flags[k]), F.lit(float(w))).otherwise(F.lit(0.0)) for k, w in weights.items() if k in flags], F.lit(0.0))


def capped_score(flags: Mapping[str, Column], weights: Mapping[str, float], ceiling: float, reducers: Mapping[str, float] | None = None, caps: Sequence[tuple[Column, float]] = (), floors: Sequence[tuple[Column, float]] = (), clamp: float | None = 0.0) -> Column:
    """Positive sum up to ``ceiling``, then reducers, then the clamp, then caps, then floors."""
    score = F.least(weighted(flags, weights), F.lit(float(ceiling))) + weighted(flags, reducers or {})
    if clamp is not None:
        score = F.greatest(score, F.lit(float(clamp)))
    for condition, cap in caps:
        score = F.when(active(condition), F.least(score, F.lit(float(cap)))).otherwise(score)
    for condition, floor in floors:
        score = F.when(active(condition), F.greatest(score, F.lit(float(floor)))).otherwise(score)
    return score


def active_weights(flags: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Map of the flags that hold to their weights."""
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in weights]), F.array(*[F.when(active(flags[k]), F.lit(float(w))) for k, w in weights.items()]))
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def banded(score: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first lower bound that the score reaches."""
    return first_match([(score >= low, label) for low, label in bands], otherwise)


def rank_of(value: Column, order: Sequence[str]) -> Column:
    """Place in ``order`` from 0; -1 for any other value and null."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), value).cast("int") - 1, F.lit(-1))


def lower_of(a: Column, b, order: Sequence[str]) -> Column:
    return F.when(rank_of(a, order) <= rank_of(_col(b), order), a).otherwise(_col(b))


def cascade(level: Column, age: Column, limits: Mapping[str, int], order: Sequence[str], undated_ceiling: str, free_up_to: str) -> tuple[Column, Column]:
    """(level, reasons) after ageing: while an age is over the limit of its level it goes one step down,
    never below ``free_up_to``; without an age the level is at most ``undated_ceiling``."""
    free = list(order).index(free_up_to)
    steps, current = [], level
    for name in reversed([x for x in order if list(order).index(x) > free]):
        if name not in limits:
            continue
        below = order[list(order).index(name) - 1]
        down = (current == name) & (age > limits[name])
        steps.append(F.when(down, F.concat(F.lit("idade_"), age.cast("string"), F.lit(f"d_acima_de_{limits[name]}d_desce_de_{name}"))))
        current = F.when(down, F.lit(below)).otherwise(current)
    undated = lower_of(level, undated_ceiling, order)
    bound = rank_of(level, order) <= free
    result = F.when(bound, level).when(age.isNull(), undated).otherwise(current)
    reasons = F.when(bound, F.array().cast("array<string>")).when(age.isNull(), listed([(undated != level, f"data_desconhecida_teto_{undated_ceiling}")])).otherwise(F.array_compact(F.array(*steps)) if steps else F.array().cast("array<string>"))
    return result, reasons
