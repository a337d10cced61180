"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of words (runs of letters, lower-cased, with blanks before
and after). Spark counts the n-grams of the training words; the discounted probabilities and the
interpolation weights go into arrays sorted by n-gram hash, searched by bisection. A document gets
the language of lowest cross-entropy per character. Scores are a softmax over the cross-entropies
whose sharpness is fitted on the training documents. A document is rejected when its best
cross-entropy lies further above the language's median, in units that widen for short texts, than
all but ``REJECT_RATE`` of that language's training documents lie, times ``SLACK``.

As words are scored apart from their neighbours, what stands between blanks is scored once per
task, and each n-gram once per worker: its bits in all languages go into an array sorted by hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, kept_by_worker, least_hashed, settled

#: n-gram order; training rows per language (a bounded sample of labelled rows: those of least hash).
ORDER, TRAIN_ROWS = 4, 2000
#: Share of a language's training documents that rejection may cost, and how far beyond them it begins.
REJECT_RATE, SLACK = 0.001, 2.0
#: A word's letters beyond so many are scored in pieces of this length, so that long runs stay whole.
PIECE = 64
#: Chunks and n-grams that a worker remembers, and numbers over all languages in either memory.
CHUNKS_KEPT, GRAMS_KEPT, BITS_KEPT = 200_000, 400_000, 4_000_000
#: Rows of an outgoing batch; characters of texts whose new chunks are scored at once.
ROWS_OUT, CHARS_AT_ONCE = 512, 1 << 20
LETTERS = regex.compile(r"\p{L}+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows of a matrix of code points."""
    h = np.full(len(codes), codes.shape[1], np.uint64)
    for k in range(codes.shape[1]):
        h = (h ^ codes[:, k].astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


def code_points(texts: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").reshape(len(texts), width)


@dataclass
class Table:
    """Sorted hashes and their values; ``of`` gives 0 or ``missing`` for the others."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], values[order].astype(np.float64))

    def of(self, keys: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


@dataclass
class CharModel:
    """Kneser-Ney model of one language, fitted on (gram, count) of the highest order."""

    order: int
    grams: list[Table] = field(default_factory=list)
    weights: list[Table] = field(default_factory=list)
    floor: float = 0.0

    @classmethod
    def fit(cls, grams: list[str], counts: list[int], order: int, alphabet: int) -> CharModel:
        model = cls(order, floor=1.0 / (alphabet + 1))
        codes, n = code_points(grams, order), np.asarray(counts, np.float64)
        for k in range(order, 0, -1):
            once, twice = float((n == 1).sum()), float((n == 2).sum())
            discount = min(0.95, max(0.1, once / (once + 2 * twice) if once + twice else 0.5))
            context = gram_hash(codes[:, :-1]) if k > 1 else np.zeros(len(codes), np.uint64)
            names, group = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(group, n, len(names)), np.bincount(group, minlength=len(names))
            model.grams.insert(0, Table.build(gram_hash(codes), (n - discount).clip(0) / total[group]))
            model.weights.insert(0, Table.build(names, discount * kinds / total))
            # One order down, an n-gram counts once for each letter that precedes it.
            if k > 1:
                _, first, counts_down = np.unique(gram_hash(codes[:, 1:]), return_index=True, return_counts=True)
                codes, n = codes[first, 1:], counts_down.astype(np.float64)
        return model

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """-log2 probability of the last character of each row given the others."""
        p = np.full(len(codes), self.floor)
        for k in range(1, self.order + 1):
            context = gram_hash(codes[:, self.order - k : -1]) if k > 1 else np.zeros(len(codes), np.uint64)
            p = self.grams[k - 1].of(gram_hash(codes[:, self.order - k :]), 0.0) + self.weights[k - 1].of(context, 1.0) * p
        return -np.log2(p)


@dataclass
class LanguageModel:
    """Models by language, and what calibration found: sharpness and rejection limits."""

    languages: list[str]
    models: list[CharModel]
    order: int
    sharpness: float = 1.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: np.ndarray | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, entropy: np.ndarray) -> np.ndarray:
        """Softmax over the rows of a matrix (documents, languages)."""
        z = np.exp(-self.sharpness * (entropy - entropy.min(axis=1, keepdims=True)))
        return z / z.sum(axis=1, keepdims=True)

    def excess(self, best: np.ndarray, entropy: np.ndarray, length: np.ndarray) -> np.ndarray:
        """How far documents lie above the usual cross-entropy of their language, in units that widen for short texts."""
        return (entropy - self.mean[best]) / (self.spread[best] + 1.0 / np.sqrt(np.maximum(length, 1)))

    def rejects(self, best: np.ndarray, entropy: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.excess(best, entropy, length) > self.limit[best]


class Scorer:
    """Cross-entropies of texts. ``keys`` are sorted hashes of n-grams seen before, ``known`` their bits by language;
    ``rows`` numbers chunks (what stands between blanks) in ``bits`` and ``length``."""

    def __init__(self, model: LanguageModel):
        n = max(len(model.languages), 1)
        self.model, self.chunks_kept, self.grams_kept = model, min(CHUNKS_KEPT, BITS_KEPT // n), min(GRAMS_KEPT, BITS_KEPT // n)
        self.keys, self.known = np.zeros(0, np.uint64), np.zeros((0, n))
        self.forget()

    def forget(self) -> None:
        """Lets go of the chunks; the n-grams stay."""
        self.rows: dict[str, int] = {}
        self.bits, self.length = np.zeros((1024, self.known.shape[1])), np.zeros(1024, np.int64)

    def gram_bits(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last character of each row in every language."""
        names = gram_hash(codes)
        at = np.minimum(np.searchsorted(self.keys, names), max(len(self.keys) - 1, 0))
        new = self.keys[at] != names if len(self.keys) else np.ones(len(names), bool)
        if new.any():
            fresh, first = np.unique(names[new], return_index=True)
            bits = np.stack([m.bits(codes[new][first]) for m in self.model.models], axis=1)
            if len(self.keys) + len(fresh) > self.grams_kept:
                again, first = np.unique(names, return_index=True)
                if len(again) > len(fresh):
                    fresh, bits = again, np.stack([m.bits(codes[first]) for m in self.model.models], axis=1)
                self.keys, self.known = fresh, bits
            else:
                order = np.argsort(keys := np.concatenate([self.keys, fresh]), kind="stable")
                self.keys, self.known = keys[order], np.concatenate([self.known, bits])[order]
            at = np.searchsorted(self.keys, names)
        return self.known[at]

    def word_bits(self, words: list[str]) -> np.ndarray:
        """Bits per word and language, shape (words, languages)."""
        order = self.model.order
        if not words:
            return np.zeros((0, self.known.shape[1]))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        if lengths.sum() > CHARS_AT_ONCE and len(words) > 1:
            half = len(words) // 2
            return np.concatenate([self.word_bits(words[:half]), self.word_bits(words[half:])])
        pad = " " * (order - 1)
        codes = np.frombuffer((pad + (" " + pad).join(words) + " ").encode("utf-32-le"), "<u4")
        cut = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        at = np.repeat((order - 1) * np.arange(len(words)), lengths) + np.arange(lengths.sum())
        return np.add.reduceat(self.gram_bits(codes[at[:, None] + np.arange(order)]), cut)

    def _learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.rows]
        if len(self.rows) + len(new) > self.chunks_kept:
            self.forget()
            new = list(chunks)
        n = len(self.rows)
        if n + len(new) > len(self.bits):
            more = n + len(new)
            self.bits = np.concatenate([self.bits[:n], np.zeros((more, self.bits.shape[1]))])
            self.length = np.concatenate([self.length[:n], np.zeros(more, np.int64)])
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            words = [LETTERS.findall(c) for c in map(str.lower, part)]
            flat = [w for own in words for w in own]
            if max(map(len, flat), default=0) > PIECE:
                words = [[w[i : i + PIECE] for w in own for i in range(0, len(w), PIECE)] for own in words]
                flat = [w for own in words for w in own]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            some = np.flatnonzero(counts)
            if len(some):
                first = (np.cumsum(counts) - counts)[some]
                self.bits[n + some] = np.add.reduceat(self.word_bits(flat), first)
                self.length[n + some] = np.add.reduceat(np.fromiter(map(len, flat), np.int64, len(flat)) + 1, first)
            self.rows.update(zip(part, range(n, n + len(part))))
            n += len(part)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per document and language, and characters scored; 0 of them without a letter."""
        entropy, length = np.zeros((len(texts), self.known.shape[1])), np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            chunks, chars, end = [], 0, at
            while end < len(texts) and (end == at or chars < CHARS_AT_ONCE):
                chunks.append(texts[end].split() if texts[end] and self.model.languages else [])
                chars += len(texts[end] or "")
                end += 1
            self._learn(set().union(*chunks))
            for k, own in enumerate(chunks, at):
                rows = np.fromiter(map(self.rows.__getitem__, own), np.int64, len(own))
                length[k] = self.length[rows].sum()
                if length[k]:
                    entropy[k] = self.bits[rows].sum(axis=0) / length[k]
            at = end
        return entropy, length


def _scored(rows: DataFrame, model: LanguageModel, extra: str, result) -> DataFrame:
    """mapInArrow over (__id, ..., __text): ``result`` gives the output columns of a batch's entropies."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = [x.split()[0] for x in extra.split(", ")]
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_by_worker(("language", shared.value.name), lambda: Scorer(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                columns = result(shared.value, *scorer.entropies(part.column(len(kept)).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *columns], [*kept, *names])
        scorer.forget()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return in_arrow(rows, run, f"{schema}, {extra}", keeps=True)


def learned(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", order: int = ORDER, rows_per_language: int = TRAIN_ROWS) -> LanguageModel:
    """A model of the languages in ``labelled``; rows with a null language or text count for nothing.

    Of each language the ``rows_per_language`` rows of least hash are used, whole. What reaches the
    driver is bounded by that sample: n-gram counts, and one entropy row per sampled document. There may be any
    number of languages, and none: such a model finds every text ``und``. Repeated rows count each.
    """
    named = labelled.select(F.col(id_col).cast("string").alias("__id"), F.col(lang_col).cast("string").alias("__lang"), F.col(text_col).cast("string").alias("__text"))
    known = named.filter("__lang is not null and __text is not null").withColumn("__h", F.xxhash64("__id"))
    sample = settled(least_hashed(known, "__lang", ["__id"], rows_per_language).select("__lang", "__text"), "language-sample")
    words = sample.select("__lang", F.explode(F.regexp_extract_all(F.lower("__text"), F.lit(r"(\p{L}+)"))).alias("w")).groupBy("__lang", "w").agg(F.count("*").alias("n"))
    pad = " " * (order - 1)
    padded = words.select("__lang", "n", F.concat(F.lit(pad), F.col("w"), F.lit(" ")).alias("p"))
    grams = padded.select("__lang", "n", F.explode(F.expr(f"transform(sequence(1, length(p) - {order - 1}), i -> substring(p, i, {order}))")).alias("g")).groupBy("__lang", "g").agg(F.sum("n").alias("n"))
    found = grams.toPandas().sort_values(["__lang", "g"])
    languages = sorted(found["__lang"].unique())
    if not languages:
        return LanguageModel([], [], order)
    alphabet = len(set("".join(found["g"])))
    model = LanguageModel(languages, [CharModel.fit(list(g["g"]), list(g["n"]), order, alphabet) for _, g in found.groupby("__lang", sort=True)], order)
    seen = _scored(sample.select("__lang", "__text"), model, "entropy array<double>, length bigint", lambda m, e, n: [pa.array(list(e), pa.list_(pa.float64())), pa.array(n, pa.int64())])
    calibrate(model, seen.filter("length > 0").toPandas())
    return model


def calibrate(model: LanguageModel, seen) -> None:
    """Sets sharpness by likelihood of the known languages, and each language's usual cross-entropy and rejection limit."""
    at = {x: i for i, x in enumerate(model.languages)}
    truth = np.array([at[x] for x in seen["__lang"]], int)
    entropy, length = np.array(seen["entropy"].tolist()).reshape(len(truth), len(at)), seen["length"].to_numpy()
    model.mean, model.spread, model.limit = np.full(len(at), np.inf), np.zeros(len(at)), np.zeros(len(at))
    for k in range(len(at)):
        own = truth == k
        if own.any():
            model.mean[k] = np.median(entropy[own, k])
            model.spread[k] = 1.4826 * np.median(np.abs(entropy[own, k] - model.mean[k])) + 0.02
            usual = np.sort(model.excess(truth[own], entropy[own, k], length[own]))
            model.limit[k] = SLACK * max(usual[len(usual) - 1 - int(REJECT_RATE * len(usual))], 1.0)

    def loss(sharpness: float) -> float:
        z = -sharpness * (entropy - entropy.min(axis=1, keepdims=True))
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth])) if len(z) else 0.0

    model.sharpness = min((0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=loss)


def _verdicts(m: LanguageModel, entropy: np.ndarray, length: np.ndarray) -> list[pa.Array]:
    some = length > 0
    best = entropy.argmin(axis=1) if len(entropy) and some.any() else np.zeros(len(length), np.int64)
    each = np.arange(len(best))
    low = entropy[each, best]
    score = np.where(some, m.scores(entropy)[each, best], 0.0) if some.any() else np.zeros(len(best))
    rejected = ~some | m.rejects(best, low, length) if some.any() else ~some
    return [pa.array([m.languages[b] if x else "und" for b, x in zip(best, some)], pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_()), pa.array(low, pa.float64(), mask=~some)]


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score, rejected, entropy.

    Null texts and texts without a letter are ``und``, score 0, rejected, entropy null. Others get the
    language of lowest cross-entropy (the first in alphabetical order of equals), rejected or not.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    return _scored(rows, model, "lang_pred string, score double, rejected boolean, entropy double", _verdicts).withColumnRenamed("__id", id_col)


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns; no shuffle."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).select("*", F.col(names[docs.columns.index(text_col)]).cast("string").alias("__text"))
    judged = _scored(rows, model, "__lang string, __score double, __rejected boolean, __entropy double", _verdicts)
    return judged.filter("not __rejected").select(*names).toDF(*docs.columns)


def held_out(id_col: str = "doc_id"):
    """Rows that training must not see: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
