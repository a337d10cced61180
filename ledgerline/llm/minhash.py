"""Near-duplicates by b-bit MinHash.

1. Each document's distinct 5-word shingles give 128 minima. Four minima at a time make a band key;
   the low 4 bits of all minima are packed into eight 64-bit words.
2. Documents of equal shingle sets are one class with a number of its own. Ids name documents in the
   answer and nothing else, so that an id which several texts share joins none of them.
3. Classes that share a band key are candidates. Similarity is estimated from the packed words by bit
   counts, corrected for chance agreement of low bits; only pairs far below the limit are let go.
4. Pairs left are confirmed on full sets: 100 * intersection >= 75 * union.

No bucket is ever expanded into all its pairs. First each class meets two leaders of each of its
buckets, the most central member (the one whose buckets hold most) and the smallest id; the three most
similar of them are confirmed, and connected components follow. Only members of *different* components
that still share a bucket are paired after that, and of them only pairs that their own shingles allow:
a link needs 7 * intersection >= 3 * (sum of sizes), and shingles that no other open document has cannot
be in an intersection. What is left is judged again inside the join: where the smaller set has under 64
shingles by the two sets themselves, else by an estimate from 2,048 one-bit minima, and leaves the join in
the smallest of its shared bands alone. So heavily edited members of a large group, which link with nobody,
cost a count and a few bit operations and not a comparison of sets with the group.

A pair at the limit of 0.75 shares none of the 32 bands with probability 6e-6. If both sets have at least 64
shingles, its second estimate falls below the margin with about 3e-7; smaller sets are never let go by an estimate.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import columns_numbered, in_arrow, settled
from ledgerline.llm.words import Words, parts

WORDS, LOW, HIGH = 5, 75, 100
BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
#: Five standard errors of an estimate from 128 minima below 0.75.
MARGIN = 0.55
#: Leaders that a class is confirmed against before cross-component pairs are looked for.
BEST = 3
#: One-bit minima of the second estimate, and its margin: five standard errors below 0.75.
FINE, FINE_MARGIN = 2048, 0.677
#: Pairs whose smaller set has fewer shingles than this are compared by their sets and never estimated;
#: a set that can link with such a one has at most MOST_FEW.
FEW = 64
MOST_FEW = (FEW - 1) * HIGH // LOW
BLOCK = 4096
#: Members of a bucket that one task pairs with the rest of it, on average.
LOAD_A_TASK = 2_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20240229)
_A = (_SEEDS.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _SEEDS.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)[:, None]
_FINE_A = (_SEEDS.integers(0, 1 << 32, FINE, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_FINE_B = _SEEDS.integers(0, 1 << 32, FINE, dtype=np.uint64).astype(np.uint32)[:, None]
_UPPER = bytes(range(65, 91))
_LOWERED = bytes.maketrans(_UPPER, _UPPER.lower())


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its 5-word shingles (of the whole sequence if it is shorter)."""
    words = Words([t.translate(_LOWERED) for t in texts])

    def of(w: np.ndarray, k: int) -> np.ndarray:
        h = np.full(max(len(w) - k + 1, 0), k, np.uint64)
        for j in range(k):
            h = (h ^ w[j : len(h) + j]) * _MIX
            h ^= h >> np.uint64(29)
        return h

    whole, edges = of(words.hash, WORDS), words.first.tolist()
    return [np.unique(whole[a : b - WORDS + 1]) if b - a >= WORDS else of(words.hash[a:b], b - a) if b > a else whole[:0] for a, b in zip(edges, edges[1:])]


def minima(found: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B, block: int = BLOCK) -> np.ndarray:
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), block):
        np.minimum(out, (a * x[None, at : at + block] + b).min(axis=1), out=out)
    return out


def avalanche(low: np.ndarray) -> np.ndarray:
    """Every bit of 32-bit numbers made to depend on all of them. The low bits of a * x + b depend on those of x
    alone, under every a and b; a bit kept of the minimum must not."""
    h = low ^ (low >> np.uint32(16))
    h = h * np.uint32(0x85EBCA6B)
    h = h ^ (h >> np.uint32(13))
    h = h * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 16 to a 64-bit word."""
    lanes = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, 64 // BITS)
    return (lanes << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.astype(np.uint64).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for j in range(ROWS):
        h = (h ^ rows[:, j]) * _MIX
        h ^= h >> np.uint64(31)
    return h.view(np.int64)


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __digest (of the text as it is), n (shingles), same (digest of the whole set), sig (packed low bits), bands. No more than n for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches, 1):
            n, same, sig, bands = [], [], [], []
            for found in shingle_sets(texts):
                n.append(len(found))
                if not len(found):
                    same.append(None)
                    sig.append(None)
                    bands.append(None)
                    continue
                low = minima(found)
                same.append(xxhash.xxh3_128_digest(found.tobytes()))
                sig.append(packed(low))
                bands.append(band_keys(low))
            made = [pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(sig, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *made], ["__id", "__digest", "n", "same", "sig", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), text_digest(text_col).alias("__digest"))
    return in_arrow(rows, run, "__id bigint, __digest string, n bigint, same binary, sig array<bigint>, bands array<bigint>")


def text_digest(text_col: str) -> Column:
    """What tells rows of one id apart."""
    return F.md5(F.col(text_col).cast("string"))


def estimate(a: str, b: str) -> Column:
    """Similarity by the share of equal low bits, less what chance gives: (share - 2^-b) / (1 - 2^-b)."""
    ones = F.lit(0x1111111111111111)
    unequal = []
    for k in range(MINIMA * BITS // 64):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        folded = reduce(lambda p, s: p.bitwiseOR(F.shiftrightunsigned(x, s)), range(1, BITS), x)
        unequal.append(F.bit_count(folded.bitwiseAND(ones)))
    share = 1 - reduce(lambda p, q: p + q, unequal) / F.lit(float(MINIMA))
    return (share - F.lit(2.0**-BITS)) / F.lit(1 - 2.0**-BITS)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the limit. ``sets``: __id, set (sorted 64-bit hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(HIGH * both >= LOW * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("__id").alias("a"), F.col("set").alias("x")), sets.select(F.col("__id").alias("b"), F.col("set").alias("y"))
    return in_arrow(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y"), run, "a bigint, b bigint")


def full_sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, set of each class. ``classes``: id (its number), least (id of a document of it), same (digest of its set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches, 1):
            found = [x.tobytes() for x in shingle_sets(texts)]
            # Other texts may have the same id: only those of the class itself count.
            own = pa.array([xxhash.xxh3_128_digest(x) == y.as_py() for x, y in zip(found, part.column(3))], pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(2), pa.array(found, pa.binary())], ["__id", "set"]).filter(own)

    rows = docs.select(F.col(id_col).cast("long").alias("least"), F.col(text_col).cast("string").alias("__text"))
    named = rows.join(classes.select("least", "id", "same"), "least").select("least", "__text", "id", "same")
    return in_arrow(named, run, "__id bigint, set binary").dropDuplicates(["__id"])


def own_shingles(sets: DataFrame) -> DataFrame:
    """id, own: how many of a document's shingles no other document of ``sets`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                ids = np.repeat(np.asarray(part.column(0)), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate(found), pa.int64())], ["id", "shingle"])

    rows = in_arrow(sets.select("__id", "set"), run, "id bigint, shingle bigint")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).filter("n = 1")
    return alone.groupBy("id").agg(F.count("*").alias("own"))


def fine_bits(found: np.ndarray) -> np.ndarray:
    """One bit of each of 2,048 minima, 64 to a word."""
    return np.packbits(avalanche(minima(found, _FINE_A, _FINE_B, 512)).astype(np.uint8) & 1).view(np.int64)


def fine_signatures(sets: DataFrame) -> DataFrame:
    """id, fine (bits of sets of at least ``FEW`` shingles), few (sets that may link with smaller ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            fine = [fine_bits(x) if len(x) >= FEW else None for x in found]
            few = [x.view(np.int64) if len(x) <= MOST_FEW else None for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fine, pa.list_(pa.int64())), pa.array(few, pa.list_(pa.int64()))], ["id", "fine", "few"])

    return in_arrow(sets.select("__id", "set"), run, "id bigint, fine array<bigint>, few array<bigint>")


def fine_estimate(a: str, b: str) -> Column:
    """Similarity by equal single bits, corrected for chance: 2 * share - 1."""
    unequal = reduce(lambda p, q: p + q, [F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(FINE // 64)])
    return 1 - unequal * F.lit(2.0 / FINE)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """__id, component: the smallest id reachable, for every id in ``edges`` (a, b).

    Each round takes the least label of an id's neighbours, then the label of that label, until none
    changes; labels live in tables of the shared folder, only the number of changes reaches the driver.
    """
    both = settled(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = settled(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("__id"), "label"), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("__id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels["__id"] == near["a"]).select("__id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("__id").alias("label"), F.col("label").alias("next"))
        labels = settled(least.join(jump, "label", "left").select("__id", "was", F.least("label", F.coalesce("next", "label")).alias("label")), f"{name}-{step}")
        if labels.filter("was <> label").isEmpty():
            return labels.select("__id", F.col("label").alias("component"))
        labels = labels.select("__id", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are lower-cased (A-Z) runs of bytes other than space and \\x09-\\x0D. Texts that are null or
    have no word form a component of their own. Ids must be integers; each row that repeats an id is judged by its own
    text; a null id is its own component (null, kept), as nothing could name it. Very long texts are hashed by pieces
    and compared whole. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    return judged(docs, id_col, text_col).select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: __id, __digest (of its text), n, component_id, kept."""
    found = settled(profiles(docs, id_col, text_col), "minhash-profiles")
    # Signature and bands follow from the set, so those of any member are those of the class. The table is written, so its numbers hold.
    first_of = [F.min("__id").alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")]
    grouped = found.filter("n > 0 and __id is not null").groupBy("same").agg(*first_of)
    classes = settled(grouped.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")
    buckets = classes.select("id", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = settled(buckets.join(sizes, "band"), "minhash-buckets")
    central = shared.groupBy("id").agg(F.sum("size").alias("central"))
    leaders = shared.join(central, "id").groupBy("band").agg(F.min("id").alias("low"), F.max_by("id", F.struct("central", -F.col("id"))).alias("hub"))
    signed = classes.select("id", "sig")

    def likely(pairs: DataFrame) -> DataFrame:
        one, two = signed.select(F.col("id").alias("a"), F.col("sig").alias("p")), signed.select(F.col("id").alias("b"), F.col("sig").alias("q"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", estimate("p", "q").alias("est")).filter(F.col("est") >= MARGIN)

    met = shared.join(leaders, "band").select("id", F.explode(F.array("low", "hub")).alias("end")).filter("id <> end").distinct()
    first = likely(met.select(F.col("id").alias("a"), F.col("end").alias("b")))
    best = first.groupBy("a").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("est", "b")))), 1, BEST).alias("best"))
    tried = best.select("a", F.explode("best.b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried = settled(tried, "minhash-tried")
    sets = settled(full_sets(docs, classes.join(shared.select("id").distinct(), "id", "left_semi"), id_col, text_col), "minhash-sets")
    edges = settled(confirmed(tried, sets), "minhash-links")
    labels = components(edges, "minhash-first")
    # Members of different components that share a bucket: whatever was not tried is tried now.
    marked = shared.select("id", "band").join(labels.withColumnRenamed("__id", "id"), "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    mixed = marked.groupBy("band").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c <> d").select("band")
    open_ = settled(marked.join(mixed, "band", "left_semi"), "minhash-open")
    open_ids = open_.select("id").distinct()
    own = own_shingles(sets.join(open_ids.withColumnRenamed("id", "__id"), "__id", "left_semi"))
    able = open_ids.join(classes.select("id", "n"), "id").join(own, "id", "left").select("id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most")).filter("4 * most >= 3 * n")
    able = settled(able, "minhash-able")
    fine = fine_signatures(sets.join(able.select(F.col("id").alias("__id")), "__id", "left_semi"))
    side = settled(open_.join(able.join(fine, "id").join(classes.select("id", "bands"), "id"), "id"), "minhash-sides")
    # In each bucket the members outside its largest component meet all others; two inside it need no comparison.
    shares = side.groupBy("band", "component").agg(F.count("*").alias("n")).groupBy("band")
    most_of = shares.agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("in_largest"))
    dealt = most_of.filter("all > in_largest").select("band", "largest", F.ceil((F.col("all") - F.col("in_largest")) / LOAD_A_TASK).cast("int").alias("salts"))
    side = side.join(dealt, "band").withColumn("inner", F.col("component") == F.col("largest"))
    one = side.filter("not inner").select("band", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.col("id").alias("a"), F.col("component").alias("c"), F.col("n").alias("m"), F.col("most").alias("f"), F.col("fine").alias("p"), F.col("few").alias("s"), F.col("bands").alias("x"))
    two = side.select("band", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("id").alias("b"), F.col("component").alias("d"), F.col("n").alias("k"), F.col("most").alias("g"), F.col("fine").alias("q"), F.col("few").alias("t"), F.col("bands").alias("y"), "inner")
    by_sets = (LOW + HIGH) * F.size(F.array_intersect("s", "t")) >= LOW * (F.col("m") + F.col("k"))
    near = F.when(F.least("m", "k") < FEW, by_sets).otherwise(fine_estimate("p", "q") >= FINE_MARGIN)
    close = (F.col("inner") | (F.col("a") < F.col("b"))) & (F.col("c") != F.col("d")) & (7 * F.least("f", "g") >= 3 * (F.col("m") + F.col("k"))) & near
    # A shared band of two components is a mixed bucket, so the smallest shared one is always among ``side``.
    once = F.array_min(F.array_intersect("x", "y")) == one["band"]
    met = one.join(two, (one["band"] == two["band"]) & (one["salt"] == two["salt"]) & close & once)
    across = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = settled(across.join(tried, ["a", "b"], "left_anti"), "minhash-rest")
    if not rest.isEmpty():
        labels = components(edges.union(settled(confirmed(rest, sets), "minhash-more")), "minhash-all")
    label_of = labels.withColumnRenamed("__id", "id")
    named = classes.select("same", "id", "least").join(label_of, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    out = found.select("__id", "__digest", "n", "same").join(named.join(least, "component").select("same", "component_id"), "same", "left")
    component = F.when((F.col("n") > 0) & F.col("__id").isNotNull(), F.col("component_id")).otherwise(F.col("__id"))
    return out.select("__id", "__digest", "n", component.alias("component_id"), F.col("__id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their component, with all their columns, whatever their names.

    Rows are told apart by id and text: of several texts under one id each stays or goes by itself. Rows without
    words and rows with a null id stay; rows that repeat id and text of a kept one stay too. An empty table stays empty.
    """
    numbered, name = columns_numbered(docs)
    keep = judged(docs, id_col, text_col).filter("kept").select(F.col("__id").alias("__kept_id"), F.col("__digest").alias("__kept_text")).distinct()
    same_row = F.col(name[id_col]).cast("long").eqNullSafe(F.col("__kept_id")) & text_digest(name[text_col]).eqNullSafe(F.col("__kept_text"))
    return numbered.join(keep, same_row, "left_semi").toDF(*docs.columns)
