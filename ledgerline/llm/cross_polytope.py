"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

1. Vectors of equal direction are one class. A class is hashed by 10 tables of 3 functions: three rounds of random signs
   and a Hadamard transform, then the nearest vertex of the cross-polytope, which is the place and sign of the largest
   coordinate. Its key of a table is its *base*; the keys reached by the cheapest changes of vertices are its *probes*.
   128 sign bits of further rotations are its sketch.
2. Large groups of close vectors are gathered before anything is paired. In each bucket the member whose buckets hold
   most is the hub; a class joins the best hub within the limit. Members within half the limiting angle of their
   group's mean direction are a *ball*: any two of them are linked, by the triangle inequality, and never compared.
   Every other class is a ball of itself.
3. Balls that share a key, as the base of one and base or probe of the other, are candidates; the join lets
   go those whose sketches are more than five standard errors too far apart, so few unlike pairs leave it.
4. Candidates are verified with their vectors in double precision. Where the centres and radii prove that all members are
   linked, or none, that is all; else members meet the other ball's centre, and only where that leaves it open the
   other ball's members.
5. Links of a vector are counted from sizes, so copies are never expanded into pairs. Components are those of balls.

Recall: a pair at exactly 0.95 shares a bucket with probability about 0.99, one at 0.96 or closer with more than 0.999 (measured over random
pairs of 64 components, see the tests); within a ball and where a ball stands for its members nothing is missed. A group of
very many vectors that are linked but lie further apart than half the angle is counted pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, settled
from ledgerline.llm.minhash import components
from ledgerline.llm.vectors import by_length

LIMIT = 0.95
TABLES, FUNCTIONS, PROBES = 10, 3, 4
#: Vectors are padded to a power of two, this at least, so that rotations differ enough.
LEAST_DIM = 64
SKETCH = 128
#: Standard errors that a sketch may be off.
ERRORS = 5
#: Room for rounding in angles; cosines themselves decide wherever angles come that close.
SLACK = 1e-6
ROWS_AT_ONCE = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are not zero, and those rows divided by their length; the largest component is made 1 first, so that no square overflows or vanishes."""
    most = np.abs(x).max(axis=1)
    some = most > 0
    y = x[some] / most[some, None]
    return some, y / np.sqrt((y * y).sum(axis=1))[:, None]


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform of the last axis, whose length is a power of two, scaled to keep lengths."""
    n = x.shape[-1]
    h = 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        h *= 2
    return x * np.float32(1 / math.sqrt(n))


class Rotations:
    """The random rotations for vectors of one length, the same on every worker."""

    def __init__(self, dim: int):
        self.dim, self.width = dim, max(LEAST_DIM, 1 << (dim - 1).bit_length())
        rng = np.random.default_rng(20240607)
        self.extra = -(-SKETCH // self.width)
        signs = rng.integers(0, 2, (3, TABLES * FUNCTIONS + self.extra, self.width)).astype(np.float32)
        self.signs = 2 * signs - 1

    def turned(self, u: np.ndarray) -> np.ndarray:
        x = np.zeros((len(u), self.width), np.float32)
        x[:, : self.dim] = u
        y = np.broadcast_to(x[:, None, :], (len(u), *self.signs.shape[1:]))
        for s in self.signs:
            y = hadamard(y * s)
        return y

    def hashed(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Base keys (n, tables), probe keys (n, tables * probes) and sketches (n, words) of unit vectors."""
        y = self.turned(u)
        n, last = len(u), TABLES * FUNCTIONS
        bits = (y[:, last:].reshape(n, -1)[:, :SKETCH] > 0).astype(np.uint8)
        sketch = np.packbits(bits, axis=1).view(np.int64)
        size = np.abs(y[:, :last])
        places = np.argpartition(-size, 2, axis=2)[:, :, :3]
        values = np.take_along_axis(size, places, axis=2)
        order = np.argsort(-values, axis=2, kind="stable")
        places, values = np.take_along_axis(places, order, axis=2), np.take_along_axis(values, order, axis=2)
        negative = np.take_along_axis(y[:, :last], places, axis=2) < 0
        vertex = (2 * places + negative).astype(np.uint64).reshape(n, TABLES, FUNCTIONS, 3)
        cost = ((values[:, :, :1] - values) ** 2).reshape(n, TABLES, FUNCTIONS, 3)
        base = self._keys(vertex[..., 0])
        # Changes of one function to its second or third vertex, and of two functions to their second.
        changes = [((f, r),) for f in range(FUNCTIONS) for r in (1, 2)] + [((f, 1), (g, 1)) for f in range(FUNCTIONS) for g in range(f)]
        costs = np.stack([sum(cost[:, :, f, r] for f, r in c) for c in changes], axis=2)
        keys = []
        for c in changes:
            v = vertex[..., 0].copy()
            for f, r in c:
                v[:, :, f] = vertex[:, :, f, r]
            keys.append(self._keys(v))
        cheapest = np.argsort(costs, axis=2, kind="stable")[:, :, :PROBES]
        probes = np.take_along_axis(np.stack(keys, axis=2), cheapest, axis=2)
        return base, probes.reshape(n, -1), sketch

    def _keys(self, vertex: np.ndarray) -> np.ndarray:
        """One 64-bit key of the vertices (n, tables, functions) of each table."""
        h = np.broadcast_to((np.arange(1, TABLES + 1, dtype=np.uint64) + np.uint64(self.dim << 8)) * _MIX, vertex.shape[:2])
        for f in range(FUNCTIONS):
            h = (h ^ vertex[:, :, f]) * _MIX
            h = h ^ (h >> np.uint64(29))
        return h.view(np.int64)


def _ragged(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _directions(rows: DataFrame, id_type: str) -> DataFrame:
    """__id, same (digest of the direction), null where the vector links with nothing; and the vector itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same: list[bytes | None] = [None] * batch.num_rows
            for at, x in by_length(batch.column(1)):
                some, u = units(x)
                for k, row in zip(at[some].tolist(), u + 0.0):
                    same[k] = xxhash.xxh3_128_digest(row.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), batch.column(1)], ["__id", "same", "v"])

    return in_arrow(rows, run, f"__id {id_type}, same binary, v array<double>")


def _hashes(rows: DataFrame) -> DataFrame:
    """Rows (.., v last) with base, probes and sketch."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, Rotations] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                for at, x in by_length(part.column(len(names) - 1)):
                    if x.shape[1] not in turns:
                        turns[x.shape[1]] = Rotations(x.shape[1])
                    some, u = units(x)
                    made = [_ragged(list(z), pa.int64()) for z in turns[x.shape[1]].hashed(u)]
                    yield pa.RecordBatch.from_arrays([*part.take(pa.array(at[some])).columns, *made], [*names, "base", "probes", "sketch"])

    schema = rows.schema.simpleString()[len("struct<") : -1]
    return in_arrow(rows, run, f"{schema}, base:array<bigint>, probes:array<bigint>, sketch:array<bigint>")


def apart(a: str, b: str) -> Column:
    """Unequal bits of two sketches."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH // 64)), start=F.lit(0))


def within(a: str, b: str, angle: Column | float) -> Column:
    """Whether two sketches may be of directions at most ``angle`` apart."""
    share = F.least((angle if isinstance(angle, Column) else F.lit(float(angle))) / F.lit(math.pi), F.lit(0.5))
    return apart(a, b) <= SKETCH * share + ERRORS * F.sqrt(SKETCH * share * (1 - share)) + 1


def _cosines(rows: DataFrame, out: str = "cos") -> DataFrame:
    """Rows (.., p, q): the cosine of the vectors p and q in double precision in their place."""
    names = rows.columns[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = np.full(batch.num_rows, -1.0)
            left = {k: u for at, x in by_length(batch.column(len(names))) for k, u in zip(at.tolist(), units(x)[1])}
            right = {k: u for at, x in by_length(batch.column(len(names) + 1)) for k, u in zip(at.tolist(), units(x)[1])}
            for k, u in left.items():
                if len(u) == len(right[k]):
                    cos[k] = u @ right[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(cos, pa.float64())], [*names, out])

    schema = rows.select(*names).schema.simpleString()[len("struct<") : -1]
    return in_arrow(rows, run, f"{schema}, {out}:double")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", limit: float = LIMIT) -> DataFrame:
    """One row per vector: id, n_links (other vectors of cosine >= ``limit``), component_id (smallest id reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different
    lengths or rows without an id; they are components of their own. Each row is a vector of its own: rows that repeat an
    id and a vector are linked like any copies. ``limit`` must be above 0. An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    theta = math.acos(limit)
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(vec_col).cast("array<double>").alias("v"))
    found = settled(_directions(rows, id_type), "vectors-directions")
    named = F.col("same").isNotNull() & F.col("__id").isNotNull()
    equal = found.filter(named).groupBy("same").agg(F.min("__id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v"))
    # The table is written, so that its numbers hold.
    classes = settled(_hashes(equal.withColumn("id", F.monotonically_increasing_id()).select("same", "id", "least", "n", "v")), "vectors-classes")
    balls, members = _gathered(classes, theta)
    pairs = _candidates(balls, theta)
    sides = balls.select("ball", "v", "radius", "size")
    one = sides.select(F.col("ball").alias("a"), F.col("v").alias("p"), F.col("radius").alias("r"), F.col("size").alias("m"))
    two = sides.select(F.col("ball").alias("b"), F.col("v").alias("q"), F.col("radius").alias("s"), F.col("size").alias("n"))
    met = _cosines(pairs.join(one, "a").join(two, "b").select("a", "b", "r", "s", "m", "n", "p", "q"))
    angle = F.acos(F.least(F.greatest("cos", F.lit(-1.0)), F.lit(1.0)))
    single = (F.col("r") == 0) & (F.col("s") == 0)
    all_ = F.when(single, F.col("cos") >= limit).otherwise(angle + F.col("r") + F.col("s") <= theta - SLACK)
    some = ~single & ~all_ & (angle - F.col("r") - F.col("s") <= theta + SLACK)
    met = settled(met.select("a", "b", "m", "n", all_.alias("all"), some.alias("some")).filter("all or some"), "vectors-met")
    both = met.union(met.select(F.col("b"), F.col("a"), F.col("n"), F.col("m"), "all", "some"))
    whole = both.filter("all").groupBy(F.col("a").alias("ball")).agg(F.sum("n").alias("whole"))
    part, edges = _by_members(both.filter("some").select("a", "b"), balls, members, theta, limit)
    links = met.filter("all").select("a", "b").union(edges).distinct()
    label = components(links, "vectors-components").withColumnRenamed("__id", "ball")
    each = members.select("same", "id", "ball", "least").join(balls.select("ball", "size"), "ball").join(whole, "ball", "left").join(part, "id", "left").join(label, "ball", "left")
    each = each.select("same", "least", (F.col("size") - 1 + F.coalesce("whole", F.lit(0)) + F.coalesce("part", F.lit(0))).alias("n_links"), F.coalesce("component", "ball").alias("component"))
    each = settled(each, "vectors-judged")
    first = each.groupBy("component").agg(F.min("least").alias("component_id"))
    judged = each.join(first, "component").select("same", "n_links", "component_id")
    out = found.select("__id", F.when(named, F.col("same")).alias("same")).join(judged, "same", "left")
    component = F.coalesce("component_id", "__id")
    return out.select(F.col("__id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("__id").eqNullSafe(component).alias("kept"))


def _gathered(classes: DataFrame, theta: float) -> tuple[DataFrame, DataFrame]:
    """Balls (ball, v, radius, size, keys of their members) and members (same, id, least, n, v, ball)."""
    entries = classes.select("id", F.explode("base").alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1")
    shared = settled(entries.join(sizes, "key"), "vectors-shared")
    central = settled(shared.groupBy("id").agg(F.sum("held").alias("central")), "vectors-central")
    hubs = shared.join(central, "id").groupBy("key").agg(F.max(F.struct("central", "id")).alias("hub"))
    tried = shared.join(hubs, "key").filter(F.col("hub.id") != F.col("id")).select("id", F.col("hub.central").alias("central"), F.col("hub.id").alias("hub")).distinct()
    mine = classes.select("id", F.col("sketch").alias("x"))
    theirs = classes.select(F.col("id").alias("hub"), F.col("sketch").alias("y"))
    close = tried.join(mine, "id").join(theirs, "hub").filter(within("x", "y", theta)).select("id", "central", "hub")
    vectors = classes.select("id", "v")
    cos = _cosines(close.join(vectors.withColumnRenamed("v", "p"), "id").join(vectors.select(F.col("id").alias("hub"), F.col("v").alias("q")), "hub").select("id", "central", "hub", "p", "q"))
    # A class is a hub of its own too: it stays where no hub within the limit is more central.
    choice = cos.filter(F.acos(F.least("cos", F.lit(1.0))) <= theta).select("id", F.struct("central", "hub").alias("hub"))
    own = central.select("id", F.struct("central", F.col("id").alias("hub")).alias("hub"))
    chosen = choice.union(own).groupBy("id").agg(F.max("hub").alias("hub")).select("id", F.col("hub.hub").alias("hub"))
    groups = chosen.groupBy("hub").agg(F.count("*").alias("k")).filter("k > 1").select("hub")
    joined = settled(chosen.join(groups, "hub").select("id", "hub"), "vectors-groups")
    means = _means(joined.join(vectors, "id").select("hub", "v"))
    near = _cosines(joined.join(vectors.withColumnRenamed("v", "p"), "id").join(means.withColumnRenamed("v", "q"), "hub").select("id", "hub", "p", "q"))
    inside = settled(near.select("id", "hub", F.acos(F.least("cos", F.lit(1.0))).alias("angle")).filter(F.col("angle") <= theta / 2 - SLACK), "vectors-inside")
    ball = F.when(F.col("hub").isNotNull(), 2 * F.col("hub") + 1).otherwise(2 * F.col("id"))
    members = settled(classes.join(inside.select("id", "hub", "angle"), "id", "left").withColumn("ball", ball).drop("hub"), "vectors-members")
    # Balls of one class are their class; of the others the keys of all members count, each once.
    single = members.filter("angle is null").select("ball", "v", F.lit(0.0).alias("radius"), F.col("n").alias("size"), "sketch", "base", "probes")
    many = members.filter("angle is not null")
    attributes = many.groupBy("ball").agg((F.max("angle") + SLACK).alias("radius"), F.sum("n").alias("size"))
    centres = _hashes(means.select((2 * F.col("hub") + 1).alias("ball"), "v")).select("ball", "v", "sketch")
    keys = lambda column: many.select("ball", F.explode(column).alias("key")).groupBy("ball").agg(F.collect_set("key").alias(column))
    gathered = attributes.join(centres, "ball").join(keys("base"), "ball").join(keys("probes"), "ball")
    balls = settled(single.unionByName(gathered), "vectors-balls")
    return balls, members


def _means(rows: DataFrame) -> DataFrame:
    """hub, v (direction of the sum of the unit vectors), summed up within a task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hubs = batch.column(0).to_numpy()
            for at, x in by_length(batch.column(1)):
                some, u = units(x)
                names, where = np.unique(hubs[at[some]], return_inverse=True)
                total = np.zeros((len(names), x.shape[1]))
                np.add.at(total, where, u)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), _ragged(list(total), pa.float64())], ["hub", "part"])

    parts = in_arrow(rows, run, "hub bigint, part array<double>").select("hub", F.posexplode("part").alias("at", "x"))
    sums = parts.groupBy("hub", "at").agg(F.sum("x").alias("x"))
    return settled(sums.groupBy("hub").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v")).select("hub", F.col("v.x").alias("v")), "vectors-means")


def _candidates(balls: DataFrame, theta: float) -> DataFrame:
    """Pairs (a < b) of balls that share a key and may hold a linked pair by their centres' sketches."""
    one = balls.select(F.explode("base").alias("key"), F.col("ball").alias("a"), F.col("sketch").alias("x"), F.col("radius").alias("r"))
    two = balls.select(F.explode(F.array_union("base", "probes")).alias("key"), F.col("ball").alias("b"), F.col("sketch").alias("y"), F.col("radius").alias("s"))
    near = one.join(two, (one["key"] == two["key"]) & (F.col("a") != F.col("b")) & within("x", "y", F.lit(theta) + F.col("r") + F.col("s")))
    return settled(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "vectors-candidates")


def _by_members(directed: DataFrame, balls: DataFrame, members: DataFrame, theta: float, limit: float) -> tuple[DataFrame, DataFrame]:
    """Of pairs (a, b) of balls that centres leave open, each in both directions: by class of a how many vectors of b's it links with
    (id, part), and pairs of balls that have a link."""
    centres = balls.select(F.col("ball").alias("b"), F.col("v").alias("q"), F.col("radius").alias("s"), F.col("size").alias("n"))
    left = members.select(F.col("ball").alias("a"), "id", F.col("v").alias("p"))
    met = _cosines(directed.join(left, "a").join(centres, "b").select("a", "b", "id", "s", "n", "p", "q"))
    angle = F.acos(F.least(F.greatest("cos", F.lit(-1.0)), F.lit(1.0)))
    single = F.col("s") == 0
    all_ = F.when(single, F.col("cos") >= limit).otherwise(angle + F.col("s") <= theta - SLACK)
    some = ~single & ~all_ & (angle - F.col("s") <= theta + SLACK)
    met = settled(met.select("a", "b", "id", "n", all_.alias("all"), some.alias("some")).filter("all or some"), "vectors-members-met")
    mine = members.select("id", F.col("v").alias("p"))
    theirs = members.select(F.col("ball").alias("b"), F.col("n").alias("size"), F.col("v").alias("q"))
    each = _cosines(met.filter("some").select("a", "b", "id").join(mine, "id").join(theirs, "b").select("a", "b", "id", "size", "p", "q")).filter(F.col("cos") >= limit)
    linked = settled(met.filter("all").select("a", "b", "id", "n").union(each.groupBy("a", "b", "id").agg(F.sum("size").alias("n"))), "vectors-members-linked")
    return linked.groupBy("id").agg(F.sum("n").alias("part")), linked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


#: By comparing all pairs. Vectors of equal length without null or non-finite components, not zero.
ORACLE_SQL = f"""
WITH RECURSIVE k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE vec_id IS NOT NULL
  AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM k a JOIN k b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {LIMIT}),
w AS (SELECT a AS id, a AS reached FROM e UNION SELECT w.id, e.b FROM w JOIN e ON e.a = w.reached),
c AS (SELECT id, min(reached) AS component FROM w GROUP BY id),
n AS (SELECT a AS id, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.component, vec_id) AS component_id, coalesce(c.component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.id = vec_id LEFT JOIN c ON c.id = vec_id"""
