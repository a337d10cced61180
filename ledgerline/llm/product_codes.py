"""Vector code compression: a codebook for each part of a vector, and norm-of-sum bounds that save rescans.

Beside its code, a part keeps a lower bound of its distance to the entries of each group of its codebook (its own
entry left out) and the stamp of the round in which that bound was measured. Codebooks of all rounds are kept. In a later
round the bound is lowered by the greatest *net* displacement of the group's entries between the stamped codebook and
the present one, which is the norm of a sum of moves; the sum of their norms, as accumulated drift would have it, is never
less. Where the present distance to the part's own entry is strictly below every lowered bound, its code stands
without a scan; else the groups whose bounds failed are scanned exactly, and get new bounds and stamps.

All distances are of integers, and decided as integers; only bounds are floating point, rounded to the safe side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, removed, settled_at
from ledgerline.llm.vectors import by_length, integers, lists, matrix

PARTS, ENTRIES, ROUNDS, SCALE, GROUPS = 16, 64, 2, 256, 4
#: Components beyond this size would not leave squared distances within 64 bits.
MOST = 2.0**20
#: Room for rounding: bounds are lowered by this share before they are trusted.
SAFE = 1e-6
_STATE = "id {id}, label {label}, v array<int>, code binary, bound binary, stamp binary, error bigint"


class Codebooks:
    """The codebooks of all rounds so far, each (parts, entries, width), and the net displacements between them."""

    def __init__(self, history: list[np.ndarray]):
        self.history = history
        self.now = history[-1]
        parts, entries, _ = self.now.shape
        #: The group of each entry: runs of nearly equal length.
        self.group = np.arange(entries) * min(GROUPS, entries) // entries
        self.groups = int(self.group.max()) + 1
        moved = [np.sqrt(((self.now - h).astype(np.float64) ** 2).sum(axis=2)) for h in history]
        #: Greatest net displacement by stamp, part and group.
        self.displaced = np.array([[[m[p][self.group == g].max() for g in range(self.groups)] for p in range(parts)] for m in moved])

    def far(self, x: np.ndarray, part: int, group: int | None = None) -> np.ndarray:
        """Squared distances of parts (n, width) to all entries, or those of a group."""
        entries = self.now[part] if group is None else self.now[part][self.group == group]
        out = np.zeros((len(x), len(entries)), np.int64)
        for i in range(x.shape[1]):
            out += (x[:, i, None] - entries[None, :, i]) ** 2
        return out

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes, bounds, stamps and squared distances of vectors (n, parts, width) that have none yet."""
        n, parts, _ = x.shape
        code, far = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
        bound = np.zeros((n, parts, self.groups))
        for p in range(parts):
            d = self.far(x[:, p], p)
            code[:, p] = d.argmin(axis=1)
            far[:, p] = d[np.arange(n), code[:, p]]
            bound[:, p] = self._bounds(d, code[:, p])
        return code, bound, np.full(bound.shape, len(self.history) - 1), far

    def _bounds(self, d: np.ndarray, code: np.ndarray) -> np.ndarray:
        rest = d.astype(np.float64)
        rest[np.arange(len(d)), code] = np.inf
        return np.sqrt(np.stack([rest[:, self.group == g].min(axis=1) for g in range(self.groups)], axis=1))

    def again(self, x: np.ndarray, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """The same for vectors with codes and bounds of earlier rounds, and how many groups were scanned."""
        n, parts, _ = x.shape
        code, bound, stamp, far, scanned = code.copy(), bound.copy(), stamp.copy(), np.zeros((n, parts), np.int64), 0
        for p in range(parts):
            far[:, p] = ((x[:, p] - self.now[p][code[:, p]]) ** 2).sum(axis=1)
            low = bound[:, p] - self.displaced[stamp[:, p], p, np.arange(self.groups)]
            # Not strictly below a bound: an equally near entry of smaller number may be there.
            open_ = ~(np.sqrt(far[:, p].astype(np.float64))[:, None] * (1 + SAFE) < low * (1 - SAFE))
            best, least, was = code[:, p].copy(), far[:, p].copy(), code[:, p].copy()
            fresh = []
            for g in range(self.groups):
                rows = np.flatnonzero(open_[:, g])
                scanned += len(rows)
                if not len(rows):
                    continue
                numbers = np.flatnonzero(self.group == g)
                d = self.far(x[rows, p], p, g)
                at = d.argmin(axis=1)
                near, which = d[np.arange(len(rows)), at], numbers[at]
                nearer = (near < least[rows]) | ((near == least[rows]) & (which < best[rows]))
                least[rows[nearer]], best[rows[nearer]] = near[nearer], which[nearer]
                fresh.append((g, rows, numbers, d))
            code[:, p], far[:, p] = best, least
            for g, rows, numbers, d in fresh:
                rest = d.astype(np.float64)
                rest[numbers[None, :] == best[rows, None]] = np.inf
                bound[rows, p, g], stamp[rows, p, g] = np.sqrt(rest.min(axis=1)), len(self.history) - 1
            # A code that was left belongs to the others of its group now; its distance was not strictly above the new one's.
            left = np.flatnonzero(best != was)
            if len(left):
                old = np.sqrt(((x[left, p] - self.now[p][was[left]]) ** 2).sum(axis=1).astype(np.float64))
                g = self.group[was[left]]
                here = bound[left, p, g] - self.displaced[stamp[left, p, g], p, g]
                bound[left, p, g], stamp[left, p, g] = np.minimum(here, old), len(self.history) - 1
        return code, bound, stamp, far, scanned


def _columns(code: np.ndarray, bound: np.ndarray, stamp: np.ndarray) -> list[pa.Array]:
    """Codes, bounds and stamps as bytes of each row; bounds as floats not above themselves."""
    lowered = np.nextafter(bound.astype(np.float32), np.float32(-np.inf))
    each = [code.astype(np.uint8), lowered.astype("<f4"), stamp.astype(np.uint8)]
    return [pa.array([r.tobytes() for r in x], pa.binary()) for x in each]


def compressed(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: id, code (hex, two digits a part), error, label_error, codebooks_sha256.

    Kept are vectors without null or non-finite components or such beyond ``MOST`` in size, of a length that ``parts``
    divides, and of the length that the kept vector of smallest id has. Components are floor(scale * x). Codebooks
    start as the parts of the vectors of smallest id (null ids last, equal ids by their components), fewer than
    ``entries`` where there are fewer vectors, 256 at most. Rows that repeat an id are vectors of their own. A table
    without a kept vector gives no rows. Errors are added up over equal labels, null labels together; a sum beyond 64
    bits is null. Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    id_type, label_type = vectors.schema[id_col].dataType.simpleString(), vectors.schema[label_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"), F.col(vec_col).cast("array<double>").alias("__v"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_length(batch.column(2)):
                at = at[(np.abs(x) <= MOST).all(axis=1)] if x.shape[1] % parts == 0 else at[:0]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1]), pa.int32())], ["id", "dim"])

    smallest = in_arrow(rows, lengths, f"id {id_type}, dim int").orderBy(F.col("id").asc_nulls_last(), "dim").limit(1).collect()
    if not smallest:
        return spark.createDataFrame([], f"{id_col} {id_type}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    dim = smallest[0]["dim"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column(2), dim, scale, MOST)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), lists(x, pa.int32())], ["id", "label", "v"])

    heads = in_arrow(rows, whole, f"id {id_type}, label {label_type}, v array<int>").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    history = [np.array([r["v"] for r in heads], np.int64).reshape(len(heads), parts, dim // parts).transpose(1, 0, 2)]
    schema = _STATE.format(id=id_type, label=label_type)

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Codebooks(history[:1])
        for batch in whole(batches):
            code, bound, stamp, far = books.first(matrix(batch.column(2), dim).reshape(batch.num_rows, parts, dim // parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, *_columns(code, bound, stamp), pa.array(far.sum(axis=1), pa.int64())], ["id", "label", "v", "code", "bound", "stamp", "error"])

    state, path = settled_at(in_arrow(rows, begun, schema), "codes-0")
    for r in range(rounds):
        history = [*history, _moved(state, history[-1])]
        nxt, to = settled_at(_judged_again(state, history, schema), f"codes-{r + 1}")
        removed(spark, path)
        state, path = nxt, to
    digest = hashlib.sha256(",".join(map(str, history[-1].ravel().tolist())).encode()).hexdigest()
    by_label = state.groupBy(F.col("label").alias("__l")).agg(F.expr("try_cast(sum(cast(error AS decimal(20,0))) AS bigint)").alias("label_error"))
    out = state.select("id", "label", "code", "error").join(by_label, F.col("label").eqNullSafe(F.col("__l")))
    return out.select(F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _judged_again(state: DataFrame, history: list[np.ndarray], schema: str) -> DataFrame:
    parts, entries, width = history[-1].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Codebooks(history)
        for batch in batches:
            n = batch.num_rows
            x = matrix(batch.column(2), parts * width).reshape(n, parts, width)
            code, bound, stamp = (np.frombuffer(b"".join(c.to_pylist()), k) for c, k in zip(batch.columns[3:6], (np.uint8, "<f4", np.uint8)))
            kept = code.reshape(n, parts).astype(np.int64), bound.reshape(n, parts, books.groups).astype(np.float64), stamp.reshape(n, parts, books.groups).astype(np.int64)
            code, bound, stamp, far, _ = books.again(x, *kept)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_columns(code, bound, stamp), pa.array(far.sum(axis=1), pa.int64())], batch.schema.names)

    return in_arrow(state, run, schema)


def _moved(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebook: floor(sum / count) of each component of the entries that have parts; sums are added up within a task first."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), parts * width).reshape(-1, width)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
            np.add.at(total, (code + np.arange(parts) * entries).ravel(), np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
        some = np.flatnonzero(total[:, width])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), lists(total[some], pa.int64())], ["entry", "total"])

    each = in_arrow(state.select("v", "code"), run, "entry int, total array<bigint>").select("entry", F.posexplode("total").alias("at", "part"))
    totals: dict[int, dict[int, int]] = {}
    # As many rows as the codebook has numbers.
    for r in each.groupBy("entry", "at").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("s")).collect():
        totals.setdefault(r["entry"], {})[r["at"]] = int(r["s"])
    out = book.reshape(parts * entries, width).copy()
    for e, t in totals.items():
        out[e] = [t[i] // t[width] for i in range(width)]
    return out.reshape(parts, entries, width)


def oracle_sql(dim: int = 64, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by scans of whole codebooks, for vectors of ``dim`` components. Integers stay below 2^53, where doubles are exact."""
    w = dim // parts
    steps = [
        f"""k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) <= {MOST:.0f})) = {dim})""",
        f"x AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, {w} * p + 1, {w} * p + {w}) AS w FROM k, range({parts}) t(p))",
        f"h AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS c, v FROM k ORDER BY 1 LIMIT {entries})",
        f"c0 AS MATERIALIZED (SELECT c, p, list_slice(v, {w} * p + 1, {w} * p + {w}) AS w FROM h, range({parts}) t(p))",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT x.vec_id, x.label, x.p, x.w, min(struct_pack(d := list_inner_product(x.w, x.w) - 2 * list_inner_product(x.w, c.w) + list_inner_product(c.w, c.w), c := c.c)) AS best
  FROM x JOIN c{r} c ON c.p = x.p GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (SELECT p, c, list(floor(s / n) ORDER BY i) AS w FROM (SELECT p, c, i, sum(y) AS s, count(*) AS n
  FROM (SELECT p, best.c AS c, unnest(w) AS y, generate_subscripts(w, 1) AS i FROM a{r}) GROUP BY p, c, i) GROUP BY p, c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, c{r}.p, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (p, c))""")
    return f"""WITH {", ".join(steps)},
e AS (SELECT vec_id, label, string_agg(printf('%02x', best.c), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(w, lambda y: y::BIGINT), ','), ',' ORDER BY p, c)) FROM c{rounds}) AS codebooks_sha256 FROM e"""
