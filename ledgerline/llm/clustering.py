"""Centroid clustering by Orchard search, on integers and so exact.

A vector starts at the centroid it had in the first round and goes along that centroid's list of all others, nearest
first. Where a nearer one is found (or an equally near one of smaller number) it goes on along that one's list, past
those it has met. It stops where the next centroid of the list lies strictly beyond twice its distance: by the
triangle inequality nothing further can be as near.

Integer vectors and the first round's centroids are written once. Each round reads them and gives back the sums of its
clusters only, added up within a task first, so that a cluster with most of the rows costs one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, settled
from ledgerline.llm.vectors import integers, lists, matrix

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 8, 10, 64, 1024, 3
#: Components beyond this size would not leave squared distances within 64 bits.
MOST = 2.0**17


def orchard(x: np.ndarray, start: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row and its squared distance; of equally near ones the smallest number."""
    k = len(centroids)
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    # Each centroid's list of the others; its own place goes last and is never reached.
    apart_or_self = apart.astype(np.float64)
    np.fill_diagonal(apart_or_self, np.inf)
    order = np.argsort(apart_or_self, axis=1, kind="stable")
    rows = np.arange(len(x))
    now, at = start.copy(), np.zeros(len(x), np.int64)
    far = ((x - centroids[now]) ** 2).sum(axis=1)
    met = np.zeros((len(x), k), bool)
    met[rows, now] = True
    going = rows if k > 1 else rows[:0]
    while len(going):
        ahead = order[now[going], at[going]]
        within = apart[now[going], ahead] <= 4 * far[going]
        going, ahead = going[within], ahead[within]
        new = ~met[going, ahead]
        who, to = going[new], ahead[new]
        met[who, to] = True
        d = ((x[who] - centroids[to]) ** 2).sum(axis=1)
        nearer = (d < far[who]) | ((d == far[who]) & (to < now[who]))
        at[going] += 1
        who, to = who[nearer], to[nearer]
        now[who], far[who], at[who] = to, d[nearer], 0
        going = going[at[going] < k - 1]
    return now, far


def _first_hash(id_col: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per kept vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``dim`` components, none null, non-finite or beyond ``MOST`` in size, each turned into
    floor(scale * x). The first centroids are the k vectors of least sha256 of ``<seed>:<id>``, null ids last, equal
    ids by their components; with fewer vectors there are fewer centroids. Rows that repeat an id are vectors
    of their own, and may be several of the first centroids; an empty centroid stays as it is. A table without a kept
    vector gives no rows. Sums of distances beyond a 64-bit number are null. Other columns are ignored, whatever
    their names.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(vec_col).cast("array<double>").alias("__v"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column(1), dim, scale, MOST)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), lists(x, pa.int32())], ["id", "v"])

    kept = in_arrow(rows, whole, f"id {id_type}, v array<int>")
    first = kept.orderBy(_first_hash("id", seed).asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], f"{id_col} {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    centroids = np.array([r["v"] for r in first], np.int64)

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            x = matrix(batch.column(1), dim)
            now, _ = orchard(x, np.zeros(len(x), np.int64), centroids)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(now, pa.int32())], ["id", "v", "start"])

    # The first round's assignment stays with the vectors: later searches start there.
    table = settled(in_arrow(rows, begun, f"id {id_type}, v array<int>, start int"), "clustering-vectors")
    for _ in range(rounds):
        centroids = _moved(table, centroids, dim)

    last = centroids

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now, far = orchard(matrix(batch.column(1), dim), batch.column(2).to_numpy().astype(np.int64), last)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(now, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"])

    out = settled(in_arrow(table, ended, f"id {id_type}, cluster int, distance bigint"), "clustering-assigned")
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    fits = lambda s: s if s < 1 << 63 else None
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in last]
    # As many rows as there are centroids.
    named = spark.createDataFrame([(c, fits(s), fits(sum(sums.values())), digests[c]) for c, s in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return out.join(F.broadcast(named), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(table: DataFrame, centroids: np.ndarray, dim: int) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of each component of those that have vectors."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), dim + 1), np.int64)
        for batch in batches:
            x = matrix(batch.column(1), dim)
            now, _ = orchard(x, batch.column(2).to_numpy().astype(np.int64), centroids)
            for c in np.unique(now).tolist():
                own = x[now == c]
                total[c] += np.concatenate([own.sum(axis=0), [len(own)]])
        some = np.flatnonzero(total[:, dim])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), lists(total[some], pa.int64())], ["cluster", "total"])

    each = in_arrow(table, summed, "cluster int, total array<bigint>").select("cluster", F.posexplode("total").alias("at", "part"))
    out = centroids.copy()
    totals: dict[int, dict[int, int]] = {}
    for r in each.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("s")).collect():
        totals.setdefault(r["cluster"], {})[r["at"]] = int(r["s"])
    for c, t in totals.items():
        out[c] = [t[i] // t[dim] for i in range(dim)]
    return out


def oracle_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> str:
    """The same by plain search over all centroids. Integers stay below 2^53, where doubles are exact."""
    parts = [
        f"""k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) <= {MOST:.0f})) = {dim})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM k ORDER BY 1 LIMIT {k})",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT k.vec_id, k.v, min(struct_pack(d := list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v) + list_inner_product(c.v, c.v), c := c.c)) AS best
  FROM k, c{r} c GROUP BY k.vec_id, k.v)""")
        if r < rounds:
            parts.append(f"""m{r} AS MATERIALIZED (SELECT c, list(floor(s / n) ORDER BY i) AS v FROM (SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c ON c.c = best.c"""
