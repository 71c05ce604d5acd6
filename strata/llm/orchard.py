"""Centroid clustering with Orchard's search (operator 13).

Components become integers (``floor(scale * x)``), so distances, sums and means are
exact and no result depends on how rows are spread.

Nearest centroids are searched without comparing a vector to all of them. Every
centroid has a list of the others, sorted by their distance from it. A vector walks
the list of its current centroid: a centroid not yet visited is measured; if it is
nearer (or as near with a smaller number) the vector jumps to that centroid's list
and begins there; it stops at a list entry whose distance from the current centroid
is strictly more than twice the vector's own, since by the triangle inequality no
later one can be as near. A batch of vectors walks at once in numpy: a step looks
at one list entry of each vector that is still walking, and rows that stop leave.

A round assigns all vectors and moves every centroid to its vectors' componentwise
``floor(sum / count)``; a centroid without vectors stays. A task adds up its own
rows, so a round sends one number per centroid and component and task; only sums
per centroid reach the driver.

Defined results: only vectors with exactly ``dims`` components, none null or
non-finite, are clustered, the others give no row; repeated rows count as often as
they occur, also among the first centroids; null ids come last in the order of
hashes, equal ids in the order of their vectors; with fewer vectors than centroids
each is one; components beyond what 64-bit distances allow count as that bound;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialized, table
from strata.llm.intvec import first_vectors, floor_means, grid_vectors, group_sums, largest, matrix

SCALE = 64
DIMS = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
#: Vectors that walk together.
LINE = 8192


class Lists:
    """Per centroid the other centroids by distance (squared)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        gaps = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
        # a centroid's own entry is none of its list
        others = [[q for q in np.lexsort((np.arange(k), gaps[p])) if q != p] for p in range(k)]
        self.order = np.array(others, np.int64).reshape(k, k - 1)
        self.gap = np.take_along_axis(gaps, self.order, axis=1)

    def nearest(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each row's nearest centroid (smallest number of equally near ones), its
        squared distance, and how many distances were measured in all."""
        parts = [self._walk(m[i : i + LINE]) for i in range(0, len(m), LINE)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)

    def _distance(self, m: np.ndarray, to: np.ndarray) -> np.ndarray:
        d = m - self.centroids[to]
        return np.einsum("ij,ij->i", d, d)

    def _walk(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        n, last = len(m), self.order.shape[1]
        current = np.zeros(n, np.int64)
        best = self._distance(m, current)
        visited = np.zeros((n, last + 1), bool)
        visited[:, 0] = True
        at = np.zeros(n, np.int64)  # place in the current centroid's list
        measured = n
        walking = np.arange(n) if last else np.arange(0)
        while len(walking):
            own = current[walking]
            # gap <= 4 * best, without a product that may not fit in 64 bits
            walking = walking[(self.gap[own, at[walking]] + 3) // 4 <= best[walking]]
            candidate = self.order[current[walking], at[walking]]
            at[walking] += 1
            new = ~visited[walking, candidate]
            rows, to = walking[new], candidate[new]
            visited[rows, to] = True
            distance = self._distance(m[rows], to)
            measured += len(rows)
            nearer = (distance < best[rows]) | ((distance == best[rows]) & (to < current[rows]))
            jump = rows[nearer]
            current[jump], best[jump], at[jump] = to[nearer], distance[nearer], 0
            walking = walking[at[walking] < last]
        return current, best, measured


def cluster(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance`` (squared, in grid units) of every
    vector that is kept, written once; and the centroids' integer components.

    The first centroids are the vectors with the smallest SHA-256 of
    ``<seed>:<vec_id>`` (lower-case hex)."""
    kept = grid_vectors(
        vectors.where(F.size(F.col("`" + embedding.replace("`", "``") + "`")) == dims),
        vec_id=vec_id, embedding=embedding, scale=scale, limit=largest(dims),
    )
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centers = first_vectors(kept, [F.asc_nulls_last(draw)], centroids)
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    if not len(centers):
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((0, dims), np.int64)

    for _ in range(rounds):
        lists = Lists(centers)

        def assign(m: np.ndarray, lists=lists) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            yield lists.nearest(m)[0], m

        centers = floor_means(*group_sums(kept, dims, len(centers), assign), centers)
    lists = Lists(centers)

    def assigned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            to, distance, _ = lists.nearest(matrix(batch, dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(to.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return materialized(kept.mapInArrow(assigned, schema), "clusters"), centers


def op13_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    """Query: cluster and distance of every vector, with the inertia of its cluster
    and of all and its centroid's digest."""
    rows, centers = cluster(table(spark, sf_dir, "embeddings"))
    # one row a centroid: bounded by their number, whatever the table
    inertia = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    known = [(c, inertia.get(c, 0), sum(inertia.values()), d) for c, d in enumerate(digests)]
    about = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(dims: int = DIMS, scale: int = SCALE, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB SQL for the query's rows: every round compares all centroids."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""centers0 AS MATERIALIZED (SELECT c, v FROM (SELECT v, row_number() OVER (
        ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c FROM kept) WHERE c < {centroids})""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT k.row, min({{'d': CAST(list_sum(list_transform(list_zip(k.v, c.v),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'c': c.c}}) AS m FROM kept k, centers{r} c GROUP BY k.row)"""
        )
        if r < rounds:
            steps.append(
                f"""sums{r} AS MATERIALIZED (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT m.c AS c,
                unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{r} JOIN kept USING (row)) GROUP BY c, i)"""
            )
            steps.append(
                f"""centers{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM centers{r} c LEFT JOIN (SELECT c,
                list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums{r} GROUP BY c) m ON m.c = c.c)"""
            )
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance,
        CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM near{rounds} n JOIN kept USING (row) JOIN centers{rounds} c ON c.c = n.m.c"""


ORACLE = _oracle()
