"""Vector code compression (operator 12): product codes from exact integer products.

Components become integers (``floor(scale * x)``); vectors are cut into equal
consecutive parts, and every part position has a codebook of a few entries. A
part's code is its nearest entry's index by squared Euclidean distance, of equal
ones the first.

Distances are ``|a|^2 - 2 a.b + |b|^2``, exact in 64-bit integers, with the products
``a.b`` by floating-point matrix multiplication: integers are cut into limbs of so
few bits that a sum of limb products stays below 2^53, every pair of limbs is one
float64 product (BLAS) that rounds nothing, and the products are shifted and added
in int64. Small integers are one limb.

Codebooks start as the parts of the first vectors by id. A round assigns all
parts and moves every entry to its parts' componentwise ``floor(sum / count)``; an
entry without parts stays. A task adds up its own rows, so a round sends one
number per entry and component and task; only sums per entry, bounded by the
codebooks' size, reach the driver.

Defined results: rows whose vector is null or holds null or non-finite components
are left out; so are vectors of another length than the most frequent length that
can be cut (of equally frequent ones the largest); repeated rows count as often
as they occur, also among the first vectors; null ids come last in the order of
ids, equal ids in the order of their vectors; fewer vectors than entries make a
smaller codebook; components beyond what 64-bit distances allow (about 46,000 for
vectors of 64) count as that bound; extra columns are ignored; an empty table, and
one without any vector that can be cut, gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialized, table
from strata.llm.intvec import first_vectors, floor_means, grid_vectors, group_sums, largest, matrix, with_group_total
from strata.operators.channels import shuffle_partitions

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


def _bits(m: np.ndarray) -> int:
    return int(max(abs(int(m.max())), abs(int(m.min())))).bit_length() if m.size else 0


def limbs(m: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs: ``sum(limb[i] * 2**(bits * i))``. All limbs but
    the last lie in ``[0, 2**bits)``, the last is signed and no larger."""
    out = []
    for _ in range(max(0, -(-_bits(m) // bits) - 1)):
        out.append((m & ((1 << bits) - 1)).astype(np.float64))
        m = m >> bits
    return [*out, m.astype(np.float64)]


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact as long as it fits in 63 bits."""
    width = max(a.shape[1], 1)
    bits = (53 - width.bit_length()) // 2  # width * 2**bits * 2**bits stays below 2**53
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(a: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``a`` the first nearest entry and its squared distance."""
    own = np.einsum("ij,ij->i", a, a)
    theirs = np.einsum("ij,ij->i", entries, entries)
    distance = own[:, None] - 2 * exact_product(a, entries) + theirs[None, :]
    code = np.argmin(distance, axis=1)
    return code, np.take_along_axis(distance, code[:, None], axis=1)[:, 0]


@dataclass
class Codebooks:
    """``entries[part][index]`` are integer components; ``scale`` made them."""

    entries: np.ndarray  # parts x entries x width
    scale: int

    def digest(self) -> str:
        """SHA-256 (hex) of all components in order, as decimals with commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that rows of codes stand for: the middles of the cells."""
        picked = [self.entries[p][codes[:, p]] for p in range(len(self.entries))]
        return (np.concatenate(picked, axis=1) + 0.5) / self.scale


def cut_length(vectors: DataFrame, parts: int) -> int:
    """The most frequent length that can be cut into ``parts``; 0 if there is none."""
    n = F.size("v")
    row = (
        vectors.where((n > 0) & (n % parts == 0)).groupBy(n.alias("n")).agg(F.count(F.lit(1)).alias("c"))
        .orderBy(F.desc("c"), F.desc("n")).first()
    )
    return row["n"] if row else 0


def compress(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id``, ``label``, ``codes`` (array of int, one a part) and ``error``
    (squared distances summed over parts, in grid units) of every vector that is
    kept, written once; and the codebooks (``None`` without vectors)."""
    # the length is not known yet: bound by parts as long as any that are used
    found = grid_vectors(vectors, vec_id=vec_id, embedding=embedding, label=label, scale=scale, limit=2**31 - 1)
    dims = cut_length(found, parts)
    fields = f"vec_id {found.schema['vec_id'].dataType.simpleString()}, label {found.schema['label'].dataType.simpleString()}"
    schema = f"{fields}, codes array<int>, error long"
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema), None
    width, bound = dims // parts, largest(dims)
    kept = found.where(F.size("v") == dims)

    def bounded(m: np.ndarray) -> np.ndarray:
        return np.clip(m, -bound, bound)

    start = bounded(first_vectors(kept, [F.asc_nulls_last("vec_id")], entries))
    books = np.stack([start[:, p * width : (p + 1) * width] for p in range(parts)])
    k = books.shape[1]

    for _ in range(rounds):

        def assign(m: np.ndarray, books=books) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            m = bounded(m)
            for p in range(parts):
                part = m[:, p * width : (p + 1) * width]
                yield p * k + nearest(part, books[p])[0], part

        sums, counts = group_sums(kept, dims, parts * k, assign)
        books = floor_means(sums, counts, books.reshape(parts * k, width)).reshape(parts, k, width)

    def coded(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            m = bounded(matrix(batch, dims))
            pairs = [nearest(m[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
            codes = np.stack([c for c, _ in pairs], axis=1).astype(np.int32)
            ends = np.arange(len(m) + 1, dtype=np.int32) * parts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel())),
                    pa.array(sum(d for _, d in pairs)),
                ],
                names=["vec_id", "label", "codes", "error"],
            )

    return materialized(kept.mapInArrow(coded, schema), "vector-codes"), Codebooks(books, scale)


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Query: code, error and label error of every vector, with the codebooks'
    digest."""
    rows, books = compress(table(spark, sf_dir, "embeddings"))
    rows = with_group_total(rows, "label", "error", "label_error", shuffle_partitions(spark))
    two = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    digest = F.lit(books.digest() if books else None).cast("string")
    return rows.select(
        "vec_id", F.array_join(two, "").alias("code"), "error", "label_error", digest.alias("codebooks_sha256")
    )


def _oracle(scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the query's rows, for tables whose vectors have one length."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT row, vec_id, v, p,
        v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS a FROM kept, range({parts}) t(p))""",
        f"""book0 AS MATERIALIZED (SELECT p, e, a FROM (SELECT p, a, row_number() OVER (
        PARTITION BY p ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM parts) WHERE e < {entries})""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT x.row, x.p, min({{'d': CAST(list_sum(list_transform(list_zip(x.a, b.a),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'e': b.e}}) AS m
            FROM parts x JOIN book{r} b ON x.p = b.p GROUP BY x.row, x.p)"""
        )
        if r < rounds:
            steps.append(
                f"""sums{r} AS MATERIALIZED (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (SELECT p, m.e AS e,
                unnest(a) AS x, generate_subscripts(a, 1) AS i FROM near{r} JOIN parts USING (row, p)) GROUP BY p, e, i)"""
            )
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.a, b.a) AS a FROM book{r} b LEFT JOIN (SELECT p, e,
                list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS a FROM sums{r} GROUP BY p, e) m
                ON m.p = b.p AND m.e = b.e)"""
            )
    return f"""WITH {", ".join(steps)},
    coded AS MATERIALIZED (SELECT row, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code,
        CAST(sum(m.d) AS BIGINT) AS error FROM near{rounds} GROUP BY row),
    digest AS MATERIALIZED (SELECT sha256(string_agg(array_to_string(a, ','), ',' ORDER BY p, e)) AS codebooks_sha256
        FROM book{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (row), digest"""


ORACLE = _oracle()
