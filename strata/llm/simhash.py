"""SimHash near-duplicates (operator 6).

A document's fingerprint is the majority vote, bit by bit, of the XXH64 hashes
of its word shingles. Documents link when their fingerprints differ in at most
``radius`` bits, and a group is a connected component of links.

Candidates come from the pigeonhole rule: with the 64 bits cut into
``equal + radius`` blocks, two fingerprints within the radius agree on at least
``equal`` whole blocks. Each distinct fingerprint (copies count once from here
on) is keyed by every choice of ``equal`` blocks; rows of a key are compared in
one task. ``equal`` grows with the number of fingerprints so that keys stay
short lists; the links found do not depend on it.

The comparison is bit-sliced: the fingerprints of a run are stored as 64 bit
planes, 64 fingerprints a machine word. For a block of queries the difference
planes are added into vertical carry-save counters that start so that passing
the radius overflows; a word is abandoned once all its 64 lanes overflowed.

A key with more than ``TILE`` fingerprints is cut into chunks and the pairs of
chunks become tasks of their own. Tasks emit spanning links (a fingerprint and
the smallest one of its local group), never all pairs.

Defined results: a null or empty text has fingerprint zero, linked like any
other; rows with a null ``doc_id`` take part, and a group of such rows only has
a null ``component_id``; repeated rows stay repeated; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, connected_components, materialized, table
from strata.operators.lookup import SALT, attach, no_salt

RADIUS = 4
SHINGLE = 4
TILE = 8192
#: Rows compared together at least (short keys are joined up to this).
RUN = 512
#: Shingle hashes voted on at once, so that a very long text needs little memory.
VOTES = 1 << 16
SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both ASCII only on bytes
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), VOTES):
        h = np.array(
            [digest(line[s:e], SEED) for s, e in zip(starts[at:], ends[at : at + VOTES])], "<u8"
        )
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(ends)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = SHINGLE):
    """A column expression: the fingerprint (``bigint``) of a text column."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(col(text))


def blocks(parts: int) -> list[int]:
    """64 bits cut into ``parts`` masks of almost equal width."""
    cut = [round(i * 64 / parts) for i in range(parts + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cut, cut[1:])]


def masks(equal: int, radius: int = RADIUS) -> list[int]:
    """The mask of each choice of ``equal`` blocks, as signed integers."""
    out = (sum(c) for c in combinations(blocks(equal + radius), equal))
    return [m - (1 << 64) if m >> 63 else m for m in out]


def equal_blocks(n: int, radius: int = RADIUS) -> int:
    """The fewest equal blocks that give a fingerprint of ``n`` random ones
    under 4,096 candidates over all its keys."""
    for equal in range(1, 64 // radius):
        width = 64 * equal // (equal + radius)
        if n * len(masks(equal, radius)) / 2**width <= 4096:
            return equal
    return 4


def near_pairs(fps: np.ndarray, radius: int = RADIUS, queries: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``i < j`` of fingerprints within ``radius`` bits, in chunks."""
    m = len(fps)
    words = -(-m // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[:m] = np.unpackbits(fps.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    query = bits[:m].astype(np.uint64) * _ALL
    past_end = np.zeros(words, np.uint64)
    if m % 64:
        past_end[-1] = _ALL << np.uint64(m % 64)
    width = radius.bit_length()
    first = (1 << width) - 1 - radius  # one more than the radius overflows
    for at in range(0, m, queries):
        q = query[at : at + queries]
        low = at // 64
        row, word = (x.ravel() for x in np.meshgrid(np.arange(len(q)), np.arange(low, words), indexing="ij"))
        counter = [np.full(len(row), _ALL if first >> k & 1 else 0, np.uint64) for k in range(width)]
        over = past_end[word]
        for p in range(64):
            carry = planes[p][word] ^ q[row, p]
            for c in counter:
                c ^= carry
                carry &= ~c  # the lanes that went from one to zero
            over |= carry
            if p % 8 == 7:
                alive = over != _ALL
                if not alive.any():
                    row = row[:0]
                    break
                if alive.sum() < 0.7 * len(alive):
                    row, word, over = row[alive], word[alive], over[alive]
                    counter = [c[alive] for c in counter]
        if not len(row):
            continue
        near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, lane = np.nonzero(near)
        i, j = row[k] + at, word[k] * 64 + lane
        keep = i < j
        if keep.any():
            yield i[keep], j[keep]


def spanning(m: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``m`` items the smallest index of its group."""
    root = np.arange(m)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            low = np.minimum(a, b)
            if (a == b).all():
                break
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root[root] != root).any():
                root = root[root]
    return root


def _compare(radius: int):
    def run(keys: list[np.ndarray]) -> pd.DataFrame | None:
        fps = np.unique(np.concatenate(keys))  # signed order
        if len(fps) < 2:
            return None
        root = spanning(len(fps), near_pairs(fps.view(np.uint64), radius))
        linked = np.nonzero(root != np.arange(len(fps)))[0]
        return pd.DataFrame({"a": fps[linked], "b": fps[root[linked]]}) if len(linked) else None

    def over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        n, last = 0, None
        for f in frames:
            if not len(f):
                continue
            key = f[["band", "key", "tile"]].to_numpy()
            fp = f["fp"].to_numpy(np.int64)
            cuts = np.concatenate(([0], 1 + np.nonzero((key[1:] != key[:-1]).any(1))[0], [len(fp)]))
            for s, e in zip(cuts, cuts[1:]):
                k = tuple(key[s])
                if n >= RUN and k != last:
                    if (out := run(held)) is not None:
                        yield out
                    held, n = [], 0
                held.append(fp[s:e])
                n, last = n + e - s, k
        if held and (out := run(held)) is not None:
            yield out

    return over


def near_links(fps: DataFrame, *, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Spanning links ``a, b`` between distinct fingerprints (column ``fp``)
    within ``radius`` bits: same components as all links."""
    equal = equal_blocks(max(1, fps.count()), radius)
    keyed = fps.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                    for i, m in enumerate(masks(equal, radius))
                ]
            )
        ).alias("k"),
    ).select("fp", "k.band", "k.key")
    sizes = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    long = materialized(
        sizes.where(F.col("n") > tile).select("band", "key", F.ceil(F.col("n") / tile).cast("int").alias("chunks")),
        "simhash-long-keys",
    )
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda j: F.least(chunk, j) * F.col("chunks") + F.greatest(chunk, j),
    )
    tiled = keyed.join(long, ["band", "key"], "left").select(
        "band", "key", "fp", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(tiles)).alias("tile")
    )
    return (
        tiled.repartition("band", "key", "tile")
        .sortWithinPartitions("band", "key", "tile")
        .mapInPandas(_compare(radius), "a long, b long")
    )


def _components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """``doc_id, fp, component, component_id`` of every row of ``docs``
    (``component``: a fingerprint that names the group)."""
    fps = materialized(
        docs.select(col(doc_id).alias("doc_id"), fingerprints(docs, text=text, shingle=shingle).alias("fp")),
        "simhash-fp",
    )
    reps = materialized(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-reps")
    groups = connected_components(near_links(reps.select("fp"), radius=radius, tile=tile))
    groups = groups.select(F.col("node").alias("fp"), "component")
    named = (
        groups.join(reps, "fp").groupBy("component").agg(F.min("least_id").alias("group_id"))
    )
    linked = groups.join(named, "component").select("fp", "component", "group_id")
    of = reps.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), F.coalesce("group_id", "least_id").alias("component_id")
    )
    # a fingerprint that many rows share gets its group where the rows are read
    of = materialized(of, "simhash-named").withColumn(SALT, no_salt("fp"))
    return attach(fps, of, "fp").select("doc_id", "fp", "component", "component_id")


def simhash_groups(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``."""
    return _components(docs, **how).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row left of each group (its smallest ``doc_id``).

    An id that several rows share is judged in each group by itself: of a
    group's rows with its smallest id, the smallest row by its columns stays. Of
    a group's rows without an id, the smallest stays too, beside the one that
    the group's ids name.
    """
    groups = materialized(_components(docs, doc_id=doc_id, text=text, **how), "simhash-groups")
    by_id = groups.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("stays"),
        F.count(F.lit(1)).alias("rows"),
    )
    judged = materialized(by_id.where("stays = 0 or rows > 1"), "simhash-judged")
    key = col(doc_id)
    gone = judged.where("stays = 0").select(F.col("doc_id").alias("_gone"))
    twice = judged.where("stays = 1").select(F.col("doc_id").alias("_twice"))
    kept = docs.join(gone, key == F.col("_gone"), "left_anti")
    if twice.isEmpty() and groups.where(F.col("doc_id").isNull()).isEmpty():
        return kept
    # one row an id and fingerprint is left before the join, however large a group is
    open_ = kept.where(key.isNull()).unionByName(kept.join(twice, key == F.col("_twice"), "left_semi"))
    row = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    shingle = {k: v for k, v in how.items() if k == "shingle"}
    least = (
        open_.select(key.alias("_id"), fingerprints(docs, text=text, **shingle).alias("_fp"), row.alias("_r"))
        .groupBy("_id", "_fp")
        .agg(F.min("_r").alias("_r"))
    )
    of = groups.select(F.col("fp").alias("_fp"), "component", "component_id").distinct()
    one = (
        least.join(of, "_fp")
        .where(F.col("_id").isNull() | (F.col("_id") == F.col("component_id")))
        .groupBy("component", "_id")
        .agg(F.min("_r").alias("_r"))
        .select(*[F.col(f"_r.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    )
    return kept.where(key.isNotNull()).join(twice, key == F.col("_twice"), "left_anti").unionByName(one)


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: fingerprint and component of every document."""
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
