"""Embedding near-duplicates by a cover tree (operator 10).

Vectors link when their cosine, in double precision, reaches ``threshold``. On
unit vectors that is a Euclidean distance of at most ``sqrt(2 - 2 threshold)``,
so distances obey the triangle inequality and a cover tree can prune.

* Equal vectors are one node with a number of copies from here on.
* Upper levels: farthest-first points of a bounded sample (``SAMPLE`` nodes in
  hashed order) are nested nets; the first of them, one for every ``BLOCK``
  nodes and at most ``CELLS``, are the cells' centres. Every node goes to its
  nearest centre, and a cell's covering radius is the largest distance of all
  its nodes. Two cells are compared unless their centres lie farther apart than
  both radii and the threshold together.
* A cell is cut into blocks of bounded size. Within a block the levels go on, from
  about the distance in question, with halving radii (``RADII``): each level is a
  net of its parents' members.
* A pair of blocks that is not pruned is one group of a shuffle. It is traversed
  top down on both trees at once: a pair of tree nodes is dropped if no member
  pair can reach the threshold, counted as a whole if every member pair must, and
  opened otherwise. Pairs of vectors that are left are decided in double
  precision.

A group emits a count of links and one spanning link for each vector, not its
pairs. Components come from iterative joins of those links. Vectors without any
cluster structure leave a cover tree nothing to prune; then all pairs of blocks
are compared by matrix products, which is quadratic.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite numbers link with nothing; vectors of different lengths do not link;
repeated rows are copies of one vector; a null id takes part and counts, and is
no component's smallest id unless all its members have none; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, connected_components, materialized, table

THRESHOLD = 0.9
SAMPLE = 2048
CELLS = 1024
BLOCK = 4096
#: Numbers of a block at most (long vectors have smaller blocks).
BLOCK_NUMBERS = 1 << 20
RADII = (0.5, 0.25, 0.125, 0.0625)
#: Slack of single-precision distances; whatever lies within is looked at again.
SLACK = 1e-3
OPENED = 200_000
#: Vectors tried as centres at once.
LINE = 64


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def farthest_first(unit: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` points of the farthest-first order: nets of falling radius."""
    chosen = [0]
    gap = ((unit - unit[0]) ** 2).sum(1)
    while len(chosen) < min(k, len(unit)):
        at = int(gap.argmax())
        if gap[at] <= 0:
            break
        chosen.append(at)
        gap = np.minimum(gap, ((unit - unit[at]) ** 2).sum(1))
    return unit[chosen]


def paths(unit: np.ndarray) -> np.ndarray:
    """For each vector its centre (an index) on every level of ``RADII``."""
    m = len(unit)
    out = np.empty((m, len(RADII)), np.int32)
    groups = [np.arange(m)]
    for level, radius in enumerate(RADII):
        nearer = 1 - radius * radius / 2
        below = []
        for members in groups:
            if len(members) == 1:
                out[members, level] = members
                below.append(members)
                continue
            left = members
            while len(left):
                # the next vectors in line become centres in turn, unless an
                # earlier one of them covers them
                near = unit[left[:LINE]] @ unit[left].T >= nearer
                free = np.ones(len(left), bool)
                for k in range(len(near)):
                    if free[k]:
                        inside = near[k] & free
                        inside[k] = True
                        covered = left[inside]
                        out[covered, level] = left[k]
                        below.append(covered)
                        free ^= inside
                left = left[free]
        groups = below
    return out


@dataclass
class Tree:
    """A block: unit vectors, copies, and of each level the centres' members."""

    unit: np.ndarray
    copies: np.ndarray
    path: np.ndarray

    def __post_init__(self):
        self.small = self.unit.astype(np.float32)
        own = np.arange(len(self.unit), dtype=np.int32)[:, None]
        self.levels = np.concatenate([self.path, own], axis=1)  # the last level: every vector
        self.radius, self.weight, self.children = [], [], []
        m, depth = self.levels.shape
        for k in range(depth):
            centre = self.levels[:, k]
            cos = np.einsum("ij,ij->i", self.unit, self.unit[centre])
            far = np.sqrt(np.maximum(0, 2 - 2 * cos))
            radius, weight = np.zeros(m), np.zeros(m, np.int64)
            np.maximum.at(radius, centre, far)
            np.add.at(weight, centre, self.copies)
            self.radius.append(radius)
            self.weight.append(weight)
            if k + 1 < depth:
                below = np.unique(self.levels[:, k + 1])
                above = centre[below]
                order = np.argsort(above, kind="stable")
                first = np.searchsorted(above[order], np.arange(m + 1))
                self.children.append((below[order], first))

    def top(self) -> np.ndarray:
        return np.unique(self.levels[:, 0])


def _top_pairs(a: Tree, b: Tree, reach: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    def parts(tree: Tree) -> list[np.ndarray]:
        """Centres that stand for themselves alone, and the others."""
        top = tree.top()
        alone = tree.radius[0][top] == 0
        return [top[alone], top[~alone]]

    for k, ca in enumerate(parts(a)):
        for m, cb in enumerate(parts(b)):
            small = np.ascontiguousarray(b.small[cb].T)
            for at in range(0, len(ca) if len(cb) else 0, 512):
                rows = ca[at : at + 512]
                if k == m == 0:  # one distance for all
                    far = np.float32(reach + SLACK)
                else:
                    far = (a.radius[0][rows][:, None] + b.radius[0][cb][None, :] + reach + SLACK).astype(np.float32)
                near = a.small[rows] @ small >= 1 - far * far / 2
                some = near.any(axis=1)  # few rows, where there is little to find
                i, j = np.nonzero(near[some])
                i, j = rows[some][i], cb[j]
                if same:
                    i, j = i[i <= j], j[i <= j]
                if len(i):
                    yield i, j


def _opened(a: Tree, b: Tree, level: int, i: np.ndarray, j: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of children of pairs of centres, some at a time."""
    (ka, fa), (kb, fb) = a.children[level], b.children[level]
    na, nb = fa[i + 1] - fa[i], fb[j + 1] - fb[j]
    # a pair with very many child pairs is opened row by row
    row = np.repeat(np.arange(len(i)), na)
    child = ka[fa[i][row] + np.arange(len(row)) - np.repeat(np.cumsum(na) - na, na)]
    total = np.cumsum(nb[row])
    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + OPENED, "right")))
        r = row[at:stop]
        n = nb[r]
        x = np.repeat(child[at:stop], n)
        y = kb[np.repeat(fb[j[r]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        if same:
            # a centre paired with itself holds every unordered pair twice
            keep = (np.repeat(i[r] != j[r], n)) | (x <= y)
            x, y = x[keep], y[keep]
        yield x, y
        at = stop


def linked(a: Tree, b: Tree, same: bool, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links counted for the vectors of ``a`` and of ``b`` (copies of the other
    vector counted each), and the smallest index of each vector's group (those of
    ``b`` follow those of ``a``)."""
    reach = math.sqrt(2 - 2 * threshold)
    depth = a.levels.shape[1]
    n_a, n_b = len(a.unit), len(b.unit)
    shift = 0 if same else n_a
    count = [np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)]
    edges: list[tuple[np.ndarray, np.ndarray]] = []

    def whole(level, i, j):
        """Every member of the first centre links every member of the second."""
        for tree, mine, other, there, offset, k in ((a, i, j, b, 0, 0), (b, j, i, a, shift, 1)):
            more = np.zeros(len(tree.unit), np.int64)
            np.add.at(more, mine, there.weight[level][other])
            if same and k:
                itself = i == j
                more = np.zeros(len(tree.unit), np.int64)
                np.add.at(more, mine[~itself], there.weight[level][other[~itself]])
            centre = tree.levels[:, level]
            count[k] += more[centre]
            hit = np.zeros(len(tree.unit), bool)
            hit[mine] = True
            members = np.nonzero(hit[centre])[0]
            edges.append((members + offset, centre[members] + offset))
        if same:
            hit = np.zeros(n_a, bool)
            hit[i[i == j]] = True
            own = hit[a.levels[:, level]]
            count[0][own] -= a.copies[own]
        edges.append((i, j + shift))

    def look(level, i, j):
        if level == depth - 1:
            if same:
                i, j = i[i != j], j[i != j]
            near = np.einsum("ij,ij->i", a.small[i], b.small[j]) >= threshold - SLACK
            i, j = i[near], j[near]
            sure = np.einsum("ij,ij->i", a.unit[i], b.unit[j]) >= threshold
            i, j = i[sure], j[sure]
            np.add.at(count[0], i, b.copies[j])
            np.add.at(count[0 if same else 1], j, a.copies[i])
            if len(i):
                edges.append((i, j + shift))
            return
        cos = np.einsum("ij,ij->i", a.small[i], b.small[j])
        apart = np.sqrt(np.maximum(0, 2 - 2 * cos))
        slack = a.radius[level][i] + b.radius[level][j]
        may = apart - slack <= reach + 0.01
        must = apart + slack <= reach - 0.01
        if must.any():
            whole(level, i[must], j[must])
        i, j = i[may & ~must], j[may & ~must]
        for x, y in _opened(a, b, level, i, j, same):
            look(level + 1, x, y)

    for i, j in _top_pairs(a, b, reach, same):
        look(0, i, j)
    if same:
        count[0] += count[1]
    root = np.arange(n_a if same else n_a + n_b)
    for i, j in edges:
        while True:
            p, q = root[i], root[j]
            low = np.minimum(p, q)
            if (p == q).all():
                break
            np.minimum.at(root, p, low)
            np.minimum.at(root, q, low)
            while (root[root] != root).any():
                root = root[root]
    return count[0], count[1], root


def _place(centres: dict[int, np.ndarray]):
    """Frames of ``node, embedding, copies`` to their cell and distance; the
    vector as bytes of doubles."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            dim = f["embedding"].map(len).to_numpy()
            for d in np.unique(dim):
                part = f[dim == d]
                x = np.stack(part["embedding"].to_numpy()).astype(np.float64)
                c = centres.get(int(d))
                u = _unit(x)
                if c is None:  # a length of which the sample has none: one cell
                    cell, far = np.zeros(len(u), np.int64), np.full(len(u), 2.0)
                else:
                    cos = u @ c.T
                    cell = cos.argmax(1)
                    far = np.sqrt(np.maximum(0, 2 - 2 * cos[np.arange(len(u)), cell]))
                yield pd.DataFrame(
                    {
                        "node": part["node"].to_numpy(),
                        "copies": part["copies"].to_numpy(),
                        "dim": int(d),
                        "cell": int(d) * CELLS + cell,
                        "far": far,
                        "vector": [r.tobytes() for r in x],
                    }
                )

    return run


def _vectors(pdf: pd.DataFrame) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(pdf["vector"]), np.float64).reshape(len(pdf), -1))


def _levels(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node", ignore_index=True)
    return pdf.assign(at=np.arange(len(pdf), dtype=np.int32), path=[p.tobytes() for p in paths(_vectors(pdf))])


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        trees, nodes = [], []
        for side in (0, 1):
            part = pdf[pdf["side"] == side].sort_values("at")
            if len(part):
                path = np.frombuffer(b"".join(part["path"]), np.int32).reshape(len(part), -1)
                trees.append(Tree(_vectors(part), part["copies"].to_numpy(np.int64), path))
                nodes.append(part["node"].to_numpy(np.int64))
        same = len(trees) == 1
        links_a, links_b, root = linked(trees[0], trees[-1], same, threshold)
        node = nodes[0] if same else np.concatenate(nodes)
        links = links_a if same else np.concatenate([links_a, links_b])
        hit = links > 0
        return pd.DataFrame({"node": node[hit], "links": links[hit], "other": node[root[hit]]})

    return run


def near_duplicates(
    rows: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``rows``."""
    spark = rows.sparkSession
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = e.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(e, lambda x: x != 0)
    slim = rows.select(col(vec_id).alias("vec_id"), col(embedding).cast("array<double>").alias("embedding"))
    good, bad = slim.where(usable), slim.where(~F.coalesce(usable, F.lit(False)))
    nodes = materialized(
        good.groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
        .withColumn("node", F.monotonically_increasing_id()),  # fixed once written
        "vec-nodes",
    )
    n = nodes.count()
    sample = nodes.select("node", "embedding").orderBy(F.xxhash64("node"), "node").limit(SAMPLE)
    by_dim: dict[int, list] = {}
    for r in sample.collect():
        by_dim.setdefault(len(r["embedding"]), []).append(r["embedding"])
    cells = min(CELLS, max(1, -(-n // BLOCK)))
    centres = {d: farthest_first(_unit(np.array(x, np.float64)), cells) for d, x in by_dim.items()}
    placed = materialized(
        nodes.select("node", "embedding", "copies").mapInPandas(
            _place(centres), "node long, copies long, dim int, cell long, far double, vector binary"
        ),
        "vec-placed",
    )
    balls = placed.groupBy("cell", "dim").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()  # a row a cell
    pairs, cuts = [], []
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    for d in {b["dim"] for b in balls}:
        own = sorted((b for b in balls if b["dim"] == d), key=lambda b: b["cell"])
        c = centres.get(d)
        per_block = max(64, min(BLOCK, BLOCK_NUMBERS // d))
        cuts += [(b["cell"], -(-b["n"] // per_block)) for b in own]
        for k, x in enumerate(own):
            for y in own[k:]:
                gap = 0.0 if c is None else float(np.linalg.norm(c[x["cell"] - d * CELLS] - c[y["cell"] - d * CELLS]))
                if gap - x["far"] - y["far"] <= reach:
                    pairs.append((x["cell"], y["cell"]))
    cut = spark.createDataFrame(cuts, "cell long, blocks int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    trees = materialized(
        placed.join(cut, "cell")
        .select("cell", block, "node", "copies", "vector")
        .groupBy("cell", "block")
        .applyInPandas(_levels, "cell long, block int, node long, copies long, vector binary, at int, path binary"),
        "vec-trees",
    )
    blocks = cut.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    couple = (
        spark.createDataFrame(pairs, "cell long, other_cell long")
        .join(blocks, "cell")
        .join(blocks.select(F.col("cell").alias("other_cell"), F.col("block").alias("other_block")), "other_cell")
        .where("cell < other_cell or block <= other_block")
        .withColumn("pair", F.struct("cell", "block", "other_cell", "other_block"))
    )
    sides = couple.select("pair", "cell", "block", F.lit(0).alias("side")).unionByName(
        couple.where("cell != other_cell or block != other_block").select(
            "pair", F.col("other_cell").alias("cell"), F.col("other_block").alias("block"), F.lit(1).alias("side")
        )
    )
    found = materialized(
        trees.join(sides, ["cell", "block"])
        .select("pair", "side", "at", "node", "copies", "vector", "path")
        .groupBy("pair")
        .applyInPandas(_compare(threshold), "node long, links long, other long"),
        "vec-found",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    least = nodes.select("node", "least_id")
    named = groups.join(least, "node").groupBy("component").agg(F.min("least_id").alias("group_id"))
    group_of = groups.join(named, "component").select("node", "group_id")
    told = (
        nodes.select("node", "embedding", "copies", "least_id")
        .join(links, "node", "left")
        .join(group_of, "node", "left")
        .select(
            F.col("embedding").alias("_e"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("group_id", "least_id").alias("component_id"),
        )
    )
    out = (
        good.join(told, F.col("embedding") == F.col("_e"))
        .select("vec_id", "n_links", "component_id")
        .unionByName(bad.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    )
    return out.withColumn("component_id", F.col("component_id").cast("long")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: links and component of every embedding."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
