"""Embedding near-duplicates by dual traversal of cover trees (operator 1).

Unit vectors with a cosine of at least t lie within sqrt(2 - 2t) of each other,
so links are pairs within a radius. The tree's top levels are nested nets of
halving radii over a bounded sample, cut off at MAX_CELLS nodes: its leaves are
cells, and every vector belongs to the nearest one. A vector visits another cell
only if neither the cell's covering radius nor the bisecting plane of the two
centres keeps all its vectors too far. Below, each task builds the lower levels
over a block of a cell and over each batch of visitors and walks both trees
together, dropping pairs of nodes by their covering radii; a pair of nodes
all of whose vectors link is counted whole. What is left is compared exactly.

Equal vectors are one from the start and count by their number. Links leave a
task as counts per vector and as the edges of a spanning forest, never as all
pairs.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components has no links and is its own component; vectors of different lengths
don't link; rows that repeat an id are one more copy of that vector; a null id
takes part, and its component is the smallest non-null id; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import prepare, table, written
from ledgerwatch.llm.components import components

THRESHOLD = 0.95
#: Vectors the top levels are built on, and nodes they may have.
SAMPLE, MAX_CELLS = 4096, 256
#: Distinct vectors per cell to aim at, and vectors of a cell in one task.
CELL, BLOCK = 2048, 4096
#: Radius of the lowest level's nodes.
LEAF = 0.125
#: Rounding allowance of bounds; never of the links themselves.
EPS = 1e-6


def usable(vector: str = "embedding"):
    """Column: the vector as doubles if it can link, else null."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fine & F.exists(v, lambda x: x != 0), v)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def net(points: np.ndarray, radius: float, most: int) -> tuple[np.ndarray, float]:
    """Indices of the greedy farthest-point net down to ``radius`` (prefixes are nets of the
    levels above), and the radius it reaches with ``most`` nodes."""
    picked = [0]
    far = distances(points, points[:1]).ravel()
    while len(picked) < min(most, len(points)) and far.max() > radius:
        picked.append(int(far.argmax()))
        far = np.minimum(far, distances(points, points[picked[-1:]]).ravel())
    return np.array(picked), float(far.max())


def unit_matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column (all of one length), scaled to length one without overflow."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


class Leaves:
    """Lowest nodes over a set of points: radius, members, and the level above."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.points = points
        owner = np.full(n, -1)
        centres: list[int] = []
        left = np.arange(n)
        while len(left):  # greedy cover, many centres at a time
            tried = left[:256]
            d = distances(points[tried], points[tried])
            fresh = [0]
            for i in range(1, len(tried)):
                if (d[i, fresh] > LEAF).all():
                    fresh.append(i)
            own = tried[fresh]
            base = len(centres)
            centres += own.tolist()
            dist = distances(points[left], points[own])
            near = dist.argmin(axis=1)
            hit = dist[np.arange(len(left)), near] <= LEAF
            owner[left[hit]] = base + near[hit]
            owner[own] = base + np.arange(len(own))
            left = left[owner[left] < 0]
        self.centres = points[centres] if n else points
        order = np.argsort(owner, kind="stable")
        self.order = order
        self.bounds = np.searchsorted(owner[order], np.arange(len(centres) + 1))
        d = np.sqrt(np.maximum(0, ((points - self.centres[owner]) ** 2).sum(axis=1))) if n else np.zeros(0)
        self.radius = np.zeros(len(centres))
        np.maximum.at(self.radius, owner, d)

    def members(self, node: int) -> np.ndarray:
        return self.order[self.bounds[node]:self.bounds[node + 1]]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least label of each of n points after uniting the pairs (i, j)."""
    label = np.arange(n)
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j = i[open_], j[open_]
        np.minimum.at(label, np.maximum(a[open_], b[open_]), np.minimum(a[open_], b[open_]))
        while (label != label[label]).any():
            label = label[label]


def traverse(a: Leaves, b: Leaves, same: bool, weight_a: np.ndarray, weight_b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links of a's points, links of b's points, labels over a's then b's points). With
    ``same``, a is b, pairs count once for either end and nothing links with itself."""
    radius = np.sqrt(2 - 2 * threshold)
    na, nb = len(a.points), len(b.points)
    got_a, got_b = np.zeros(na), np.zeros(nb)
    ei, ej = [], []
    for lo in range(0, len(a.centres), 512):
        d = distances(a.centres[lo:lo + 512], b.centres)
        reach = a.radius[lo:lo + 512, None] + b.radius[None, :]
        for x, y in np.argwhere(d - reach <= radius + EPS):
            x0 = x + lo
            if same and y < x0:
                continue
            ma, mb = a.members(x0), b.members(y)
            if d[x, y] + reach[x, y] <= radius - EPS or (same and x0 == y and 2 * a.radius[x0] <= radius - EPS):
                got_a[ma] += weight_b[mb].sum()
                if same and x0 == y:
                    got_a[ma] -= weight_a[ma]
                else:
                    got_b[mb] += weight_a[ma].sum()
                ei += [np.full(len(mb), ma[0]), ma]
                ej += [mb + na, np.full(len(ma), mb[0] + na)]
                continue
            for part in range(0, len(ma), 1024):  # exact, in double precision
                m = ma[part:part + 1024]
                link = a.points[m] @ b.points[mb].T >= threshold
                if same and x0 == y:
                    link[np.arange(len(m)), np.arange(part, part + len(m))] = False
                got_a[m] += link @ weight_b[mb]
                if not (same and x0 == y):
                    got_b[mb] += weight_a[m] @ link
                p, q = np.nonzero(link)
                if len(p) > len(m) + len(mb):
                    label = forest(p, q + len(m), len(m) + len(mb))
                    ids = np.concatenate([m, mb + na])
                    moved = np.flatnonzero(label != np.arange(len(label)))
                    ei.append(ids[moved])
                    ej.append(ids[label[moved]])
                else:
                    ei.append(m[p])
                    ej.append(mb[q] + na)
    i, j = (np.concatenate(x) if x else np.zeros(0, int) for x in (ei, ej))
    if same:
        got_a += got_b  # either end lies in the same set
        i, j = (i % na, j % na) if na else (i, j)
    return got_a, got_b, forest(i, j, na + nb)


_FOUND = "v long, links double, other long"


def _compare(threshold: float):
    """Rows sorted by (cell, block, visitor): residents first, then visitors as they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: np.ndarray, links: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
            some = (links > 0) | (label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[label[some]])], names=["v", "links", "other"])

        now, home, ids, weight, open_ = None, None, None, None, []

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal home, ids, weight, open_
            t = pa.Table.from_batches(open_)
            open_ = []
            ids, weight = t.column("v").to_numpy(), t.column("copies").to_numpy().astype(float)
            home = Leaves(unit_matrix(t.column("vec")))
            links, _, label = traverse(home, home, True, weight, weight, threshold)
            yield found(ids, links, label[:len(ids)])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "visits")]
            cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            edges = [0, *cut.tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:], strict=False):
                key = (cols[0][lo], cols[1][lo])
                if key != now:
                    if open_:
                        yield from settle()
                    now, home, open_ = key, None, []
                part = batch.slice(lo, hi - lo)
                if not cols[2][lo]:
                    open_.append(part)
                    continue
                if open_:
                    yield from settle()
                if home is None:
                    continue  # a block whose residents all lie elsewhere
                v, w = part.column("v").to_numpy(), part.column("copies").to_numpy().astype(float)
                guests = Leaves(unit_matrix(part.column("vec")))
                one, two, label = traverse(home, guests, False, weight, w, threshold)
                yield found(np.concatenate([ids, v]), np.concatenate([one, two]), label)
        if open_:
            yield from settle()

    return run


def _assign(centres: np.ndarray):
    """Each vector's cell and its distance to that cell's centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(unit_matrix(b.column("vec")), centres)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(d[np.arange(len(d)), cell])], names=[*b.schema.names, "cell", "far"])

    return run


def _send(centres: np.ndarray, radii: np.ndarray, blocks: np.ndarray, threshold: float):
    """A vector to its own block as a resident; as a visitor to its cell's higher blocks, and to
    all blocks of each higher cell that may hold a partner."""
    radius = np.sqrt(2 - 2 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = distances(centres, centres)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                d = distances(unit_matrix(b.column("vec")), centres)
                cell, block = b.column("cell").to_numpy(), b.column("block").to_numpy()
                own = d[np.arange(len(d)), cell]
                plane = (d ** 2 - own[:, None] ** 2) / np.maximum(2 * between[cell], 1e-9)
                may = (d <= radii[None, :] + radius + EPS) & (plane <= radius + EPS) & (np.arange(len(centres))[None, :] > cell[:, None])
                row, to = np.nonzero(may)
                rows, cells, blks, visits = [np.arange(len(d))], [cell], [block], [np.zeros(len(d), bool)]
                for r, c, first in ((row, to, np.zeros(len(row), np.int64)), (np.arange(len(d)), cell, block + 1)):
                    n = np.maximum(blocks[c] - first, 0)
                    rows.append(np.repeat(r, n))
                    cells.append(np.repeat(c, n))
                    blks.append(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n))
                    visits.append(np.ones(n.sum(), bool))
                r = np.concatenate(rows)
                for lo in range(0, len(r), 4000):
                    s = slice(lo, lo + 4000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(cells)[s]), pa.array(np.concatenate(blks)[s]), pa.array(np.concatenate(visits)[s]),
                         *(b.column(c).take(pa.array(r[s])) for c in ("v", "copies", "vec"))], names=["cell", "block", "visits", "v", "copies", "vec"])

    return run


def near_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(v, links, other): partial link counts and forest edges over distinct vectors (v, copies,
    vec), all of one length."""
    prepare(vectors.sparkSession)
    n = vectors.count()
    sample = vectors.select("vec").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow()  # bounded
    if not n:
        return vectors.sparkSession.createDataFrame([], _FOUND)
    points = unit_matrix(sample.column("vec"))
    most = int(max(1, min(MAX_CELLS, n // CELL)))
    centres = points[net(points, LEAF, most)[0]]
    placed = written(vectors.mapInArrow(_assign(centres), "v long, copies long, vec array<float>, cell long, far double")
                     if dict(vectors.dtypes)["vec"] == "array<float>" else
                     vectors.mapInArrow(_assign(centres), "v long, copies long, vec array<double>, cell long, far double"), "cells")
    stats = {r.cell: r for r in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()}  # MAX_CELLS rows
    radii = np.array([stats[c].far if c in stats else -9.0 for c in range(len(centres))])
    blocks = np.array([-(-stats[c].n // BLOCK) if c in stats else 0 for c in range(len(centres))])
    count = F.lit(1).cast("long")
    for c, b in enumerate(blocks):
        if b > 1:
            count = F.when(F.col("cell") == c, F.lit(int(b)).cast("long")).otherwise(count)
    blocked = placed.withColumn("block", F.pmod(F.xxhash64("v", F.lit(3)), count)).drop("far")
    kind = dict(vectors.dtypes)["vec"]
    sent = blocked.mapInArrow(_send(centres, radii, blocks, threshold), f"cell long, block long, visits boolean, v long, copies long, vec {kind}")
    return (sent.repartition("cell", "block").sortWithinPartitions("cell", "block", "visits").mapInArrow(_compare(threshold), _FOUND))


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of (vec_id, embedding)."""
    spark = rows.sparkSession
    prepare(spark)
    base = rows.select("vec_id", F.when(usable().isNotNull(), F.col("embedding")).alias("vec"))
    named = base.withColumn("v", F.xxhash64("vec"))
    classes = written(named.where("vec is not null").groupBy("v", "vec").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
                      .withColumn("dim", F.size("vec")), "vectors")
    found = None
    for r in classes.select("dim").distinct().orderBy("dim").collect():  # one length as a rule
        one = near_links(classes.where(F.col("dim") == r.dim).select("v", "copies", "vec"), threshold)
        found = one if found is None else found.unionByName(one)
    found = written(found if found is not None else spark.createDataFrame([], _FOUND), "vector-links")
    counts = found.groupBy("v").agg(F.sum("links").cast("long").alias("links"))
    comp = components(found.where("v <> other").select(F.col("v").alias("u"), F.col("other").alias("v")), "vectors")
    labelled = (classes.select("v", "copies", "least").join(comp.withColumnRenamed("node", "v"), "v", "left").join(counts, "v", "left")
                .select("v", "least", F.coalesce("component", "v").alias("comp"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    labelled = written(labelled, "vector-labels")
    least = written(labelled.groupBy("comp").agg(F.min("least").alias("component_id")), "vector-least")
    ids = written(labelled.join(least, "comp").select("v", "n_links", "component_id"), "vector-ids")
    out = named.select("vec_id", F.when(F.col("vec").isNotNull(), F.col("v")).alias("v")).join(ids, "v", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def op1_cover_tree(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
