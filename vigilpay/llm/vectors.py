"""Embedding near-duplicates through an inverted multi-index.

Unit vectors are cut into halves with a codebook each; a pair of codes is a cell
of the product grid.  Every vector lies in the cell of its nearest codes and
visits cells in the order of distance, which a multi-sequence traversal over the
two sorted code lists gives.  How many it visits is set so that the target
recall is reached for pairs right at the threshold, which are the hardest.
Vectors that meet in a cell are compared in double precision; only pairs with
the cosine asked for link.

Equal vectors are one row with a number, so copies never meet.  Codebooks are
fitted on a bounded sample (``SAMPLE``), every vector is indexed.  A cell with
many vectors is compared in pairs of blocks.  Of a block, only link counts and a
spanning set of links leave the task.

Defined results: a vector that is null, zero or holds a null or non-finite
component links with nothing and is its own component; so does a row without an
id, which has no component; vectors of different lengths are compared as if the
shorter went on with zeros; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilpay.llm.common import stage
from vigilpay.llm.components import components

COSINE = 0.95
RECALL = 0.98
#: Vectors the codebooks and the number of visits are fitted on.
SAMPLE = 16_384
MOST_CODES = 256
BLOCK = 2048


@dataclass
class MultiIndex:
    """Codebooks of both halves (at most ``MOST_CODES`` codes each) and the number of cells to visit."""

    first: np.ndarray
    second: np.ndarray
    visits: int

    @property
    def codes(self) -> int:
        return len(self.first)

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _squares(unit[:, :half], self.first), _squares(unit[:, half:], self.second)

    def traverse(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """Cells in the order of distance, ``visits`` per vector (fewer if there are fewer).

        The cell of the a-th and the b-th nearest code follows all cells of
        nearer codes, so only places with a * b <= visits can be among them.
        """
        one, two = self.distances(unit)
        near_one, near_two = np.argsort(one, axis=1, kind="stable"), np.argsort(two, axis=1, kind="stable")
        a, b = (x.ravel() for x in np.meshgrid(np.arange(self.codes), np.arange(len(self.second)), indexing="ij"))
        stairs = (a + 1) * (b + 1) <= visits
        a, b = a[stairs], b[stairs]
        rows = np.arange(len(unit))[:, None]
        far = one[rows, near_one[:, a]] + two[rows, near_two[:, b]]
        order = np.argsort(far, axis=1, kind="stable")[:, :visits]
        return near_one[rows, a[order]] * len(self.second) + near_two[rows, b[order]]


def _squares(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ codes.T + (codes**2).sum(axis=1)


def _codebook(points: np.ndarray, codes: int, random: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = points[random.choice(len(points), codes, replace=False)].copy()
    for _ in range(rounds):
        own = _squares(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=codes)
        some = sizes > 0
        centres[some] = sums[some] / sizes[some][:, None]
    return centres


def fit(sample: np.ndarray, total: int, cosine: float = COSINE, recall: float = RECALL) -> MultiIndex:
    """Codebooks and visits from a sample of unit vectors; ``total`` is the number of vectors to index."""
    random = np.random.default_rng(4)
    half = max(1, sample.shape[1] // 2)
    codes = 1
    while codes < MOST_CODES and (2 * codes) ** 2 <= total / 8 and 32 * codes <= len(sample):
        codes *= 2
    second = sample[:, half:] if sample.shape[1] > half else np.zeros((len(sample), 1))
    index = MultiIndex(_codebook(sample[:, :half], codes, random), _codebook(second, codes, random), codes * codes)
    # partners right at the threshold, in random directions
    base = sample[random.choice(len(sample), 2000)]
    away = random.normal(size=base.shape)
    away -= (away * base).sum(axis=1)[:, None] * base
    away /= np.maximum(np.linalg.norm(away, axis=1), 1e-300)[:, None]
    partner = cosine * base + np.sqrt(1 - cosine**2) * away
    home = index.traverse(partner, 1)
    visits = 4
    while visits < codes * codes:
        found = (index.traverse(base, visits) == home).any(axis=1).mean()
        if found >= recall:
            break
        visits *= 2
    # between the last two powers of two, the smallest that does
    low, high = visits // 2, min(visits, codes * codes)
    while high - low > 1:
        middle = (low + high) // 2
        if (index.traverse(base, middle) == home).any(axis=1).mean() >= recall:
            high = middle
        else:
            low = middle
    index.visits = high
    return index


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of an Arrow list column in double precision, filled up with zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == width).all():
        return values[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(lengths), width))
    for i, (a, n) in enumerate(zip(offsets, lengths)):
        out[i, :n] = values[a : a + n]
    return out


def _assign(classes: DataFrame, index: MultiIndex, width: int) -> DataFrame:
    """``classes`` with the cells that each vector visits, its own first."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                cells = index.traverse(_unit(_matrix(batch.column(2), width)), index.visits).astype(np.int32)
                offsets = pa.array(np.arange(len(cells) + 1) * cells.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(cells.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["node", "m", "v", "visits"])

    return classes.select("node", "m", "v").mapInArrow(run, "node long, m long, v array<double>, visits array<int>")


def _compare(width: int, cosine: float):
    """Rows sorted by (cell, block of members, block of visitors, role) to link counts and spanning links."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        member = rows["role"].to_numpy() == 0
        node, m = rows["node"].to_numpy(), rows["m"].to_numpy()
        unit = _unit(_matrix(rows["v"].combine_chunks(), width)) if len(rows) else np.zeros((0, width))
        mine, theirs = np.flatnonzero(member), np.flatnonzero(~member)
        near = unit[theirs] @ unit[mine].T >= cosine
        near &= node[theirs][:, None] != node[mine][None, :]
        q, p = np.nonzero(near)
        # a member that visits the visitor's own cell counts this link over there
        home = rows["home"].to_numpy()[theirs]
        reach = rows["visits"].combine_chunks().take(pa.array(mine))
        spans, cells = reach.offsets.to_numpy(), reach.values.to_numpy()
        cells = cells[spans[0] : spans[-1]].reshape(len(mine), -1) if len(mine) else np.zeros((0, 1))
        back = np.zeros(len(q), bool)
        for lo in range(0, len(q), 1 << 16):
            back[lo : lo + (1 << 16)] = (cells[p[lo : lo + (1 << 16)]] == home[q[lo : lo + (1 << 16)]][:, None]).any(axis=1)
        links = np.zeros(len(node), np.int64)
        np.add.at(links, theirs[q], m[mine[p]])
        np.add.at(links, mine[p[~back]], m[theirs[q[~back]]])
        label = np.arange(len(node))
        while len(q):
            new = label.copy()
            np.minimum.at(new, theirs[q], label[mine[p]])
            np.minimum.at(new, mine[p], new[theirs[q]])
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        some = links > 0
        some[theirs[q]] = some[mine[p]] = True
        return pa.RecordBatch.from_arrays(
            [pa.array(node[some]), pa.array(links[some]), pa.array(node[label[some]])], names=["node", "links", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held)
            keys = np.stack([table[k].to_numpy() for k in ("cell", "mine", "theirs")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip(np.r_[0, cuts[:-1]], cuts):
                yield block(table.slice(a, b - a))
            held = [table.slice(cuts[-1] if len(cuts) else 0)]
        if held:
            yield block(pa.concat_tables(held))

    return run


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """One row per vector: id, ``n_links`` to other vectors, ``component_id`` and ``kept``."""
    # 0.0 is added so that the two zeros are equal
    vectors = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(embedding, lambda x: x.cast("double") + F.lit(0.0)).alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    good = vectors.filter(usable & F.col("vec_id").isNotNull())
    classes = stage(good.groupBy("v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("m")), "vector-classes")
    total, width = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if total:
        draw = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
        sample = classes.filter(draw < min(1.0, SAMPLE / total)).select("v").toArrow()["v"].combine_chunks()
        if not len(sample):
            sample = classes.select("v").limit(1).toArrow()["v"].combine_chunks()
        index = fit(_unit(_matrix(sample, width)), total, cosine, recall)
        placed = stage(_assign(classes, index, width).withColumn("home", F.element_at("visits", 1)), "vector-cells")
        # at most one row per cell, MOST_CODES squared of them
        members = placed.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("mine_n"))
        visitors = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("theirs_n"))
        sizes = F.broadcast(members.join(visitors, F.col("home") == F.col("cell")).select("cell", "mine_n", "theirs_n"))
        own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        columns = ["cell", "mine", "theirs", "role", "node", "m", "home", "visits", "v"]
        none = F.lit(None).cast("array<int>")
        inside = placed.join(sizes, F.col("home") == F.col("cell")).select(
            "*", own("mine_n").alias("mine"), every("theirs_n").alias("theirs"), F.lit(0).alias("role")
        )
        outside = placed.withColumn("at", F.explode("visits")).join(sizes, F.col("at") == F.col("cell")).select(
            *[c for c in ("cell", "node", "m", "home", "v", "theirs_n")], none.alias("visits"),
            own("theirs_n").alias("theirs"), every("mine_n").alias("mine"), F.lit(1).alias("role"),
        )
        blocks = inside.select(*columns).unionByName(outside.select(*columns))
        keys = ["cell", "mine", "theirs"]
        met = blocks.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(
            _compare(width, cosine), "node long, links long, root long"
        )
        met = stage(met, "vector-links")
        counts = met.groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("links"))
        groups = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
        classes = (
            classes.join(counts, F.col("node") == F.col("id"), "left").drop("id")
            .join(groups.withColumnRenamed("node", "id"), F.col("node") == F.col("id"), "left")
            .select("node", "m", F.col("v").alias("u"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
        )
    else:
        classes = classes.select("node", "m", F.col("v").alias("u"), F.lit(0).alias("links"), F.col("node").alias("component"))
    key = lambda c: F.xxhash64(c)
    named = good.withColumn("h", key("v")).join(classes.withColumn("k", key("u")), (F.col("h") == F.col("k")) & (F.col("v") == F.col("u")))
    found = named.select("vec_id", (F.col("links") + F.col("m") - 1).cast("long").alias("n_links"), F.col("component").alias("component_id"))
    rest = vectors.filter(~usable | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
