"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are halved; each half has a codebook of its own, and the pairs of
codes form a grid of cells. A vector is stored in the cell of its nearest codes
and visits cells in multi-sequence order: by the sum of its squared distances
to the two codes, nearest first. How many cells are visited follows from a
target recall, measured on probes against all others, each linked probe counting
alike. Probes are drawn by hash until LINKED of them have a link or all entries
are probes. If MOST probes do not hold that many, nothing is measured: each
vector then visits every cell that can hold a vector of cosine SIMILARITY to it,
by its distance to the cell's borders, and no link is lost.
Vectors that meet in a cell are compared exactly, in double precision.

Equal vectors of one label are one entry with a weight, so copies cost nothing.
Only the codebooks (fitted on SAMPLE vectors) and the probes (at most ROUND at a
time) reach the driver; every vector is indexed. Cells of any size are cut
into chunks of CHUNK entries that are compared chunk against chunk, so no group
is large; a chunk's output is a count per vector and a spanning forest, not its
pairs. A pair that both vectors would find is counted once for each of them,
because a vector's visits follow from its own codes alone.

Cases: a vector that is null, zero, or holds nulls or non-finite components,
and one with a null label, links with nothing and is its own component. Vectors
shorter than the longest are padded with zeros. A row with a null id links with
nothing and is kept. Rows that repeat an id count as vectors of their own.
Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common
from quern.llm.components import components, roots

SIMILARITY = 0.93
TARGET_RECALL = 0.998
SAMPLE = 20_000
#: Probes of the first round and of each one after it, linked ones needed, and all that are drawn (about).
PROBES = 1_000
ROUND = 8_000
LINKED = 500
MOST = 65_536
CHUNK = 512
ROUNDS = 12
SEED = 5


def codebook(half: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres of the rows."""
    k = min(k, len(half))
    centres = half[rng.choice(len(half), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = distances(half, centres).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, half)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def distances(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return np.maximum((half * half).sum(1)[:, None] - 2 * half @ centres.T + (centres * centres).sum(1)[None, :], 0)


def borders(near: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """From squared distances to the centres, squared distances at least to what each centre is the nearest of."""
    least = np.zeros_like(near)
    for a in range(len(centres)):
        gap = np.sqrt(((centres - centres[a]) ** 2).sum(1))
        gap[gap < 1e-6] = np.inf  # no border between centres that rounding cannot tell apart
        np.maximum(least, (near - near[:, a:a + 1]) / (2 * gap), out=least)
    return least * least


def sequence(first: np.ndarray, second: np.ndarray, n: int) -> list[tuple[float, int]]:
    """The n cells with the smallest sums of the two distances, nearest first, as (sum, cell)."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < n:
        total, i, j = heapq.heappop(heap)
        out.append((float(total), int(a[i]) * len(second) + int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros."""
    out = np.zeros((len(column), width))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    n = np.diff(offsets)
    if len(n) and (n == width).all():
        return values[offsets[0]:offsets[-1]].reshape(len(column), width).astype(np.float64)
    for i in range(len(column)):
        out[i, :n[i]] = values[offsets[i]:offsets[i + 1]]
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)  # squares neither vanish nor overflow
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def entries(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows with the key of their vector, one entry per label and distinct vector)."""
    good = (F.col("_vec").isNotNull() & F.col("_label").isNotNull() & F.col("_id").isNotNull()
            & ~F.exists("_vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("_vec", lambda x: x != 0))
    rows = vectors.where(good).withColumn("_key", F.xxhash64("_label", "_vec")).withColumn("_key2", F.xxhash64(F.lit(1), "_vec", "_label"))
    distinct = rows.groupBy("_key", "_key2").agg(F.min("_id").alias("eid"), F.count(F.lit(1)).alias("weight"),
                                                 F.first("_label").alias("label"), F.first("_vec").alias("vec"))
    return rows.select("_id", "_key", "_key2"), distinct


class Grid:
    """Two codebooks and the number of cells that each vector visits, 0 for all that can hold a link."""

    def __init__(self, first: np.ndarray, second: np.ndarray, width: int, visits: int = 1):
        self.first, self.second, self.width, self.visits = first, second, width, visits

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.width // 2
        return distances(rows[:, :cut], self.first), distances(rows[:, cut:], self.second)

    def cells(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.halves(rows)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def reachable(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells that can hold a vector of cosine SIMILARITY to the row."""
        a, b = (borders(d, c) for d, c in zip(self.halves(rows), (self.first, self.second)))
        near = a[:, :, None] + b[:, None, :] <= 2 * (1 - SIMILARITY) + 1e-6
        return np.nonzero(near.reshape(len(rows), len(self.first) * len(self.second)))

    def ranks(self, probe: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells a probe visits until it reaches each of the given ones."""
        a, b = (x[0] for x in self.halves(probe[None, :]))
        order = sequence(a, b, len(self.first) * len(self.second))
        rank = {cell: i + 1 for i, (_, cell) in enumerate(order)}
        return np.array([rank[c] for c in cells.tolist()], np.int64)


def _fit(distinct: DataFrame, target: float) -> Grid | None:
    """Codebooks from a bounded sample, visits from the neighbours of a bounded sample among all entries."""
    n, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return None
    width += width % 2
    picked = distinct.orderBy(F.xxhash64("eid", F.lit(SEED)), "eid").limit(SAMPLE).select("vec", "label").toArrow()
    sample = unit(matrix(picked["vec"].combine_chunks(), width))
    k = int(min(512, 2 ** max(1, round(np.log2(max(n, 2)) / 4))))
    rng = np.random.default_rng(SEED)
    grid = Grid(codebook(sample[:, :width // 2], k, rng), codebook(sample[:, width // 2:], k, rng), width)
    found, total, lo, hi = [], {}, 0, PROBES
    while lo < min(n, MOST) and len(total) < LINKED:
        # In order of hash, as the sample; the rounds cut the range of hashes.
        low, high = (min(x, n) * (1 << 64) // n - (1 << 63) for x in (lo, hi))
        drawn = distinct.where(F.xxhash64("eid", F.lit(SEED)).between(low, high - 1)).select("eid", "label", "vec").toArrow()
        for probe, rank, count in _ranks(distinct, grid, drawn):
            found.append((rank, (lo, probe), count))
            total[lo, probe] = total.get((lo, probe), 0) + count
        lo, hi = hi, hi + ROUND
    if len(total) < LINKED and lo < n:
        grid.visits = 0
        return grid
    # Every linked probe counts alike, however many neighbours it has.
    recall = 0.0
    for rank, probe, count in sorted(found):
        if rank > grid.visits and recall >= target - 1e-9:
            break
        recall += count / total[probe] / len(total)
        grid.visits = int(rank)
    return grid


def _ranks(distinct: DataFrame, grid: Grid, drawn: pa.Table) -> list[tuple[int, int, int]]:
    """(probe, rank, n): entries linked to each drawn one, by how many cells it visits until it reaches them."""
    if not drawn.num_rows:
        return []
    probes = unit(matrix(drawn["vec"].combine_chunks(), grid.width))
    shared = distinct.sparkSession.sparkContext.broadcast((grid, probes, drawn["label"].to_numpy(), drawn["eid"].to_numpy()))

    def run(batch):
        own, probes, labels, eids = shared.value
        rows, label, eid = unit(matrix(batch.column(0), own.width)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        found, cells = [], own.cells(rows)
        for lo in range(0, len(probes), 1024):
            part = slice(lo, lo + 1024)
            near = (probes[part] @ rows.T >= SIMILARITY) & (labels[part, None] == label[None, :]) & (eids[part, None] != eid[None, :])
            for i in np.flatnonzero(near.any(1)):
                rank, n = np.unique(own.ranks(probes[lo + i], cells[near[i]]), return_counts=True)
                found += [(int(lo + i), int(r), int(c)) for r, c in zip(rank, n)]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["probe", "rank", "n"])

    rows = distinct.select("vec", F.col("label").cast("bigint").alias("label"), "eid")
    return [tuple(r) for r in common.map_arrow(rows, run, "probe bigint, rank bigint, n bigint")
            .groupBy("probe", "rank").agg(F.sum("n")).collect()]  # a probe's ranks: cells at most


def _visits(distinct: DataFrame, grid: Grid) -> DataFrame:
    """kind 0: the entry in its own cell; kind 1: the entry in each cell that it visits."""
    shared = distinct.sparkSession.sparkContext.broadcast(grid)

    def run(batch):
        own = shared.value
        step = 2048 if own.visits else max(1, min(2048, (1 << 22) // (len(own.first) * len(own.second))))
        most = max(1, (1 << 22) // own.width)
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            rows = unit(matrix(part.column(2), own.width))
            a, b = own.halves(rows)
            home = a.argmin(1) * len(own.second) + b.argmin(1)
            if own.visits:
                at, cell, reach = [], [], np.empty(len(rows))
                for i in range(len(rows)):
                    order = sequence(a[i], b[i], own.visits)
                    reach[i] = order[-1][0]
                    at += [i] * len(order)
                    cell += [c for _, c in order]
                at, cell = np.array(at), np.array(cell, np.int64)
            else:  # of two cells that can reach each other, the first one's entries visit the second
                at, cell = own.reachable(rows)
                at, cell, reach = at[cell >= home[at]], cell[cell >= home[at]], np.full(len(rows), np.inf)
            made = [(0, np.arange(len(rows)), home)] + [(1, at[i:i + most], cell[i:i + most]) for i in range(0, len(at), most)]
            for kind, index, cells in made:
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(index) + 1) * own.width, own.width, dtype=np.int32)),
                                                pa.array(rows[index].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), kind, np.int32)), pa.array(cells), part.column(1).take(pa.array(index)),
                     part.column(0).take(pa.array(index)), part.column(3).take(pa.array(index)), pa.array(home[index]),
                     pa.array(reach[index]), flat], ["kind", "cell", "label", "eid", "weight", "home", "reach", "vec"])

    rows = distinct.select("eid", F.col("label").cast("bigint").alias("label"), "vec", "weight")
    return common.map_arrow(rows, run, "kind int, cell bigint, label bigint, eid bigint, weight bigint, home bigint, reach double, vec array<double>")


def _compared(visits: DataFrame, grid: Grid) -> DataFrame:
    """(a, b, n): links as a forest (b not null) and the weight of linked entries per entry (n)."""
    shared = visits.sparkSession.sparkContext.broadcast(grid)
    chunks = visits.groupBy("label", "cell").agg(
        *[F.ceil(F.count(F.when(F.col("kind") == k, 1)) / CHUNK).cast("int").alias(f"n{k}") for k in (0, 1)])
    number = F.pmod(F.xxhash64("eid"), F.when(F.col("kind") == 0, F.col("n0")).otherwise(F.col("n1"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("kind") == 0, F.col("n1")).otherwise(F.col("n0")) - 1))
    dealt = (visits.join(chunks.where("n0 > 0 AND n1 > 0"), ["label", "cell"]).withColumn("own", number).withColumn("other", others)
             .withColumn("i", F.when(F.col("kind") == 0, F.col("own")).otherwise(F.col("other")))
             .withColumn("j", F.when(F.col("kind") == 0, F.col("other")).otherwise(F.col("own")))
             .drop("n0", "n1", "own", "other"))

    def compare(group):
        own, kind = shared.value, group["kind"].to_numpy()
        group = group.combine_chunks()
        rows = matrix(group["vec"].combine_chunks() if isinstance(group["vec"], pa.ChunkedArray) else group["vec"], own.width)
        eid, weight, home, reach = (group[c].to_numpy() for c in ("eid", "weight", "home", "reach"))
        x, q = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        if not len(x) or not len(q):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        linked = (rows[q] @ rows[x].T >= SIMILARITY) & (eid[q][:, None] != eid[x][None, :])
        i, j = np.nonzero(linked)
        # Does the stored entry visit the visitor's home, and so count the pair there?
        if own.visits:
            first, second = own.halves(rows[x])
            back = first[:, home[q] // len(own.second)] + second[:, home[q] % len(own.second)]
            once = linked & ~(back.T <= reach[x][None, :] + 1e-9)  # rounding must not hide the last cell visited
        else:
            once = linked & (home[q][:, None] != home[x][None, :])
        count = np.concatenate([linked @ weight[x], once.T @ weight[q]])
        who = np.concatenate([eid[q], eid[x]])
        node, root = roots(eid[q][i], eid[x][j])
        node, root = node[node != root], root[node != root]
        who, count = who[count > 0], count[count > 0]
        return pa.table({"a": pa.array(np.concatenate([node, who])), "n": pa.array(np.concatenate([np.zeros(len(node), np.int64), count])),
                         "b": pa.concat_arrays([pa.array(root), pa.nulls(len(who), pa.int64())])}).select(["a", "b", "n"])

    return dealt.groupBy("label", "cell", "i", "j").applyInArrow(compare, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 target_recall: float = TARGET_RECALL) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` (smallest id reached) and ``kept``."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("_id"), F.col(f"`{embedding}`").cast("array<double>").alias("_vec"),
                          F.xxhash64(F.col(f"`{label}`").cast("string")).alias("_hash"), F.col(f"`{label}`").alias("_name"))
    rows = rows.withColumn("_label", F.when(F.col("_name").isNotNull(), F.col("_hash"))).drop("_hash", "_name")
    keyed, distinct = entries(rows)
    distinct = common.kept(distinct, "vectors")
    grid = _fit(distinct, target_recall)
    if grid is None:
        return rows.select(F.col("_id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    found = common.kept(_compared(_visits(distinct, grid), grid), "vector-links")
    own = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "eid")
    classes = (distinct.select("_key", "_key2", "eid", "weight").join(counts, "eid", "left").join(own.withColumnRenamed("node", "eid"), "eid", "left")
               .select("_key", "_key2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "eid").alias("component")))
    linked = keyed.join(classes, ["_key", "_key2"]).select(F.col("_id").alias("vec_id"), "n_links", F.col("component").alias("component_id"))
    valid = F.col("_vec").isNotNull() & F.col("_label").isNotNull() & F.col("_id").isNotNull()
    bad = ~(valid & F.coalesce(~F.exists("_vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("_vec", lambda x: x != 0), F.lit(False)))
    alone = rows.where(bad).select(F.col("_id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
