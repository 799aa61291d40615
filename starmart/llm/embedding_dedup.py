"""Near duplicates among embeddings (op11) by an inverted multi-index.

Vectors are scaled to length 1 and cut into halves. Each half has a codebook of
its own (k-means on a bounded sample), and the pairs of codes form a grid of
cells; a vector's home is its nearest cell. From a vector, a multi-sequence
traversal visits cells by increasing distance: half distances are sorted, and
rank (a, b) is reached after (a - 1, b) and (a, b - 1). It ends where the excess
over the home cell passes a radius. The radius is calibrated: partners are made
at exactly the threshold from sampled vectors, in random directions and towards
other vectors, and it is the quantile of the excess of their home cells at the
target recall. Real partners are nearer, so recall is higher. With
``recall=1.0`` every cell is visited, which is exact.

Two vectors of different cells meet once, in the cell with the smaller code, so
a vector visits cells up to its own only. What a cell holds is compared in
double precision by blocks of matrix products inside tasks: a tile is a run of
neighbouring cells with at most ``TILE_HOMES`` residents and ``TILE_VISITS``
visits; a larger cell is split into a grid of tiles by hashes. A task sends
sums of links per vector and the edges of a spanning forest, never the pairs;
all links are counted, without caps. Tiles of a group of r vectors that are all
near each other take r squared products, as the number of its links does.

Equal vectors form a class, which is indexed once. The cell table (one row per
cell) is broadcast up to ``MAX_BROADCAST_ROWS`` and joined by a shuffle beyond.
On the driver: the sample, at most max(``SAMPLE``, 32 per code) vectors; the
number of codes per half grows with the square root of the vectors.

Odd rows. Null or empty vectors, and those of zero length or with null or
non-finite components, link with nothing. Vectors of unequal lengths do not
link (the shorter one is filled with zeros in the index only). Repeated rows
count as vectors of their own; a null vec_id has no say in a component's id,
which is null if all its ids are. ``kept`` is the null-safe equality of vec_id
and component id. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from starmart.llm.common import broadcast_within, persist, table, tidy
from starmart.llm.components import components

THRESHOLD, RECALL = 0.95, 0.99
#: Vectors per cell on average, which sets the number of codes.
CELL = 512
#: Vectors fitted on, at least; and of them, those that calibrate the radius.
SAMPLE, CALIBRATED = 8192, 4096
ROUNDS = 12
TILE_HOMES, TILE_VISITS = 4096, 16384
#: Products held at once in a tile.
BLOCK = 1 << 21
MAX_BROADCAST_ROWS = 200_000


# ---------------------------------------------------------------------- index

def matrix(vectors: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (float64), filled with zeros to one width, and their lengths."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.empty(0, np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=1)) if width is None else width
    x = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    x[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    x /= np.abs(x).max(axis=1, initial=0, keepdims=True)  # so that squares stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)), sizes


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances, without the part that all codes share."""
    return (codes * codes).sum(axis=1) - 2 * x @ codes.T


def _codebook(x: np.ndarray, k: int, rng) -> np.ndarray:
    """k-means of the distinct rows of ``x``; a code that loses its rows starts anew."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    codes = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = _distances(x, codes).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        sums = np.add.reduceat(x[order], np.minimum(np.cumsum(n) - n, len(x) - 1), axis=0)
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(len(x), size=k)])
    return codes


@dataclass
class MultiIndex:
    codes: list[np.ndarray]  # of the first and of the second half
    radius: float

    @property
    def width(self) -> int:
        return sum(c.shape[1] for c in self.codes)

    def excess(self, x: np.ndarray) -> list[np.ndarray]:
        """Per half, how much farther each code is than the nearest one."""
        cut = self.codes[0].shape[1]
        d = [_distances(x[:, :cut], self.codes[0]), _distances(x[:, cut:], self.codes[1])]
        return [z - z.min(axis=1, keepdims=True) for z in d]

    def home(self, excess: list[np.ndarray]) -> np.ndarray:
        return excess[0].argmin(axis=1) * len(self.codes[1]) + excess[1].argmin(axis=1)

    def visits(self, excess: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, excess) in the order of the traversal of each row."""
        ranks = [np.argsort(z, axis=1, kind="stable") for z in excess]
        near = [np.take_along_axis(z, r, axis=1) for z, r in zip(excess, ranks)]
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        a, rows = 0, np.arange(len(excess[0]))
        while len(rows) and a < near[0].shape[1]:  # rank a of the first half, then ranks b of the second
            rows = rows[near[0][rows, a] <= self.radius]
            b, here = 0, rows
            while len(here) and b < near[1].shape[1]:
                total = near[0][here, a] + near[1][here, b]
                here, total = here[total <= self.radius], total[total <= self.radius]
                out.append((here, ranks[0][here, a] * len(self.codes[1]) + ranks[1][here, b], total))
                b += 1
            a += 1
        row, cell, total = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((cell, total, row))
        return row[order], cell[order], total[order]


def fit(x: np.ndarray, n: int, threshold: float, recall: float, seed: int = 1) -> MultiIndex:
    """Codebooks and radius from the sample ``x`` of ``n`` unit vectors."""
    rng = np.random.default_rng(seed)
    k, cut = max(1, int(np.ceil(np.sqrt(n / CELL)))), x.shape[1] // 2
    index = MultiIndex([_codebook(x[:, :cut], k, rng), _codebook(x[:, cut:], k, rng)], np.inf)
    if recall >= 1:
        return index
    y = x[rng.permutation(len(x))[:CALIBRATED]]
    excess, gaps = index.excess(y), []
    for away in (rng.standard_normal(y.shape), x[rng.integers(len(x), size=len(y))]):
        away = away - (away * y).sum(axis=1, keepdims=True) * y
        size = np.sqrt((away * away).sum(axis=1, keepdims=True))
        partner = threshold * y + np.sqrt(max(0.0, 1 - threshold ** 2)) * away / np.maximum(size, 1e-12)
        i, j = np.divmod(index.home(index.excess(partner)), len(index.codes[1]))
        rows = np.arange(len(y))
        gaps.append((excess[0][rows, i] + excess[1][rows, j])[size[:, 0] > 1e-9])
    index.radius = max((float(np.quantile(g, recall)) for g in gaps if len(g)), default=np.inf)
    return index


# ---------------------------------------------------------------------- tasks

FOUND_SQL = "node long, root long, links long"
FOUND = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _place(index: MultiIndex):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                x, _ = matrix(part.column("embedding"), index.width)
                excess = index.excess(x)
                home = index.home(excess)
                row, cell, _ = index.visits(excess)
                mine = cell <= home[row]
                row, cell = row[mine], cell[mine]
                n = np.r_[0, np.cumsum(np.bincount(row, minlength=len(x)))]
                visits = pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.array(cell, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home, pa.int32()), visits],
                                                 names=[*part.schema.names, "home", "visits"])
    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node joined with each of n nodes by the edges (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(threshold: float):
    """A tile: rows of residents (visit false) and visitors of its cells."""
    def run(rows: pa.Table) -> pa.Table:
        visitor = rows.column("visitor").to_numpy(zero_copy_only=False)
        cell, home = rows.column("cell").to_numpy(), rows.column("home").to_numpy()
        node, local = np.unique(rows.column("node").to_numpy(), return_inverse=True)
        size = rows.column("size").to_numpy()
        x, sizes = matrix(rows.column("embedding"))
        links, one_size = np.zeros(len(node), np.int64), sizes.min(initial=0) == sizes.max(initial=0)
        edges_a, edges_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for c in np.unique(cell[~visitor]):
            r, q = np.flatnonzero(~visitor & (cell == c)), np.flatnonzero(visitor & (cell == c))
            step = max(1, BLOCK // max(1, len(r)))
            for at in range(0, len(q), step):
                p = q[at:at + step]
                hit = x[p] @ x[r].T >= threshold
                # inside a cell a pair is met from both sides: the larger node counts it
                hit &= (home[p] != c)[:, None] | (local[p][:, None] > local[r][None, :])
                if not one_size:
                    hit &= sizes[p][:, None] == sizes[r][None, :]
                i, j = np.nonzero(hit)
                if not len(i):
                    continue
                np.add.at(links, local[p], hit @ size[r])
                np.add.at(links, local[r], size[p] @ hit)
                near = np.unique(np.r_[local[p], local[r]])
                label = near[forest(np.searchsorted(near, local[p][i]), np.searchsorted(near, local[r][j]), len(near))]
                apart = label != near
                edges_a.append(near[apart])
                edges_b.append(label[apart])
        label = forest(np.concatenate(edges_a), np.concatenate(edges_b), len(node))
        found = links > 0
        cols = [node[found], node[label][found], links[found]]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=FOUND)
    return run


# ----------------------------------------------------------------------- jobs

def _valid(v):
    return (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))) \
        & F.exists(v, lambda e: e != 0)


def _tiles(placed: DataFrame) -> DataFrame:
    """Per cell with residents: its tile, and into how many parts its residents
    and its visitors are split (more than one only in a cell of its own tile)."""
    homes = placed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("homes"))
    visits = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count("*").alias("visits"))
    cells = homes.join(visits, "cell").withColumn("large", (F.col("homes") > TILE_HOMES) | (F.col("visits") > TILE_VISITS))
    # blocks of 256 neighbouring cells are packed into tiles by running sums
    before = "(PARTITION BY cell div 256, large ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    run = F.expr(f"coalesce(sum(homes) OVER {before} div {TILE_HOMES}, 0) + coalesce(sum(visits) OVER {before} div {TILE_VISITS}, 0)")
    return cells.select(
        "cell", F.when(F.col("large"), -1 - F.col("cell").cast("long")).otherwise(F.expr("cell div 256") * 1_000_000 + run).alias("tile"),
        F.when(F.col("large"), F.ceil(F.col("homes") / TILE_HOMES)).otherwise(1).cast("int").alias("parts"),
        F.when(F.col("large"), F.ceil(F.col("visits") / TILE_VISITS)).otherwise(1).cast("int").alias("turns"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id,
    embedding), links being pairs of a cosine of at least ``threshold``."""
    spark = vectors.sparkSession
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    vectors = vectors.select("vec_id", F.when(_valid(F.col("embedding")), F.col("embedding")).alias("embedding"))
    classes = vectors.filter("embedding IS NOT NULL").groupBy("embedding").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
    classes = persist(classes.select(F.monotonically_increasing_id().alias("node"), "embedding", "size", "least", *key), "vectors")
    n, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not n:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    most = max(SAMPLE, 32 * int(np.ceil(np.sqrt(n / CELL))))
    sample = classes.orderBy("h1", "h2").limit(most).select("embedding").toArrow()
    index = fit(matrix(sample.column(0), width)[0], n, threshold, recall)
    whole = classes.select("node", "size", "embedding")
    schema = StructType([*whole.schema, StructField("home", IntegerType()), StructField("visits", ArrayType(IntegerType()))])
    placed = persist(whole.mapInArrow(tidy(_place(index)), schema), "cells")
    tiles = broadcast_within(persist(_tiles(placed), "tiles"), MAX_BROADCAST_ROWS)

    residents = placed.select("node", "embedding", "size", "home", F.col("home").alias("cell"), F.lit(False).alias("visitor")).join(tiles, "cell") \
        .withColumn("part", F.pmod(F.xxhash64("node"), "parts")).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    visitors = placed.select("node", "embedding", "size", "home", F.explode("visits").alias("cell"), F.lit(True).alias("visitor")).join(tiles, "cell") \
        .withColumn("turn", F.pmod(F.xxhash64("node", F.lit(2)), "turns")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cols = ["tile", F.col("part").cast("int").alias("part"), F.col("turn").cast("int").alias("turn"), "cell", "visitor", "node", "home", "size", "embedding"]
    found = persist(residents.select(*cols).unionByName(visitors.select(*cols)).groupBy("tile", "part", "turn")
                    .applyInArrow(_compare(threshold), FOUND_SQL), "links")

    member = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("node", "size", "least", "h1", "h2") \
        .join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(member, "node", "left") \
        .filter("links IS NOT NULL OR size > 1").withColumn("comp", F.coalesce("comp", "node"))
    known = persist(known, "linked")
    least = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = persist(known.join(least, "comp").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"), "answers")
    all_rows = vectors.select("vec_id", F.col("embedding").isNotNull().alias("valid"), *key)
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return all_rows.join(known.withColumn("valid", F.lit(True)), ["h1", "h2", "valid"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
