"""Hard negatives by a vantage-point tree over norm-augmented vectors.

Each vector x gets one more component, sqrt(M * M - |x| * |x|) with M the largest norm, and an anchor q the component zero. Then
the squared distance of the two is M * M + |q| * |q| - 2 * score: a window of scores is an annulus around the anchor, and nearer
is a higher score. A node of the tree splits its rows by their distance from a vantage point, so that the triangle inequality
bounds the distance of an anchor from all rows below it.

The top of the tree is fitted on at most about SAMPLE rows; every row is then led to its cell, and cells of many rows are cut
into parts. A search has two waves: each anchor first visits the cell it falls into, which narrows its annuli to what can still
be among the first K; then all other cells whose bounds meet what is left. In a cell a tree of its own is walked leaf by leaf,
nearest first, until no leaf can hold more. Scores are inner products of whole numbers and decide alone; distances only tell
what to visit, with slack for rounding. So the result is exact, however little the tree prunes: vectors without structure make
the waves compare all anchors, one row in a hundred, with all rows, in blocks.

Rows with a null label, vector or component, or one that isn't finite, take no part; nor does a row with a null vec_id, which no
result could name. Of rows that share a vec_id the one of least label, then vector, counts. Shorter vectors count as followed by
zeros. Ties go to the smaller vec_id. An empty table gives no rows. Other columns of the input are ignored. Scores are exact
within 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.llm.storage import small, stage

SCALE = 256
ANCHORS = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative's score falls short of the positive's by one part in SPARE at most.
SPARE = 5
#: Rows that the top of the tree is fitted on, about; it has at most SAMPLE / 4 cells.
SAMPLE = 1 << 14
CELL_ROWS = 1024
LEAF_ROWS = 64
#: Anchors that meet a part of a cell in one task.
BLOCK = 4096
#: Share of M * M by which bounds may be off.
SLACK = 1e-9
FOUND = "vec_id long, win int, found long, score long"
LEAST, MOST = int(np.iinfo(np.int64).min), int(np.iinfo(np.int64).max)


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones followed by zeros."""
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == dims).all():
        return values[offsets[0] : offsets[-1]].reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values[offsets[0] : offsets[-1]]
    return out


def _one(chunked: pa.ChunkedArray) -> pa.ListArray:
    got = chunked.combine_chunks()
    return got.chunk(0) if isinstance(got, pa.ChunkedArray) else got


def raised(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with their further component; top: M * M."""
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row of a from each row of b."""
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0))


class Tree:
    """A balanced vantage-point tree: node k has the children 2k and 2k + 1, the nearer and the farther half of its points. `low`
    and `high` bound the distances of a node's points from its parent's vantage point."""

    def __init__(self, points: np.ndarray, depth: int, own: bool) -> None:
        """own: only these points are below the nodes; else others that are led down by `leads` are, too."""
        count = 1 << depth
        self.depth, self.vantage, self.cut = depth, np.zeros((count, points.shape[1])), np.zeros(count)
        self.low, self.high = np.zeros(2 * count), np.full(2 * count, np.inf)
        below = {1: np.arange(len(points))}
        for node in range(1, count):
            rows = below.pop(node)
            near, far = rows, rows[:0]
            if len(rows):
                # The point farthest from another one: vantage points at the rim cut best.
                self.vantage[node] = points[rows[np.argmax(distance(points[rows], points[rows[:1]])[:, 0])]]
                d = distance(points[rows], self.vantage[node : node + 1])[:, 0]
                order = np.argsort(d, kind="stable")
                half = (len(rows) + 1) // 2
                near, far, self.cut[node] = rows[order[:half]], rows[order[half:]], d[order[half - 1]]
                if own:
                    for child, part in ((2 * node, d[order[:half]]), (2 * node + 1, d[order[half:]])):
                        if len(part):
                            self.low[child], self.high[child] = part[0], part[-1]
                else:
                    self.high[2 * node], self.low[2 * node + 1] = self.cut[node], self.cut[node]
            below[2 * node], below[2 * node + 1] = near, far
        self.leaves = [below[count + i] for i in range(count)]

    def leads(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            v = self.vantage[node]
            d = np.sqrt(np.maximum((points * points).sum(axis=1) + (v * v).sum(axis=1) - 2 * (points * v).sum(axis=1), 0))
            node = 2 * node + (d > self.cut[node])
        return node - (1 << self.depth)

    def bounds(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of each point from what a leaf may hold."""
        low, high = np.zeros((len(points), 1)), np.full((len(points), 1), np.inf)
        for level in range(self.depth):
            nodes = np.arange(1 << level, 2 << level)
            d = np.repeat(distance(points, self.vantage[nodes]), 2, axis=1)
            of = np.arange(2 << level, 4 << level)
            low = np.maximum(np.repeat(low, 2, axis=1), np.maximum(d - self.high[of], self.low[of] - d))
            high = np.minimum(np.repeat(high, 2, axis=1), d + self.high[of])
        return low, high


def relabelled(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) with the labels of every seventh vector wrong."""
    return rows.select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")


def _vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v), staged: v in whole numbers, one row of each vec_id."""
    x = F.col("embedding").cast("array<double>")
    whole = F.transform(x, lambda c: F.floor(c * SCALE))
    fits = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    held = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"), fits.alias("fits"))
    held = stage(held.where("vec_id is not null and label is not null and fits").drop("fits"), "vectors")
    many = stage(held.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "vector-ids")
    if many.isEmpty():
        return held
    least = held.join(many, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s")).select("vec_id", "s.label", "s.v")
    return stage(held.join(many, "vec_id", "left_anti").union(least), "vectors")


class Search:
    """The rows of `held` in the cells of a tree. `find` takes queries (vec_id, label, v, low, high): arrays of windows of scores."""

    def __init__(self, held: DataFrame, sample: int = SAMPLE, cell_rows: int = CELL_ROWS, block: int = BLOCK) -> None:
        spark = held.sparkSession
        norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        got = held.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top"), F.max(F.size("v")).alias("dims")).first()
        self.n, self.top, self.dims, self.block = got["n"], float(got["top"] or 0), max(1, got["dims"] or 0), block
        self.kind = np.float64 if self.top < 1 << 53 else np.int64  # both exact
        every = max(1, -(-self.n // sample))
        points = held.where(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0).orderBy("vec_id").select("v").toArrow()
        points = raised(matrix(_one(points.column("v")), self.dims), self.top) if len(points) else np.zeros((0, self.dims + 1))
        depth = max(0, min(int(np.ceil(np.log2(max(1, self.n / cell_rows)))), int(np.log2(max(1, len(points) / 4)))))
        self.tree = Tree(points, depth, own=False)
        tree, top, dims = self.tree, self.top, self.dims

        def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cell = tree.leads(raised(matrix(b.column("v"), dims), top))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *b.columns], names=["cell", *b.schema.names])

        led = stage(held.mapInArrow(lead, "cell int, vec_id long, label long, v array<bigint>"), "vector-cells")
        counts = led.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()  # SAMPLE / 4 rows at most
        self.parts = np.zeros(1 << depth, np.int64)
        for r in counts:
            self.parts[r["cell"]] = -(-r["n"] // cell_rows)
        parts = F.broadcast(spark.createDataFrame([(i, int(p)) for i, p in enumerate(self.parts)], "cell int, parts long"))
        self.rows = led.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")

    def _routed(self, queries: DataFrame, first: bool) -> DataFrame:
        """Each query for every part of the cells it visits: the one it falls into, or the others its windows meet."""
        tree, top, dims, parts = self.tree, self.top, self.dims, self.parts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in (whole.slice(i, 256) for i in range(0, len(whole), 256)):
                    q = matrix(b.column("v"), dims).astype(np.float64)
                    points = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
                    home = tree.leads(points)
                    if first:
                        visits = np.zeros((len(q), len(parts)), bool)
                        visits[np.arange(len(q)), home] = True
                    else:
                        best, worst = scores_within(q, *tree.bounds(points), top)
                        low, high = _windows(b)
                        visits = ((best[:, :, None] >= low[:, None]) & (worst[:, :, None] <= high[:, None])).any(axis=2)
                        visits[np.arange(len(q)), home] = False
                    row, cell = np.nonzero(visits & (parts > 0))
                    n = parts[cell]
                    row, cell, part = np.repeat(row, n), np.repeat(cell, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    taken = b.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(part.astype(np.int32)), *taken.columns], names=["cell", "part", *b.schema.names])

        schema = "cell int, part int, vec_id long, label long, v array<bigint>, low array<bigint>, high array<bigint>"
        return queries.select("vec_id", "label", "v", "low", "high").mapInArrow(run, schema)

    def _wave(self, queries: DataFrame, first: bool, same: bool, k: int, blocks: int) -> DataFrame:
        """(vec_id, win, found, score): of each query and window the first k rows of each part that is visited."""
        top, dims, kind = self.top, self.dims, self.kind

        def answer(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
            return walk(rows, asked, same, k, top, dims, kind)

        routed = self._routed(queries, first).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))
        routed = stage(routed, "vector-visits")
        keys = ["cell", "part", "block"]
        wanted = small(stage(routed.select(*keys).distinct(), "vector-parts"))
        rows = self.rows.join(wanted, ["cell", "part"])
        return rows.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(answer, FOUND)

    def find(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(vec_id, win, found, score, rank), staged: of each query and window the first k rows of its label, or of others."""
        queries = stage(queries, "vector-queries")
        blocks = max(1, -(-queries.count() // self.block))
        first = stage(self._wave(queries, True, same, k, blocks), "vectors-found")
        # What the first wave found narrows the windows of the second.
        kth = _ranked(first, k).where(F.col("rank") == k).groupBy("vec_id").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("kth"))
        narrow = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.get(F.col("at"), i), x)))
        places = F.transform(F.sequence(F.lit(0), F.size("low") - 1), lambda i: F.try_element_at("kth", i))
        left = queries.join(small(stage(kth, "vectors-kth")), "vec_id", "left").withColumn("at", places)
        left = stage(left.withColumn("low", narrow).select("vec_id", "label", "v", "low", "high"), "vector-queries")
        return stage(_ranked(first.union(self._wave(left, False, same, k, blocks)), k), "vectors-ranked")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("vec_id", "win").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def scores_within(q: np.ndarray, low: np.ndarray, high: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Highest and lowest score at distances from `low` to `high`, with slack."""
    total = top + (q.astype(np.float64) ** 2).sum(axis=1)[:, None]
    return (total - low * low) / 2 + SLACK * top + 1e-6, (total - high * high) / 2 - SLACK * top - 1e-6


def _windows(b: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Windows of each query, side by side; those of shorter lists are followed by empty ones."""
    out = []
    for name, none in (("low", 0), ("high", LEAST)):
        lists = b.column(name).to_pylist()
        width = max([len(x) for x in lists], default=0)
        out.append(np.array([[*x, *[none] * (width - len(x))] for x in lists], np.int64).reshape(len(lists), width))
    return out[0], out[1]


def walk(rows: pa.Table, asked: pa.Table, same: bool, k: int, top: float, dims: int, kind: type) -> pa.Table:
    """The first k rows of each query and window, by a tree over the rows of a part, its leaves nearest first."""
    names = ["vec_id", "win", "found", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    if not len(rows) or not len(asked):
        return pa.Table.from_arrays([pa.array([], t) for t in kinds], names=names)
    x, q = (matrix(_one(t.column("v")), dims) for t in (rows, asked))
    ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
    mine, of = asked.column("vec_id").to_numpy(), asked.column("label").to_numpy()
    low, high = _windows(asked)
    tree = Tree(raised(x, top), max(0, int(np.ceil(np.log2(len(x) / LEAF_ROWS)))), own=True)
    best, worst = scores_within(q, *tree.bounds(np.concatenate([q.astype(np.float64), np.zeros((len(q), 1))], axis=1)), top)
    order = np.argsort(-best, axis=1, kind="stable")
    x, q = x.astype(kind), q.astype(kind)
    score, found = np.full((*low.shape, k), LEAST), np.full((*low.shape, k), MOST)
    active = np.arange(len(q))
    for t in range(order.shape[1]):
        leaf = order[active, t]
        # Leaves come by falling bound: a query whose windows are all above it, or full of better rows, is done.
        least = np.maximum(low, score[:, :, -1])[active]
        open_ = least <= high[active]
        goes = ((best[active, leaf][:, None] >= least) & open_).any(axis=1)
        active, leaf = active[goes], leaf[goes]
        if not len(active):
            break
        meets = worst[active, leaf] <= high[active].max(axis=1)
        for number in np.unique(leaf[meets]).tolist():
            some = active[meets & (leaf == number)]
            held = tree.leaves[number]
            if not len(held):
                continue
            s = (q[some] @ x[held].T).astype(np.int64)
            other = ((labels[held] == of[some][:, None]) == same) & (ids[held] != mine[some][:, None])
            fits = other[:, None] & (s[:, None] >= low[some][:, :, None]) & (s[:, None] <= high[some][:, :, None]) & (s[:, None] >= score[some][:, :, -1:])
            i, w = np.nonzero(fits.any(axis=2))
            if not len(i):
                continue
            mask, at = fits[i, w], some[i]
            new = np.concatenate([score[at, w], np.where(mask, s[i], LEAST)], axis=1)
            who = np.concatenate([found[at, w], np.where(mask, ids[held], MOST)], axis=1)
            first = np.lexsort((who, ~new), axis=1)[:, :k]
            score[at, w], found[at, w] = np.take_along_axis(new, first, 1), np.take_along_axis(who, first, 1)
    i, w, r = np.nonzero(score != LEAST)
    cells = [mine[i], w.astype(np.int32), found[i, w, r], score[i, w, r]]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds, strict=True)], names=names)


def mine(rows: DataFrame, anchors: int = ANCHORS, positives: int = POSITIVES, negatives: int = NEGATIVES, search: dict | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row whose vec_id is divisible by
    `anchors` and each of its first `positives` rows of its label, the first `negatives` rows of other labels with a score
    between a share of the positive's and the positive's."""
    held = _vectors(rows)
    tree = Search(held, **(search or {}))
    asked = held.where(F.col("vec_id") % anchors == 0)
    every = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", LEAST + 1), ("high", MOST))]
    near = tree.find(asked.select("*", *every), True, positives)
    near = near.where("score >= 0")  # a negative score's window is empty
    window = F.struct("rank", F.expr(f"score - score div {SPARE}").alias("low"), F.col("score").alias("high"), F.col("found").alias("id"))
    windows = near.groupBy("vec_id").agg(F.array_sort(F.collect_list(window)).alias("wins"))
    windows = stage(windows, "vector-windows")
    queries = asked.join(small(windows), "vec_id").select("vec_id", "label", "v", F.col("wins.low").alias("low"), F.col("wins.high").alias("high"))
    hard = tree.find(queries, False, negatives)
    of = small(windows).select("vec_id", F.posexplode("wins").alias("win", "p"))
    return hard.join(of, ["vec_id", "win"]).select(
        F.col("vec_id").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
        F.col("p.high").alias("positive_score"), F.col("score").alias("negative_score"),
    )
