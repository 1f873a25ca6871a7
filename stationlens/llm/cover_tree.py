"""Exact top-k inner products by dual-tree search over cover trees.

Space is cut once, by a net: centres chosen farthest first from a bounded sample, each row in the cell
of its nearest centre.  A cell's rows make blocks, and every block is indexed, once, by a cover tree:
every node has a centre row, the radius that covers its rows, and children of at most half that
radius, down to single rows.  Queries are blocked and indexed alike.  No score of two nodes' rows exceeds

    <cq, cx> + Rq |cx| + Rx |cq| + Rq Rx,

so a pair of nodes whose bound is below the worst kth score of the query node's group is pruned; else
the children of both are bounded together, as one matrix product.  The bound of two rows is
their score.

Queries are a share of all rows, so they are taken in chunks of at most ``CHUNK_BYTES``, cell by cell.
Blocks of a chunk's own cells are searched first, for lower bounds.  Then whole cells are pruned by
centre and radius before anything of them is read (they are folders); tasks search the blocks of the
others, each with all it has found so far.  No matrix is shuffled for a pair.

Vectors without structure leave little to prune: the nodes then split into single rows at once, and a pair
of blocks is one matrix product.  (On 2,000 random unit vectors of 64 dimensions nothing is
pruned; on 4,096 rows around 16 centres over nine tenths of the scores are never taken.)

Components are floor(scale * x), scores whole numbers, exact up to 2^63 (an input that could exceed
that is refused with an OverflowError).

Defined cases: vectors that are null, empty or hold null or non-finite components take no
part; neither do rows with a null id; rows that share the query's id are not its candidates, and of rows
that share a query's id the first by vector is the query; only vectors of one length are
compared; fewer than k candidates are all returned; an empty table gives an empty table; other
columns are ignored, whatever their names.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common, vectors
from .word_blocks import batch_of

ROWS, QUERIES = 4_096, 512
LEAF = 32
#: Rows that the net is chosen from, and cells at most; a cell has ``ROWS`` rows on average, or more.
SAMPLE, CELLS = 8_192, 1_024
#: Queries sent to the tasks at once.
CHUNK_BYTES = 16 << 20
LOWEST = -(2**63) + 1


class CoverTree:
    """Rows in an order where each node is a range, and the nodes: centre row, radius, range, and
    the range of their children.  Nodes without children have rows."""

    FIELDS = (("centre", "<i4"), ("radius", "<f8"), ("start", "<i4"), ("end", "<i4"), ("first", "<i4"), ("last", "<i4"))

    def __init__(self, points: np.ndarray):
        self.order, self.points = np.arange(len(points)), points
        self.squares = np.einsum("ij,ij->i", points, points)
        #: What rounding may hide of a distance.
        self.slack = 1e-7 * float(np.sqrt(self.squares.max(initial=0)))
        self.nodes: list[list] = []
        if len(points):
            self._add(0, 0, len(points), self._distances(self.order, 0))
        at = 0
        while at < len(self.nodes):
            self._split(at)
            at += 1
        place = np.empty(len(points), np.int64)
        place[self.order] = np.arange(len(points))
        for node in self.nodes:
            node[0] = place[node[0]]

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        d = self.squares[rows] + self.squares[centre] - 2 * (self.points[rows] @ self.points[centre])
        return np.sqrt(np.maximum(d, 0))

    def _add(self, centre: int, start: int, end: int, d: np.ndarray) -> None:
        radius = float(d.max()) + self.slack if end - start > 1 else 0.0
        self.nodes.append([centre, radius, start, end, 0, 0, d])

    def _split(self, number: int) -> None:
        """Children around centres chosen farthest first, until all rows are within half the radius."""
        centre, _, start, end, _, _, d = self.nodes[number]
        self.nodes[number].pop()
        radius = float(d.max())
        if end - start <= LEAF or radius <= self.slack:
            return
        rows, near, owner, centres = self.order[start:end].copy(), d.copy(), np.zeros(end - start, np.int64), [centre]
        own_points, own_squares = self.points[rows], self.squares[rows]
        while near.max() > radius / 2:
            new = int(near.argmax())
            away = np.sqrt(np.maximum(own_squares + own_squares[new] - 2 * (own_points @ own_points[new]), 0))
            away[new] = 0.0
            closer = away < near
            owner[closer] = len(centres)
            np.minimum(near, away, out=near)
            centres.append(int(rows[new]))
        by_owner = np.argsort(owner, kind="stable")
        self.order[start:end] = rows[by_owner]
        edges = np.searchsorted(owner[by_owner], np.arange(len(centres) + 1)) + start
        near, self.nodes[number][4] = near[by_owner], len(self.nodes)
        for c, row in enumerate(centres):
            a, b = int(edges[c]), int(edges[c + 1])
            if b > a:
                self._add(row, a, b, near[a - start : b - start])
        self.nodes[number][5] = len(self.nodes)

    def packed(self) -> list[bytes]:
        columns = zip(*self.nodes, strict=True)
        return [np.array(c, kind).tobytes() for c, (_, kind) in zip(columns, self.FIELDS, strict=True)]


@dataclass
class Items:
    """Rows or nodes that are bounded together: vectors, radii, and their places."""

    points: np.ndarray
    norms: np.ndarray
    radii: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray  # of nodes; -1 for a single row


class Block:
    """A stored block: rows in tree order, and the nodes."""

    def __init__(self, row: dict):
        self.dims = row["dims"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.whole = np.frombuffer(row["matrix"], np.int64).reshape(-1, self.dims)
        self.largest = int(np.abs(self.whole).max(initial=0))
        self.points = self.whole.astype(np.float64)
        self.norms = np.linalg.norm(self.points, axis=1)
        for (name, kind), data in zip(CoverTree.FIELDS, row["nodes"], strict=True):
            setattr(self, name, np.frombuffer(data, kind))

    def rows(self, at: np.ndarray) -> Items:
        return Items(self.points[at], self.norms[at], np.zeros(len(at)), at, np.full(len(at), -1))

    def parts(self, what) -> Items:
        """What a node (a number) or rows (an array) are bounded by next."""
        if isinstance(what, np.ndarray):
            return self.rows(what)
        first, last = int(self.first[what]), int(self.last[what])
        if first == last:
            return self.rows(np.arange(self.start[what], self.end[what]))
        n = np.arange(first, last)
        one = self.end[n] - self.start[n] == 1
        return Items(
            self.points[self.centre[n]], self.norms[self.centre[n]], self.radius[n], self.start[n].astype(np.int64), np.where(one, -1, n)
        )


def bound(points: np.ndarray, norms, radii, others: np.ndarray, other_norms, other_radii) -> np.ndarray:
    """The greatest score of any two rows of two items, item by item."""
    out = points @ others.T
    if np.any(radii):
        out += np.outer(radii, other_norms + other_radii)
    if np.any(other_radii):
        out += np.outer(norms, other_radii)
    return out


class Best:
    """The k best rows of every query of a block; ``floor``: what a further one must reach."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.low = k, floor
        self.floor = floor.astype(np.float64)
        self.query, self.ids, self.scores = (np.empty(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        query, ids, scores = (np.concatenate(x) for x in ((self.query, query), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = order[rank < self.k]
        self.query, self.ids, self.scores = query[rank < self.k], ids[keep], scores[keep]
        kth = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        self.floor[self.query[kth]] = np.maximum(self.low[self.query[kth]], self.scores[kth])


def search(queries: Block, rows: Block, best: Best) -> int:
    """Search one block for one block of queries; returns the number of scores that were taken."""
    largest = queries.largest * rows.largest * rows.dims
    if largest >= 2**63:
        raise OverflowError("scores could exceed 2^63")
    slack = 1e-9 * largest  # of sums of doubles, beyond 2^53
    stack, taken = [(0, 0, np.inf)], 0
    while stack:
        a, b, most = stack.pop()
        if most < best.floor[a if isinstance(a, np.ndarray) else slice(queries.start[a], queries.end[a])].min() - slack:
            continue
        q, x = queries.parts(a), rows.parts(b)
        most = bound(q.points, q.norms, q.radii, x.points, x.norms, x.radii)
        single_q, single_x = np.flatnonzero(q.numbers < 0), np.flatnonzero(x.numbers < 0)
        nodes_q, nodes_x = np.flatnonzero(q.numbers >= 0), np.flatnonzero(x.numbers >= 0)
        if len(single_q) and len(single_x):
            at_q, at_x = q.starts[single_q], x.starts[single_x]
            scores = most if len(single_q) == len(q.starts) and len(single_x) == len(x.starts) else most[np.ix_(single_q, single_x)]
            taken += scores.size
            _take(queries, rows, best, at_q, at_x, scores, largest)
        floors = np.empty(len(q.starts))
        floors[single_q] = best.floor[q.starts[single_q]]
        for i in nodes_q:
            n = q.numbers[i]
            floors[i] = best.floor[queries.start[n] : queries.end[n]].min()
        open_ = most >= floors[:, None] - slack
        waiting = []
        for i in nodes_q:
            if (some := single_x[open_[i, single_x]]).size:
                waiting.append((int(q.numbers[i]), x.starts[some], float(most[i, some].max())))
            waiting += [(int(q.numbers[i]), int(x.numbers[j]), float(most[i, j])) for j in nodes_x[open_[i, nodes_x]]]
        for j in nodes_x:
            if (some := single_q[open_[single_q, j]]).size:
                waiting.append((q.starts[some], int(x.numbers[j]), float(most[some, j].max())))
        stack += sorted(waiting, key=lambda w: w[2])  # the highest bound is searched first
    return taken


def _take(queries: Block, rows: Block, best: Best, at_q: np.ndarray, at_x: np.ndarray, scores: np.ndarray, largest: int) -> None:
    """Add those of the scores that are among the k best of their query."""
    if largest >= 2**53:
        scores = queries.whole[at_q] @ rows.whole[at_x].T
    wanted = best.floor[at_q]
    if largest >= 2**53:  # floors are doubles
        wanted = np.floor(wanted * (1 - np.sign(wanted) * 1e-15)).clip(LOWEST, 2.0**62.99).astype(np.int64)
    other = rows.ids[at_x][None, :] != queries.ids[at_q][:, None]
    enough = (scores >= wanted[:, None]) & other
    if enough.sum() > 4 * best.k * len(at_q):  # no good floors yet: only the best of this product
        own = np.where(other, scores, LOWEST)
        kth = np.partition(own, max(own.shape[1] - best.k, 0), axis=1)[:, max(own.shape[1] - best.k, 0)]
        enough &= own >= kth[:, None]
    i, j = np.nonzero(enough)
    if len(i):
        best.add(at_q[i], rows.ids[at_x[j]], scores[i, j].astype(np.int64))


def _net(sample: np.ndarray, cells: int) -> np.ndarray:
    """Up to ``cells`` centres, farthest first, until the sample is covered with no radius."""
    centres = [0] if len(sample) else []
    near = np.linalg.norm(sample - sample[0], axis=1) if len(sample) else np.empty(0)
    while len(centres) < min(cells, len(sample)) and near.max() > 0:
        centres.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[centres[-1]], axis=1))
    return sample[centres]


def _nets(rows: DataFrame, scale: float) -> dict[int, np.ndarray]:
    """Net centres by vector length, from at most ``SAMPLE`` different vectors of all lengths."""
    total = rows.count()
    sample = common.sampled(rows.select("dims", "vector"), F.xxhash64("vector"), SAMPLE).collect()
    by_dims: dict[int, list] = {}
    for r in sorted(sample):
        by_dims.setdefault(r.dims, []).append(np.floor(scale * np.frombuffer(r.vector, np.float64)))
    return {dims: _net(np.stack(v), int(np.clip(total // ROWS, 1, CELLS))) for dims, v in by_dims.items()}


PLACED = "dims int, cell int, vec_id long, vector binary, away double, norm double"


def _placed(rows: DataFrame, nets: dict[int, np.ndarray], scale: float) -> DataFrame:
    """Rows with their cell and their distance from its centre; vectors become whole numbers."""
    shared = rows.sparkSession.sparkContext.broadcast(nets)
    schema = pa.schema([
        ("dims", pa.int32()), ("cell", pa.int32()), ("vec_id", pa.int64()), ("vector", pa.binary()), ("away", pa.float64()), ("norm", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 2048) for b in batches for at in range(0, b.num_rows, 2048)):
            lengths = batch.column(0).to_numpy()
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                v = np.floor(scale * vectors.matrix(part.column(2)))
                if np.abs(v).max() >= 2.0**62:
                    raise OverflowError("a scaled component is beyond 2^62")
                centres = shared.value.get(dims)
                centres = v[:1] * 0 if centres is None else centres
                d = (v**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * (v @ centres.T)
                cell = d.argmin(axis=1)
                away = np.linalg.norm(v - centres[cell], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(cell.astype(np.int32)), part.column(1),
                        pa.array([x.tobytes() for x in v.astype(np.int64)], pa.binary()), pa.array(away), pa.array(np.linalg.norm(v, axis=1)),
                    ],
                    schema=schema,
                )

    return rows.select("dims", "vec_id", "vector").mapInArrow(run, PLACED)


BLOCKS = "dims int, cell int, part int, ids binary, matrix binary, nodes array<binary>"
_BLOCKS = pa.schema([
    ("dims", pa.int32()), ("cell", pa.int32()), ("part", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary()), ("nodes", pa.list_(pa.binary())),
])


def _blocks(placed: DataFrame, cells: DataFrame, size: int) -> DataFrame:
    """Indexed blocks of about ``size`` rows of one cell; ``cells`` has the number of rows of each."""
    parts = cells.select("dims", "cell", F.ceil(F.col("rows") / size).cast("int").alias("parts"))
    part = F.expr("cast(pmod(xxhash64(vec_id, vector, away), parts) as int)")
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["dims", "cell", "part"]
    dealt = (
        placed.join(F.broadcast(parts), ["dims", "cell"]).withColumn("part", part)
        .repartition(n, *keys).sortWithinPartitions(*keys).select(*keys, "vec_id", "vector")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, found = None, [], []

        def blocks() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(ids), size):  # copies of a row are of one part
                own = np.array(ids[at : at + size], np.int64)
                whole = np.frombuffer(b"".join(found[at : at + size]), np.int64).reshape(len(own), -1)
                tree = CoverTree(whole.astype(np.float64))
                yield batch_of([(*key, own[tree.order].tobytes(), whole[tree.order].tobytes(), tree.packed())], _BLOCKS)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[:3] != key or len(ids) == 4 * size:
                    yield from blocks()
                    key, ids, found = row[:3], [], []
                ids.append(row[3])
                found.append(row[4])
        yield from blocks()

    return dealt.mapInArrow(run, BLOCKS)


@dataclass
class Cells:
    """Centres, radii and numbers of the cells of one vector length."""

    numbers: np.ndarray
    centres: np.ndarray
    radii: np.ndarray

    def open(self, block: Block, floor: np.ndarray) -> np.ndarray:
        """Numbers of the cells that can hold one of the k best of some query of a block."""
        norms = np.linalg.norm(self.centres, axis=1)
        most = bound(block.points[block.centre[:1]], block.norms[block.centre[:1]], block.radius[:1], self.centres, norms, self.radii)[0]
        return self.numbers[most * (1 + 1e-9 * np.sign(most)) + 1e-6 >= floor.min()]


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _searched(blocks: DataFrame, queries: list[Block], floors: list[np.ndarray], k: int) -> DataFrame:
    """(query_id, vec_id, score): of each task's blocks the k best of every query that reach its floor."""
    shared = blocks.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = shared.value
        best = [Best(len(q.ids), k, f) for q, f in zip(queries, floors, strict=True)]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)})
                for q, b in zip(queries, best, strict=True):
                    if q.dims == block.dims:
                        search(q, block, b)
        for q, b in zip(queries, best, strict=True):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.ids[b.query]), pa.array(b.ids), pa.array(b.scores)], schema=FOUND
                )

    found = blocks.select("dims", "cell", "part", "ids", "matrix", "nodes").mapInArrow(run, "query_id long, vec_id long, score long")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first).cast("int")).where(F.col("rank") <= k)


def top_k(
    embeddings: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on vec_id."""
    spark, used = embeddings.sparkSession, []

    def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        made, path = common.stored(df, name, partition_by)
        used.append(path)
        return made

    rows = vectors.usable(embeddings, id_col, vector_col, None).where("vec_id is not null").drop("label")
    rows = stored(rows, "vectors")
    nets = _nets(rows, scale)
    placed = stored(_placed(rows, nets, scale), "placed")
    # One row a cell, of which there are at most CELLS (for each length of which the sample has vectors).
    size = [F.count("*").alias("rows"), F.max("away").alias("radius")]
    cells = stored(placed.groupBy("dims", "cell").agg(*size), "cells")
    data = stored(_blocks(placed, cells, ROWS), "row-blocks", "cell")
    one_of_id = placed.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dims", "vector", "cell", "away")).alias("q"))
    asked = stored(one_of_id.select("vec_id", "q.*"), "queries")
    query_cells = asked.groupBy("dims", "cell").agg(F.count("*").alias("rows"))
    indexed = stored(_blocks(asked, query_cells, QUERIES), "query-blocks", "cell")

    every = {
        dims: Cells(np.array([r.cell for r in found]), np.stack([_centre(nets, dims, r.cell) for r in found]), np.array([r.radius for r in found]))
        for dims, found in _by_dims(cells.collect()).items()
    }
    out = common.scratch_path(spark, "top-k")
    spark.createDataFrame([], RESULT).write.parquet(out)
    for chunk in _chunks(indexed):
        queries = [Block(r.asDict()) for r in indexed.where(chunk).orderBy("dims", "cell", "part").collect()]
        own = sorted({(r.dims, r.cell) for r in indexed.where(chunk).select("dims", "cell").distinct().collect()})
        nothing = [np.full(len(q.ids), LOWEST) for q in queries]
        first = (F.col("part") == 0) & F.col("cell").isin([c for _, c in own])
        seeds, path = common.stored(_searched(data.where(first), queries, nothing, k), "seeds")
        # One row a query of the chunk.
        kth = {r.query_id: r.score for r in seeds.where(F.col("rank") == k).select("query_id", "score").collect()}
        floors = [np.array([kth.get(i, LOWEST) for i in q.ids.tolist()]) for q in queries]
        open_ = sorted({int(c) for q, f in zip(queries, floors, strict=True) for c in every[q.dims].open(q, f)})
        rest = _searched(data.where(F.col("cell").isin(open_) & ~first), queries, floors, k)
        best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        both = seeds.drop("rank").unionByName(rest.drop("rank")).withColumn("rank", F.row_number().over(best_first).cast("int"))
        both.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
        common.remove(spark, path)
    common.remove(spark, *used)
    return spark.read.schema(RESULT).parquet(out)


RESULT = "query_id long, rank int, vec_id long, score long"


def _by_dims(rows: list) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r.dims, []).append(r)
    return out


def _centre(nets: dict[int, np.ndarray], dims: int, cell: int) -> np.ndarray:
    return nets[dims][cell] if dims in nets else np.zeros(dims)


def _chunks(indexed: DataFrame) -> list[Column]:
    """Conditions that share out query blocks, those of near cells together."""
    sizes = indexed.groupBy("cell", "part").agg(F.sum(F.length("matrix")).alias("bytes")).orderBy("cell", "part").collect()
    chunks, now, size = [], {}, 0
    for r in sizes:
        if now and size + r.bytes > CHUNK_BYTES:
            chunks.append(now)
            now, size = {}, 0
        now.setdefault(r.cell, []).append(r.part)
        size += r.bytes
    chunks += [now] if now else []

    def of(cells: dict[int, list[int]]) -> Column:
        some = F.lit(False)
        for cell, parts in cells.items():
            some = some | ((F.col("cell") == cell) & F.col("part").between(min(parts), max(parts)))
        return some

    return [of(c) for c in chunks]
