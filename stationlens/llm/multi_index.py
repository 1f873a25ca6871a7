"""Near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; pairs of codes are the cells of a
product grid, and every vector is listed in its cell.  Every vector then visits the cells
nearest to it, in the order of the multi-sequence traversal (a heap over the two sorted lists of
distances), until the cells left are too far for the target recall; what is listed there is
verified by the exact cosine in double precision.

How far is far enough is measured on the vectors that the codebooks are fitted on: they are turned
by exactly the least cosine in random directions, and the excess distance within which
``target_recall`` of them are found ends the traversal.  With a target of 1 the limit is exact: every
code has the radius that covers all vectors nearest to it, and the cell (i, j) is visited if
max(0, d_i - r_i)^2 + max(0, d_j - r_j)^2 <= 2 (1 - least cosine), beyond which none of its vectors
can be linked.  Fitting takes ``FIT`` different vectors by a hash; the index lists all.

Equal vectors of a label are one class, by a 128-bit digest that a second hash checks.  A cell lists
some ``CELL`` vectors of a label, so that a vector visits a few cells only and is copied as often;
copies are of single floats where the input is.  Cells are cut into blocks of some ``BLOCK`` members, so
that a crowded cell is many tasks; a task returns counts of links and, for the components, one
row a vector, never all pairs.

Defined cases: rows with a null label, or a vector that is null, empty, zero or holds null or
non-finite components, link with nothing (0 links, their own component); vectors of different
length never link; rows with null ids take part (a component of only null ids has the null id);
repeated ids are vectors of their own; an empty table gives an empty table; other columns are ignored.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, links, vectors
from .word_blocks import batch_of

FIT = 16_384
BLOCK = 2_048
#: Vectors of a label that a cell should list, about.
CELL = 512
#: Cells (some 30 bytes each) are broadcast up to this number.
MAX_BROADCAST_CELLS = 500_000
#: Vectors of the sample for each code, at least.
FOR_CODE = 8


class MultiIndex:
    """Two codebooks and the excess squared distance that ends a traversal."""

    def __init__(self, sample: np.ndarray, codes: int, least_cosine: float, target_recall: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.half = sample.shape[1] // 2
        self.books = [self._codebook(x, min(codes, len(sample)), rng) for x in self._halves(sample)]
        found = []
        for _ in range(4):
            away = rng.standard_normal(sample.shape)
            away -= (away * sample).sum(axis=1, keepdims=True) * sample
            away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
            turned = least_cosine * sample + np.sqrt(1 - least_cosine**2) * away
            excess = np.zeros(len(sample))
            for d, t in zip(self.distances(sample), self.distances(turned), strict=True):
                excess += d[np.arange(len(d)), t.argmin(axis=1)] - d.min(axis=1)
            found.append(excess)
        self.excess = float(np.quantile(np.concatenate(found), min(target_recall, 1.0))) + 1e-9
        #: For an exact limit: the codes' covering radii, and the greatest distance of linked vectors, squared.
        self.radii: list[np.ndarray] | None = None
        self.linked = 2 * (1 - least_cosine) + 1e-9

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    @staticmethod
    def _codebook(x: np.ndarray, codes: int, rng: np.random.Generator, steps: int = 8) -> np.ndarray:
        book = x[rng.choice(len(x), codes, replace=False)].copy()
        for _ in range(steps):
            near = ((book**2).sum(axis=1) - 2 * x @ book.T).argmin(axis=1)
            for c in range(codes):
                own = x[near == c]
                if len(own):
                    book[c] = own.mean(axis=0)
        return book

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared distances of each half to its codes."""
        return [
            np.maximum((h**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * h @ b.T, 0)
            for h, b in zip(self._halves(x), self.books, strict=True)
        ]

    def home(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first.argmin(axis=1) * len(self.books[1]) + second.argmin(axis=1)

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """The cells nearest to one vector, nearest first."""
        if self.radii is not None:
            near = [np.maximum(np.sqrt(d) - r - 1e-7, 0) ** 2 for d, r in zip((first, second), self.radii, strict=True)]
            i, j = np.nonzero(near[0][:, None] + near[1] <= self.linked)
            nearest = np.argsort(first[i] + second[j], kind="stable")
            return (i * len(second) + j)[nearest].tolist()
        order = first.argsort(), second.argsort()
        d = first[order[0]].tolist(), second[order[1]].tolist()
        limit = d[0][0] + d[1][0] + self.excess
        heap, seen, cells = [(d[0][0] + d[1][0], 0, 0)], {(0, 0)}, []
        while heap and heap[0][0] <= limit:
            _, i, j = heapq.heappop(heap)
            cells.append(int(order[0][i]) * len(second) + int(order[1][j]))
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(first) and q < len(second) and (p, q) not in seen:
                    seen.add((p, q))
                    heapq.heappush(heap, (d[0][p] + d[1][q], p, q))
        return cells


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(classes: DataFrame, dims: int, least_cosine: float, target_recall: float) -> MultiIndex:
    """Codebooks from a bounded sample; their size follows the number of vectors a label."""
    rows = classes.where(F.col("dims") == dims)
    n, labels = rows.agg(F.count("*"), F.count_distinct("label")).first()
    taken = common.sampled(rows.select("vector"), F.xxhash64("vector"), FIT).collect()
    sample = _unit(vectors.expanded(pa.array([bytes(r.vector) for r in taken], pa.binary()), dims))
    codes = int(np.clip(round((n / (CELL * labels)) ** 0.5), 1, max(1, FIT // FOR_CODE)))
    index = MultiIndex(sample, codes, least_cosine, target_recall)
    if target_recall >= 1:
        index.radii = _radii(rows, index, dims)
    return index


def _radii(rows: DataFrame, index: MultiIndex, dims: int) -> list[np.ndarray]:
    """Of each code of both halves the distance that covers all vectors nearest to it."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("half", pa.int32()), ("code", pa.int32()), ("far", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = [np.zeros(len(b)) for b in shared.value.books]
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            for into, d in zip(far, shared.value.distances(_unit(vectors.expanded(batch.column(0), dims))), strict=True):
                near = d.argmin(axis=1)
                np.maximum.at(into, near, np.sqrt(d[np.arange(len(d)), near]))
        yield batch_of([(h, c, float(x)) for h, own in enumerate(far) for c, x in enumerate(own)], schema)

    found = rows.select("vector").mapInArrow(run, "half int, code int, far double").groupBy("half", "code").agg(F.max("far").alias("far"))
    radii = [np.zeros(len(b)) for b in index.books]
    for r in found.collect():  # one row a code
        radii[r.half][r.code] = r.far + 1e-7
    return radii


def _indexed(classes: DataFrame, index: MultiIndex, dims: int) -> DataFrame:
    """(cls, label, members, vector, home, visits)."""
    shared = classes.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([
        ("cls", pa.int64()), ("label", pa.string()), ("members", pa.int64()), ("vector", pa.binary()),
        ("home", pa.int64()), ("visits", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            first, second = shared.value.distances(_unit(vectors.expanded(batch.column(3), dims)))
            home = shared.value.home(first, second).tolist()
            visits = [shared.value.visits(a, b) for a, b in zip(first, second, strict=True)]
            cols = [batch.column(i).to_pylist() for i in range(3)]
            yield batch_of(zip(*cols, batch.column(3).to_pylist(), home, visits, strict=True), schema)

    return classes.where(F.col("dims") == dims).select("cls", "label", "members", "vector").mapInArrow(
        run, "cls long, label string, members long, vector binary, home long, visits array<long>"
    )


def _verified(indexed: DataFrame, dims: int, least_cosine: float) -> DataFrame:
    """Rows (cls, n, root): links of a class found in a block (weighted by members), or its root there."""
    cells = indexed.groupBy("label", F.col("home").alias("cell")).agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    if cells.count() <= MAX_BROADCAST_CELLS:
        cells = F.broadcast(cells)  # else the copies below are shuffled once more
    listed = indexed.join(cells.withColumnRenamed("cell", "home"), ["label", "home"]).select(
        "label", F.col("home").alias("cell"), F.expr("cast(pmod(xxhash64(cls), blocks) as int)").alias("block"),
        F.lit(0).alias("kind"), "cls", "members", "vector",
    )
    visiting = (
        indexed.select("label", F.explode("visits").alias("cell"), "cls", "members", "vector")
        .join(cells, ["label", "cell"])
        .select("label", "cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(1).alias("kind"), "cls", "members", "vector")
    )
    n = int(indexed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = listed.unionByName(visiting).repartition(n, "label", "cell", "block").sortWithinPartitions("label", "cell", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])
        key, ids, sizes, table = None, [], [], []
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            kinds = batch.column(3).to_pylist()
            cut = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]), len(keys)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                part = batch.slice(a, b - a)
                if keys[a] != key:
                    key, ids, sizes, table = keys[a], [], [], []
                cls, unit = part.column(4).to_numpy(), _unit(vectors.expanded(part.column(6), dims))
                if kinds[a] == 0:
                    ids.append(cls)
                    sizes.append(part.column(5).to_numpy())
                    table.append(unit)
                    continue
                own, weight = np.concatenate(ids), np.concatenate(sizes)
                linked = (unit @ np.concatenate(table).T >= least_cosine) & (cls[:, None] != own)
                some = linked.any(axis=1)
                if not some.any():
                    continue
                linked, cls = linked[some], cls[some]
                n = linked @ weight
                hit = linked.any(axis=0)
                linked, own = linked[:, hit], own[hit]
                root, near = cls.copy(), own.copy()
                while True:  # least class of each component of this block
                    none = np.iinfo(np.int64).max
                    lower = np.minimum(root, np.where(linked, near, none).min(axis=1))
                    near_lower = np.minimum(near, np.where(linked, lower[:, None], none).min(axis=0))
                    if (lower == root).all() and (near_lower == near).all():
                        break
                    root, near = lower, near_lower
                rows = [*zip(cls.tolist(), n.tolist(), root.tolist(), strict=True), *((o, 0, r) for o, r in zip(own.tolist(), near.tolist(), strict=True))]
                yield batch_of(rows, schema)

    return met.mapInArrow(run, "cls long, n long, root long")


def near_duplicates(
    embeddings: DataFrame, least_cosine: float = 0.98, target_recall: float = 0.9995,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    every = embeddings.select(F.col(id_col).cast("long").alias("vec_id"))
    spark, used = embeddings.sparkSession, []

    def stored(df: DataFrame, name: str) -> DataFrame:
        made, path = common.stored(df, name)
        used.append(path)
        return made

    good = vectors.usable(embeddings.where(_not_zero(vector_col)), id_col, vector_col, label_col, short=True).where("label is not null")
    key = F.unhex(F.md5(F.concat(F.col("label").cast("binary"), F.lit(b"\0"), F.col("vector"))))
    good = stored(good.withColumns({"key": key, "check": F.xxhash64("label", "vector")}), "vectors")
    one = F.when(F.min("check") == F.max("check"), F.min("vec_id")).otherwise(
        F.raise_error(F.lit("two vectors have one digest")).cast("long"))
    # The number given to a class holds from here on, as the table is written.
    classes = stored(
        good.groupBy("key").agg(
            one.alias("vec_id"), F.first("label").alias("label"), F.first("dims").alias("dims"),
            F.first("vector").alias("vector"), F.count("*").alias("members"),
        ).withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes",
    )
    found = None
    for (dims,) in sorted(classes.select("dims").distinct().collect()):  # one or a few lengths
        index = fit(classes, dims, least_cosine, target_recall)
        some = _verified(stored(_indexed(classes, index, dims), "indexed"), dims, least_cosine)
        found = some if found is None else found.unionByName(some)
    if found is None:
        common.remove(spark, *used)
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "vector-links")
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    roots = links.components(found.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")).distinct())
    placed = (
        classes.select("cls", "key", "vec_id", "members")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .join(counts, "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    lowest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    answer = placed.join(lowest, "component").select(
        "key", (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = good.select("vec_id", "key").join(answer, "key").select("vec_id", "n_links", "component_id")
    # Rows without a usable vector are the rest.
    alone = _without(embeddings, id_col, vector_col, label_col).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    answer, _ = common.stored(every, "near-vectors")
    common.remove(spark, *used)
    return answer


def _not_zero(vector_col: str) -> Column:
    """Some component differs from 0.0 and -0.0; null if that isn't known."""
    return F.exists(F.col(vector_col).cast("array<double>"), lambda x: x != 0)


def _without(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Ids of the rows that link with nothing."""
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~_not_zero(vector_col)
    unusable = F.col(label_col).isNull() | v.isNull() | (F.size(v) == 0) | F.coalesce(odd, F.lit(True)) | F.coalesce(zero, F.lit(True))
    return embeddings.where(unusable).select(F.col(id_col).cast("long").alias("vec_id"))
