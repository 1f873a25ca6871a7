"""Hard negatives by vertical scans (branch and bound on decomposed vectors).

Vectors stand in blocks, dimension by dimension, rows of one label together.  An anchor reads a
block's dimensions in descending order of its own components' magnitude.  What the dimensions not
yet read can still add lies between two sums, of the least and of the greatest product of the
anchor's component with any of the block's; a row whose score so far plus that cannot reach the
scores looked for any more leaves the bitmap of candidates.  Rows still in it when all
dimensions are read have their exact scores.

First every anchor looks for its positives among rows of its label: the scores looked for are those of its
kth best so far or higher, or the kth best of the sums so far with the least that they can still get.  Then for its negatives, among rows of other labels: between
``least_share`` percent of the lowest positive's score (or the lowest of the windows' kth best so far) and the
highest positive's score; at the end every positive's own window decides.

Anchors are a share of all rows, so they are taken in chunks of at most ``CHUNK_BYTES``; each chunk is one
scan of all blocks for positives and one for negatives, in parallel.  A task keeps only the best rows
of each anchor; these meet by anchor.  Blocks are written once, without a shuffle.

Components are floor(scale * x); scores are whole numbers, exact up to 2^63 (an input that could exceed
that is refused with an OverflowError).

Defined cases: rows whose id, label or vector is null, whose vector is empty or holds null or
non-finite components take no part; only vectors of one length are compared; of rows that share an
anchor's id the first by label and vector is the anchor, and none of them is its candidate; other rows that
repeat an id are candidates each for itself; fewer rows than asked for are all returned, and a
positive without negatives returns no row; an empty table gives an empty table; other columns are
ignored, whatever their names.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .word_blocks import batch_of

BLOCK = 4_096
#: Dimensions read between two prunings.
STEP = 8
#: Anchors' vectors sent to the tasks at once.
CHUNK_BYTES = 16 << 20

BLOCKS = "dims int, names array<string>, edges array<int>, ids binary, width int, columns binary"
_BLOCKS = pa.schema([
    ("dims", pa.int32()), ("names", pa.list_(pa.string())), ("edges", pa.list_(pa.int32())), ("ids", pa.binary()),
    ("width", pa.int32()), ("columns", pa.binary()),
])


def scaled_rows(embeddings: DataFrame, scale: float, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label as text, dims, v as whole numbers) of rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
        .where((F.size("v") > 0) & good)
        .select("vec_id", "label", F.size("v").alias("dims"), F.transform("v", lambda x: F.floor(x * F.lit(float(scale)).cast("double")).cast("double")).alias("v"))
    )


def _whole(v: np.ndarray) -> np.ndarray:
    """Doubles that hold whole numbers, as 64-bit ones."""
    if len(v) and np.abs(v).max() >= 2.0**62:
        raise OverflowError("a scaled component is beyond 2^62")
    return v.astype(np.int64)


def blocks_of(rows: DataFrame) -> DataFrame:
    """Rows as blocks, dimension-major; rows of one label stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, held, parts = None, 0, []

        def block() -> pa.RecordBatch:
            ids = np.concatenate([p[0] for p in parts])
            labels = [x for p in parts for x in p[1]]
            v = np.concatenate([p[2] for p in parts])
            first = [i for i, x in enumerate(labels) if not i or x != labels[i - 1]]
            width = next(w for w in (2, 4, 8) if np.abs(v).max() < 2 ** (8 * w - 1))
            columns = np.ascontiguousarray(v.T).astype(f"<i{width}").tobytes()
            return batch_of([(dims, [labels[i] for i in first], [*first, len(labels)], ids.tobytes(), width, columns)], _BLOCKS)

        for batch in batches:
            size = batch.column(2).to_numpy()
            at = 0
            while at < batch.num_rows:
                if parts and (size[at] != dims or held == BLOCK):
                    yield block()
                    held, parts = 0, []
                dims = int(size[at])
                same = int(np.argmax(size[at:] != dims)) or batch.num_rows - at
                n = min(same, BLOCK - held)
                piece = batch.slice(at, n)
                v = _whole(piece.column(3).flatten().to_numpy(zero_copy_only=False)).reshape(n, dims)
                parts.append((piece.column(0).to_numpy(), piece.column(1).to_pylist(), v))
                held, at = held + n, at + n
        if parts:
            yield block()

    ordered = rows.select("vec_id", "label", "dims", "v").sortWithinPartitions("dims", "label")
    return ordered.mapInArrow(run, BLOCKS)


@dataclass
class Anchors:
    """Anchors of one length; ``low`` and ``high``: scores looked for, none for positives."""

    ids: np.ndarray
    labels: list[str]
    vectors: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def __post_init__(self):
        self.order = np.argsort(-np.abs(self.vectors), axis=1, kind="stable")


class Block:
    def __init__(self, row: dict):
        self.dims = row["dims"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.columns = np.frombuffer(row["columns"], f"<i{row['width']}").reshape(self.dims, -1)
        self.least, self.most = self.columns.min(axis=1).astype(np.int64), self.columns.max(axis=1).astype(np.int64)
        self.at = {name: (a, b) for name, a, b in zip(row["names"], row["edges"], row["edges"][1:], strict=False)}

    def ready(self, anchors: Anchors) -> None:
        """Columns in the smallest exact type, and what unread dimensions can add, per anchor."""
        largest = max(map(abs, (int(self.least.min()), int(self.most.max()))), default=0)
        bound = largest * int(np.abs(anchors.vectors).max(initial=0)) * self.dims
        if bound >= 2**63:
            raise OverflowError("scores could exceed 2^63")
        kind = np.float64 if bound < 2**53 else np.int64
        self.columns, self.anchors = self.columns.astype(kind), anchors.vectors.astype(kind)
        a, b = anchors.vectors * self.least, anchors.vectors * self.most
        lows, highs = (np.take_along_axis(x, anchors.order, axis=1)[:, ::-1] for x in (np.minimum(a, b), np.maximum(a, b)))
        none = np.zeros((len(a), 1), np.int64)
        # [i, d]: of the dimensions from the dth of the anchor's order on.
        self.low, self.high = (np.concatenate([x.cumsum(axis=1)[:, ::-1], none], axis=1) for x in (lows, highs))


def vertical_scan(
    block: Block, anchors: Anchors, i: int, rows: np.ndarray, low: int, high: int, k: int = 0
) -> tuple[np.ndarray, np.ndarray, int]:
    """Of ``rows`` those whose score with anchor i is from ``low`` to ``high``, with the scores; and
    the number of components read.

    With ``k``, rows that cannot be among the k best are left out: k others have a higher score
    already, even with the least that is still to come.
    """
    order, a = anchors.order[i], block.anchors[i]
    score, read = np.zeros(len(rows), block.columns.dtype), 0
    for d in range(0, block.dims, STEP):
        some = order[d : d + STEP]
        # A bitmap with few gaps is cheaper read whole.
        if 2 * len(rows) > block.columns.shape[1]:
            score = score + (a[some] @ block.columns[some])[rows]
        else:
            score = score + a[some] @ block.columns[np.ix_(some, rows)]
        read += len(some) * len(rows)
        end = min(d + STEP, block.dims)
        least, most = int(block.low[i, end]), int(block.high[i, end])
        if 0 < k < len(rows):
            low = max(low, int(np.partition(score, len(rows) - k)[len(rows) - k]) + least)
        alive = (score >= low - most) & (score <= high - least)
        rows, score = rows[alive], score[alive]
        if not len(rows):
            break
    return rows, score.astype(np.int64), read


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


class Kept:
    """The k best (id, score) of each list; ``floor``: the score that a further one must reach."""

    def __init__(self, k: int):
        self.k, self.lists = k, {}

    def floor(self, key, least: int) -> int:
        held = self.lists.get(key)
        return max(least, int(held[1][-1])) if held is not None and len(held[0]) == self.k else least

    def add(self, key, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        if key in self.lists:
            ids, scores = np.concatenate([self.lists[key][0], ids]), np.concatenate([self.lists[key][1], scores])
        best = _best(ids, scores, self.k)
        self.lists[key] = ids[best], scores[best]


LOWEST, HIGHEST = -(2**63) + 1, 2**63 - 1


def search_positives(block: Block, anchors: Anchors, kept: Kept) -> int:
    read = 0
    for i, label in enumerate(anchors.labels):
        if label not in block.at:
            continue
        a, b = block.at[label]
        rows = a + np.flatnonzero(block.ids[a:b] != anchors.ids[i])
        rows, scores, n = vertical_scan(block, anchors, i, rows, kept.floor(i, LOWEST), HIGHEST, kept.k)
        read += n
        kept.add(i, block.ids[rows], scores)
    return read


def search_negatives(block: Block, anchors: Anchors, kept: Kept) -> int:
    """``anchors.low`` and ``high``: a row of windows for each anchor; an empty one has low > high."""
    read = 0
    other = np.ones(len(block.ids), bool)
    for i, label in enumerate(anchors.labels):
        windows = [w for w in range(anchors.low.shape[1]) if anchors.low[i, w] <= anchors.high[i, w]]
        if not windows:
            continue
        floors = [kept.floor((i, w), int(anchors.low[i, w])) for w in windows]
        a, b = block.at.get(label, (0, 0))
        other[a:b] = False
        rows = np.flatnonzero(other & (block.ids != anchors.ids[i]))
        other[a:b] = True
        rows, scores, n = vertical_scan(block, anchors, i, rows, min(floors), int(anchors.high[i, windows].max()))
        read += n
        for w, floor in zip(windows, floors, strict=True):
            inside = (scores >= floor) & (scores <= anchors.high[i, w])
            kept.add((i, w), block.ids[rows[inside]], scores[inside])
    return read


FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _scan(blocks: DataFrame, anchors: dict[int, Anchors], k: int, search) -> DataFrame:
    """(anchor_id, positive_rank, vec_id, score): the best rows of each task."""
    shared = blocks.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {dims: Kept(k) for dims in shared.value}
        for batch in batches:
            for j in range(batch.num_rows):
                row = {name: batch.column(c)[j].as_py() for c, name in enumerate(batch.schema.names)}
                if row["dims"] in kept:
                    block, own = Block(row), shared.value[row["dims"]]
                    block.ready(own)
                    search(block, own, kept[row["dims"]])
        for dims, found in kept.items():
            ids = shared.value[dims].ids
            for key, (vec_ids, scores) in found.lists.items():
                i, w = key if isinstance(key, tuple) else (key, 0)
                n = len(vec_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, ids[i])), pa.array(np.full(n, w + 1, np.int32)), pa.array(vec_ids), pa.array(scores)], schema=FOUND
                )

    best = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("score"), "vec_id")
    found = blocks.mapInArrow(run, "anchor_id long, positive_rank int, vec_id long, score long")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _chunk(anchors: DataFrame) -> dict[int, Anchors]:
    """A chunk's anchors by length; the chunk's size is bounded by ``hard_negatives``."""
    by_dims: dict[int, list] = {}
    for r in anchors.orderBy("vec_id").collect():
        by_dims.setdefault(r.dims, []).append((r.vec_id, r.label, r.v))
    return {
        dims: Anchors(np.array([x[0] for x in rows], np.int64), [x[1] for x in rows], _whole(np.array([x[2] for x in rows])).reshape(-1, dims))
        for dims, rows in by_dims.items()
    }


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 5,
    least_share: int = 80,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_rank, positive_id, positive_score, rank, negative_id, negative_score.

    ``is_anchor`` is a condition on vec_id.  A negative's score is at least ``least_share`` percent of the positive's,
    and at most the positive's.
    """
    spark = embeddings.sparkSession
    rows = scaled_rows(embeddings, scale, id_col, vector_col, label_col)
    blocks, blocks_path = common.stored(blocks_of(rows), "bond-blocks")
    first = F.min(F.struct("label", "dims", "v")).alias("first")
    chosen, anchors_path = common.stored(
        rows.where(is_anchor).groupBy("vec_id").agg(first).select("vec_id", "first.*"), "bond-anchors"
    )
    values = chosen.agg(F.sum("dims")).first()[0] or 0
    chunks = max(1, -(-values * 8 // CHUNK_BYTES))
    out = common.scratch_path(spark, "hard-negatives")
    for c in range(chunks):
        anchors = _chunk(chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c))
        positives, path = common.stored(_scan(blocks, anchors, n_positives, search_positives), "positives")
        places = {int(x): (dims, i) for dims, own in anchors.items() for i, x in enumerate(own.ids)}
        for own in anchors.values():
            own.low = np.full((len(own.ids), n_positives), HIGHEST)
            own.high = np.full((len(own.ids), n_positives), LOWEST)
        # At most n_positives rows for each anchor of the chunk.
        for r in positives.collect():
            dims, i = places[r.anchor_id]
            anchors[dims].low[i, r["rank"] - 1] = -(-least_share * r.score // 100)
            anchors[dims].high[i, r["rank"] - 1] = r.score
        negatives = _scan(blocks, anchors, n_negatives, search_negatives)
        of_positive = positives.select(
            "anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        negatives.join(of_positive, ["anchor_id", "positive_rank"]).select(
            "anchor_id", "positive_rank", "positive_id", "positive_score", "rank",
            F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
        common.remove(spark, path)
    common.remove(spark, blocks_path, anchors_path)
    return spark.read.schema(RESULT).parquet(out)


RESULT = (
    "anchor_id long, positive_rank int, positive_id long, positive_score long, rank int, negative_id long, negative_score long"
)
