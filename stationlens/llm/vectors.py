"""Vector tables: rows with usable vectors as bytes of doubles."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USABLE = "vec_id long, label string, dims int, vector binary"


def usable(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", short: bool = False
) -> DataFrame:
    """(vec_id, label, dims, vector) of rows without null or non-finite components; no others.

    Labels are compared as they are written, whatever their type.  ``short`` vectors are as
    :func:`compact` makes them, else doubles.
    """
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    ).where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False))
            sizes = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(sizes)
            bad = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(~np.isfinite(flat), out=bad[1:])
            keep = np.flatnonzero(bad[ends] == bad[ends - sizes])
            rows = [flat[ends[i] - sizes[i] : ends[i]] for i in keep]
            vectors = [compact(r[None])[0] if short else r.tobytes() for r in rows]
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(sizes[keep].astype(np.int32)), pa.array(vectors, pa.binary())],
                names=["vec_id", "label", "dims", "vector"],
            )

    return rows.mapInArrow(pack, USABLE)


def matrix(column: pa.Array) -> np.ndarray:
    """A binary column of equally long vectors as rows of doubles."""
    return np.stack([np.frombuffer(x.as_py(), np.float64) for x in column]) if len(column) else np.empty((0, 0))


def compact(rows: np.ndarray) -> list[bytes]:
    """Each row as bytes, of single floats where these hold it exactly."""
    with np.errstate(over="ignore"):
        single = rows.astype(np.float32)
    exact = (single == rows).all(axis=1).tolist()
    return [(f if e else r).tobytes() for f, r, e in zip(single, rows, exact, strict=True)]


def expanded(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of doubles of a column made by :func:`compact`."""
    rows = [x.as_py() for x in column]
    return np.stack([np.frombuffer(x, np.float32 if len(x) == 4 * dims else np.float64).astype(np.float64) for x in rows])
