"""Token-id files: whole texts as ids in ascending id order, in Simple-8b segments.

``write_ids`` deals the texts by ranges of their id, tokenises each range in order and
stores segments of whole documents; ``read_ids`` decodes them again.  Global starts follow
from one total a range.

Defined cases: null and empty texts are the end id alone; rows with null ids come first; rows of
one id follow each other by their text; very long texts make a segment of their own; an empty table gives
empty files; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, simple8b
from .packing import part_offsets
from .token_ids import END_ID, ID_BYTES, word_ids
from .word_blocks import slices

SEGMENT_IDS = 1 << 19
SEGMENTS = pa.schema([
    ("part", pa.int32()), ("start_in_part", pa.int64()), ("tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("segment", pa.binary()),
])
DOCUMENTS = pa.schema([
    ("part", pa.int32()), ("start_in_part", pa.int64()), ("doc_id", pa.int64()),
    ("n_tokens", pa.int64()), ("ids", pa.binary()),
])


def write_ids(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> str:
    """Write the files to the shared folder; returns their path."""

    end = int.from_bytes(END_ID, "little")

    @common.giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, at = word_ids(vocabulary), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        sizes: list[int] = []
        waiting: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(waiting)
            row = (part, at, len(ids), doc_ids, sizes, simple8b.encode_segment(ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, SEGMENTS, strict=True)], schema=SEGMENTS
            )

        for batch in (some for b in batches if b.num_rows for some in slices(b, 1)):
            ids, counts = ids_of.of_array(batch.column(1))
            ids = np.insert(ids, np.cumsum(counts), end)
            begin = upto = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), (counts + 1).tolist(), strict=True):
                doc_ids.append(doc_id)
                sizes.append(n)
                size += n
                upto += n
                if size >= SEGMENT_IDS:
                    waiting.append(ids[begin:upto])
                    yield segment()
                    at += size
                    begin, doc_ids, sizes, waiting, size = upto, [], [], [], 0
            waiting.append(ids[begin:])
        if doc_ids:
            yield segment()

    ordered = (
        common.id_and_text(docs, id_col, text_col)
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    spark = docs.sparkSession
    path = common.scratch_path(spark, "id-files")
    kinds = "part int, start_in_part long, tokens long, doc_ids array<long>, doc_tokens array<long>, segment binary"
    ordered.mapInArrow(encode, kinds).write.option("compression", "uncompressed").parquet(path)
    return path


def read_ids(spark, path: str) -> DataFrame:
    """Per document: doc_id, start (ids before it), n_tokens and ids (little-endian unsigned 32-bit)."""

    @common.giving_back
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode_segment(row["segment"]).astype("<u4").tobytes()
                counts = np.array(row["doc_tokens"], np.int64)
                starts = np.cumsum(counts) - counts
                cut = [ids[s * ID_BYTES : (s + n) * ID_BYTES] for s, n in zip(starts, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(counts), row["part"], np.int32)),
                    pa.array(starts + row["start_in_part"]),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(counts),
                    pa.array(cut, pa.binary()),
                ], schema=DOCUMENTS)

    files = spark.read.parquet(path)
    documents = files.select("part", "start_in_part", "doc_ids", "doc_tokens", "segment").mapInArrow(
        decode, "part int, start_in_part long, doc_id long, n_tokens long, ids binary"
    )
    return documents.join(F.broadcast(part_offsets(files, "tokens")), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )
