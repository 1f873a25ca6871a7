"""Concatenate-and-cut packing of documents into sequences of fixed length.

Pass one turns texts into ids in the order of the input's partitions and stores them with
running starts inside each partition.  The partition totals (one number a partition) are
summed into global offsets; pass two adds them and cuts at multiples of the sequence
length.  Nothing is shuffled but those totals.  A document that crosses a cut has a piece
on either side (a boundary record); every sequence but the last is full.

Defined cases: null and empty texts are the end id alone; repeated rows and repeated or null
ids are packed one by one; very long texts are stored in rows of at most ``ROW_IDS`` ids, so a
document may have two adjacent pieces in one sequence; an empty table gives an empty result;
other columns are ignored.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .token_ids import END_ID, ID_BYTES, REMEMBERED, word_ids

ROW_IDS = 32_768
STORED = (
    "part int, start_in_part long, doc_id long, doc_tokens long, start long, length long, ids binary"
)


def tokenised(docs: DataFrame, vocabulary: str, remembered: int = REMEMBERED) -> DataFrame:
    """Rows of at most ROW_IDS ids with their starts in the document and the partition."""

    @common.giving_back
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, at = word_ids(vocabulary, remembered), TaskContext.get().partitionId(), 0
        # A few documents at a time: their ids are held as bytes and again as Arrow columns.
        for batch in (b.slice(at_row, 256) for b in batches for at_row in range(0, b.num_rows, 256)):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids_of.of_text(text.as_py()) + END_ID
                total = len(ids) // ID_BYTES
                for start in range(0, total, ROW_IDS):
                    cut = ids[start * ID_BYTES : (start + ROW_IDS) * ID_BYTES]
                    length = len(cut) // ID_BYTES
                    rows.append((part, at, doc_id, total, start, length, cut))
                    at += length
            if rows:
                columns = [list(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES
                )

    return docs.mapInArrow(tokenise, STORED)


NAMES = [c.split()[0] for c in STORED.split(", ")]
TYPES = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in STORED.split(", ")]


def part_offsets(stored: DataFrame, length_col: str) -> DataFrame:
    """(part, base): ids in all partitions before.  One row a partition of the write."""
    spark = stored.sparkSession
    totals = stored.groupBy("part").agg(F.sum(length_col).alias("n")).collect()
    base, rows = 0, []
    for part, n in sorted(totals):
        rows.append((part, base))
        base += n
    return spark.createDataFrame(rows, "part int, base long")


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids
    (little-endian unsigned 32-bit) and whether it was cut at its start or end.

    ``remembered`` bounds the words that a task keeps: fewer take less memory and more time.
    """
    stored, _ = common.stored(
        tokenised(common.id_and_text(docs, id_col, text_col), vocabulary, remembered), "packing-ids"
    )
    # The offsets are as many rows as the first pass had tasks, some bytes each.
    placed = stored.join(F.broadcast(part_offsets(stored, "length")), "part").withColumn(
        "at", F.col("base") + F.col("start_in_part")
    )
    size = F.lit(length).cast("long")
    pieces = placed.select(
        "*",
        F.explode(F.sequence(
            F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("length") - 1) / size)
        )).alias("sequence_id"),
    )
    begin = F.greatest(F.col("at"), F.col("sequence_id") * size)
    end = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * size)
    return (
        pieces.withColumns({"begin": begin, "end": end})
        .withColumns({"skip": F.col("begin") - F.col("at"), "take": F.col("end") - F.col("begin")})
        .select(
            "doc_id",
            (F.col("start") + F.col("skip")).alias("start"),
            F.col("take").alias("length"),
            "doc_tokens",
            "sequence_id",
            (F.col("begin") - F.col("sequence_id") * size).alias("offset"),
            F.substring(
                F.col("ids"),
                (F.col("skip") * ID_BYTES + 1).cast("int"),
                (F.col("take") * ID_BYTES).cast("int"),
            ).alias("ids"),
            (F.col("start") + F.col("skip") > 0).alias("continues"),
            (F.col("start") + F.col("skip") + F.col("take") < F.col("doc_tokens")).alias("continued"),
        )
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences (sequence_id, length, ids, doc_ids) out of their pieces.

    A sequence has at most its length in pieces, so each group is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (
        pieces.groupBy("sequence_id").agg(ordered.alias("p"))
        .select(
            "sequence_id",
            F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("length"),
            F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
            F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        )
    )
