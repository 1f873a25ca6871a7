"""Texts as blocks of numbered words, and the shuffle of their distinct words.

A task cuts its documents into blocks.  Inside a block every distinct word has a number and a
document is the list of its words' numbers, in order: its words with their positions.  Only the
block's distinct words travel, dealt by a hash of the word into *buckets*, so that a word's
rows from all blocks meet once, as one row for each block however often the block has it.
What is worked out there goes back to the blocks, where the documents are put together again.

The two tables are either written to the shared folder before anything is shuffled, or cut twice
from an input whose partitions are the same at every reading, as those of files are; a check
over a block's words stops the job if they weren't.  Rows:

* words: (block, part = bucket, n = words, check, body = the words and a count for each)
* documents: (block, part = running number, n = documents, check, doc_ids, flags, sizes, body =
  codes of their words)
"""

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, DOCUMENTS = 0, 1
SCHEMA = pa.schema([
    ("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("check", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("flags", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())),
    ("body", pa.binary()),
])
COLUMNS = (
    "kind int, block long, part int, n int, check long, doc_ids array<long>, flags array<int>, sizes array<int>, body binary"
)
#: A block ends with the document that brings it to so many bytes of words, or distinct words.
BLOCK_BYTES = 32 << 20
BLOCK_WORDS = 600_000
#: Where texts are cut in whole arrays: the bytes of those cut at a time, and the words that end a block.
SLICE_BYTES = 4 << 20
BLOCK_LENGTH = 8_000_000
#: Words of a block that get short codes.
COMMON = 1 << 16
#: Words in one row of documents, unless one document has more.
ROW_WORDS = 200_000


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(expand(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def join_parts(*parts: bytes) -> bytes:
    return b"".join(x for p in parts for x in (len(p).to_bytes(8, "little"), p))


def split_parts(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def pack_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), np.uint32, len(words))
    return join_parts(pack_numbers(lengths), squeeze(b"".join(words)))


def unpack_words(data: bytes) -> list[bytes]:
    lengths, joined = split_parts(data)
    ends = np.cumsum(unpack_numbers(lengths), dtype=np.int64).tolist()
    text = expand(joined)
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


class Numbered(dict):
    """Word to number, given out in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def batch_of(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts have some ``SLICE_BYTES``, or one longer text."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
    edges = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _as_list(words: pa.Array) -> Iterator[bytes]:
    for at in range(0, len(words), COMMON):
        yield from words.slice(at, COMMON).to_pylist()


def _distinct(chunks: list[pa.DictionaryArray]) -> tuple[pa.Array, np.ndarray]:
    """The different words of all chunks, and the number of every word.  The chunks are used up."""
    if not chunks:
        return pa.array([], pa.binary()), np.empty(0, np.int32)
    unified = pa.chunked_array(chunks).unify_dictionaries()
    chunks.clear()
    return unified.chunk(0).dictionary, np.concatenate([c.indices.to_numpy() for c in unified.chunks])


def _finished(
    block: int, buckets: int, words: pa.Array, docs: list, counted: Callable, kinds: tuple = (WORDS, DOCUMENTS)
) -> Iterator[tuple]:
    count = len(words)
    # Bucket by bucket, sorted inside, which packs well; a word's place is its place in this list.
    order = pc.sort_indices(words).to_numpy().astype(np.int64)
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in _as_list(words)), np.int64, count)
    order = order[np.argsort(bucket[order], kind="stable")]
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    every, counts = np.zeros(count, np.int64), np.zeros(count, np.int64)
    waiting = [[], []]
    for i, (_, flag, numbers) in enumerate(docs, 1):
        waiting[bool(counted(flag))].append(numbers)
        if i % 512 == 0 or i == len(docs):
            for y, into in enumerate(waiting):
                if into:
                    here = np.bincount(np.concatenate(into), minlength=count)
                    every += here
                    counts += here * y
            waiting = [[], []]
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    check = 0
    for b in range(buckets):
        at = order[edges[b] : edges[b + 1]]
        if len(at):
            own = words.take(pa.array(at)).to_pylist()
            crc = zlib.crc32(b"\0".join(own), b)
            check ^= crc
            if WORDS in kinds:
                body = join_parts(pack_words(own), pack_numbers(counts[at]))
                yield (WORDS, block, b, len(at), crc, None, None, None, body)
    if DOCUMENTS not in kinds:
        return
    # Common words have short codes: below COMMON the rank by count, above it the place.
    common_words = np.argsort(-every, kind="stable")[:COMMON]
    code = place + COMMON
    code[common_words] = np.arange(len(common_words))
    start, part = 0, 0
    while start < len(docs):
        end, size = start, 0
        while end < len(docs) and (end == start or size + len(docs[end][2]) <= ROW_WORDS):
            size += len(docs[end][2])
            end += 1
        row = docs[start:end]
        body = pack_numbers(code[np.concatenate([d[2] for d in row])])
        places = pack_numbers(place[common_words]) if part == 0 else b""
        yield (
            DOCUMENTS, block, part, len(row), check if part == 0 else 0, [d[0] for d in row], [d[1] for d in row],
            [len(d[2]) for d in row], join_parts(body, places),
        )
        start, part = end, part + 1


class Places:
    """The places of a block's words in its list, from the codes in its rows of documents.

    The first row of a block has the places of its common words.
    """

    def __init__(self):
        self.common = np.empty(0, np.int64)

    def of(self, body: bytes) -> np.ndarray:
        codes, places = split_parts(body)
        if places:
            self.common = unpack_numbers(places).astype(np.int64)
        codes = unpack_numbers(codes).astype(np.int64)
        short = codes < COMMON
        codes[short] = self.common[codes[short]]
        codes[~short] -= COMMON
        return codes


@dataclass
class Blocks:
    """The two tables; ``buckets`` is the number of parts that words are dealt into."""

    words: DataFrame
    documents: DataFrame
    buckets: int


def cut_blocks(
    docs: DataFrame,
    split: Callable[[str], list[bytes]] | None = None,
    counted: Callable[[int], bool] | None = None,
    store: bool = True,
    split_array: Callable[[pa.Array], tuple[list[pa.Array], np.ndarray]] | None = None,
) -> Blocks:
    """Cut ``docs`` (doc_id, text, flag) into blocks.

    ``split`` gives a text's words, or ``split_array`` those of an array of texts, in arrays, and the
    number of each text's words; a word's count in a block takes in the documents whose
    flag ``counted`` accepts (all without it).  Without ``store`` the input is read twice and
    nothing is written.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = counted or (lambda flag: True)

    def cut_arrays(kinds: tuple) -> Callable:
        @common.giving_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, blocks = TaskContext.get().partitionId(), 0
            chunks, ids, flags, sizes, size, length = [], [], [], [], 0, 0

            def flush() -> Iterator[pa.RecordBatch]:
                words, numbers = _distinct(chunks)
                common.give_back()  # what the texts took, before the words are sorted
                found = zip(ids, flags, np.split(numbers, np.cumsum(np.concatenate(sizes))[:-1]), strict=True)
                for row in _finished((task << 32) + blocks, buckets, words, list(found), counted, kinds):
                    yield batch_of([row], SCHEMA)

            for batch in batches:
                for part in slices(batch, 1) if batch.num_rows else ():
                    words, each = split_array(part.column(1))
                    chunks += [w.dictionary_encode() for w in words if len(w)]  # which keeps no text
                    ids += part.column(0).to_pylist()
                    flags += part.column(2).to_pylist()
                    sizes.append(each)
                    size += pc.sum(pc.binary_length(part.column(1))).as_py()
                    length += int(each.sum())
                    if size >= BLOCK_BYTES or length >= BLOCK_LENGTH:
                        yield from flush()
                        blocks += 1
                        chunks, ids, flags, sizes, size, length = [], [], [], [], 0, 0
            if ids:
                batch = part = words = None
                yield from flush()

        return run

    def cut(kinds: tuple) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, blocks = TaskContext.get().partitionId(), 0
            numbered, found, size = Numbered(), [], 0

            def flush() -> Iterator[pa.RecordBatch]:
                for row in _finished((task << 32) + blocks, buckets, pa.array(list(numbered), pa.binary()), found, counted, kinds):
                    yield batch_of([row], SCHEMA)

            for batch in batches:
                ids, flags = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                for doc_id, text, flag in zip(ids, batch.column(1), flags, strict=True):
                    words = split(text.as_py())
                    numbers = np.fromiter(map(numbered.__getitem__, words), np.uint32, len(words))
                    found.append((doc_id, flag, numbers))
                    size += sum(map(len, words))
                    if size >= BLOCK_BYTES or len(numbered) >= BLOCK_WORDS:
                        yield from flush()
                        blocks += 1
                        numbered, found, size = Numbered(), [], 0
            if found:
                yield from flush()

        return run

    def rows(*kinds: int) -> DataFrame:
        return docs.select("doc_id", "text", "flag").mapInArrow((cut_arrays if split_array else cut)(kinds), COLUMNS)

    if not store:
        return Blocks(rows(WORDS).drop("kind"), rows(DOCUMENTS).drop("kind"), buckets)
    stored, _ = common.stored(rows(WORDS, DOCUMENTS), "word-blocks", partition_by="kind")
    return Blocks(
        stored.where(f"kind = {WORDS}").drop("kind"), stored.where(f"kind = {DOCUMENTS}").drop("kind"), buckets
    )


def by_bucket(blocks: Blocks) -> DataFrame:
    """The rows of words, those of a bucket together, by block."""
    return (
        blocks.words.select("part", "block", "n", "check", "body")
        .repartition(blocks.buckets, "part")
        .sortWithinPartitions("part", "block")
    )


def to_blocks(blocks: Blocks, answers: DataFrame) -> DataFrame:
    """Per block first its answers (block, part, n, check, body) by bucket, then its documents."""
    none = {c: F.lit(None) for c in ("doc_ids", "flags", "sizes")}
    answered = answers.withColumns(none).withColumn("kind", F.lit(WORDS))
    documents = blocks.documents.withColumn("kind", F.lit(DOCUMENTS))
    return (
        documents.unionByName(answered)
        .repartition(blocks.buckets, "block")
        .sortWithinPartitions("block", "kind", "part")
        .select("kind", "block", "part", "n", "check", "doc_ids", "flags", "sizes", "body")
    )


def same_words(answered: list[int], document_row: dict) -> None:
    """Stop if the answers are not those to the words of the block's documents."""
    check = 0
    for crc in answered:
        check ^= crc
    if document_row["part"] == 0 and check != document_row["check"]:
        raise RuntimeError("the input's partitions differ between two readings; write it to a table first")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
