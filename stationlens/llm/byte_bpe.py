"""Byte-level BPE over a rank file, each distinct word encoded once; and decoding.

Words are cut at spaces such that none of the pattern's matches is cut; a word is then one or
more matches.  Distinct words are dealt by hash (``word_blocks``), each is encoded once, and its ids
return to the blocks that have it, where documents are put together by position.  Decoding joins the
table of token bytes, which has one row for each rank of the vocabulary.

Defined cases: null and empty texts have no ids and decode to nothing; repeated rows and
repeated or null ids are each encoded; a text of any length is encoded whole; an empty
table gives an empty table; other columns are ignored.
"""

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, word_blocks as wb

ID_BYTES = 4
#: White space that a cut at single spaces might divide otherwise than the pattern.
RUNS = re.compile(r"\s{3}|\s\s\Z")
#: Signs on which libraries differ as to whether they are white space.
DOUBTFUL = re.compile("[\x00\x1c-\x1f\x85]")
#: Texts with either, for Arrow's expressions, whose own \s has fewer signs than that of Python.
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD = r"[\x00\x1c-\x1f\x{85}]|" + _SPACES + "{3}|" + _SPACES + r"{2}\z"


def ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str):
    """Words of a text: cut before each space, or where the pattern cuts if white space is odd."""

    def split(text: str) -> list[bytes]:
        if DOUBTFUL.search(text):
            return [text.encode()]
        if RUNS.search(text):
            import regex

            return [m.encode() for m in regex.findall(pattern, text)]
        words = text.encode().replace(b" ", b"\0 ").split(b"\0")
        return words if words[0] else words[1:]

    return split


def array_splitter(pattern: str):
    """``splitter`` for arrays of texts: arrays of their words, and the number of words of each text."""
    split = splitter(pattern)

    def at_spaces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words lie in the texts' own buffer; only where they begin is worked out."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(ends[0]), int(ends[-1])
        if first == last:
            return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
        begins = np.frombuffer(texts.buffers()[2], np.uint8)[first:last] == ord(" ")
        begins[ends[:-1][ends[:-1] < ends[1:]] - first] = True
        starts = np.append(np.flatnonzero(begins) + first, last).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), texts.buffers()[2]])
        return words, np.diff(np.searchsorted(starts, ends))

    def split_array(texts: pa.Array) -> tuple[list[pa.Array], np.ndarray]:
        texts = texts.cast(pa.string())
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        edges = (np.flatnonzero(odd[1:] != odd[:-1]) + 1).tolist()
        words, sizes = [], []
        for a, b in zip([0, *edges], [*edges, len(texts)], strict=True):
            if odd[a]:
                listed = [split(text) for text in texts.slice(a, b - a).to_pylist()]
                words.append(pa.array([w for own in listed for w in own], pa.binary()))
                sizes.append(np.fromiter(map(len, listed), np.int64, b - a))
            else:
                found, each = at_spaces(texts.slice(a, b - a))
                words.append(found)
                sizes.append(each)
        return words, np.concatenate(sizes)

    return split_array


_encoders: dict = {}


def _encoder(rank_file: str, pattern: str):
    if (rank_file, pattern) not in _encoders:
        import tiktoken

        _encoders[rank_file, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks(rank_file), special_tokens={}
        )
    return _encoders[rank_file, pattern]


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", store: bool = False
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    ``store`` writes the numbered texts to the shared folder first; it is needed where ``docs``
    is not read from files (see ``word_blocks``).
    """
    texts = common.id_and_text(docs, id_col, text_col).withColumn("flag", F.lit(0))
    blocks = wb.cut_blocks(texts, split_array=array_splitter(pattern), store=store)

    @common.giving_back
    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("check", pa.int64()), ("body", pa.binary())])
        encoder, bucket, known = _encoder(rank_file, pattern), None, {}
        for row in wb.rows_of(batches):
            if row["part"] != bucket:
                bucket, known = row["part"], {}
            words = wb.unpack_words(wb.split_parts(row["body"])[0])
            for word in words:
                if word not in known:
                    known[word] = np.array(encoder.encode_ordinary(word.decode()), "<u4").tobytes()
            ids = [known[word] for word in words]
            lengths = np.fromiter(map(len, ids), np.uint32, len(ids)) // ID_BYTES
            body = wb.join_parts(wb.pack_numbers(lengths), wb.pack_numbers(np.frombuffer(b"".join(ids), "<u4")))
            yield wb.batch_of([(row["block"], bucket, row["n"], row["check"], body)], schema)

    encoded = wb.by_bucket(blocks).mapInArrow(encode_words, "block long, part int, n int, check long, body binary")

    @common.giving_back
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        block, lengths, ids, checks, ready, places = None, [], [], [], None, wb.Places()
        for row in wb.rows_of(batches):
            if row["block"] != block:
                block, lengths, ids, checks, ready, places = row["block"], [], [], [], None, wb.Places()
            if row["kind"] == wb.WORDS:
                checks.append(row["check"])
                for into, part in zip((lengths, ids), wb.split_parts(row["body"]), strict=True):
                    into.append(wb.unpack_numbers(part))
                continue
            wb.same_words(checks, row)
            if ready is None:
                length = np.concatenate(lengths).astype(np.int64) if lengths else np.empty(0, np.int64)
                ready = length, np.cumsum(length) - length, np.concatenate(ids) if ids else np.empty(0, "<u4")
            length, start, table = ready
            numbers = places.of(row["body"])
            sizes = np.array(row["sizes"], np.int64)
            each = length[numbers]
            ends = np.cumsum(each)
            at = np.repeat(start[numbers] - (ends - each), each) + np.arange(int(each.sum()))
            found = table[at].astype("<u4").tobytes()
            word_ends = np.cumsum(sizes)
            id_ends = np.concatenate([[0], ends])[word_ends]
            id_starts = np.concatenate([[0], ends])[word_ends - sizes]
            yield wb.batch_of(
                ((d, b - a, found[a * ID_BYTES : b * ID_BYTES]) for d, a, b in zip(row["doc_ids"], id_starts.tolist(), id_ends.tolist(), strict=True)),
                schema,
            )

    return wb.to_blocks(blocks, encoded).mapInArrow(assemble, "doc_id long, n_tokens long, ids binary")


def token_table(spark: SparkSession, rank_file: str) -> DataFrame:
    """(rank, token): the bytes of every token, one row for each rank of the vocabulary."""
    rows = [(rank, bytearray(token)) for token, rank in sorted(ranks(rank_file).items(), key=lambda x: x[1])]
    return spark.createDataFrame(rows, "rank long, token binary")


#: Documents whose different ids are looked up together.
LOOKED_UP = 256
_ASKED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("rank", pa.int64())])


#: Ranks below this are marked in an array as long, others sorted.
MARKED = 1 << 20


def _different(ids: list[np.ndarray]) -> np.ndarray:
    """The different ids of some documents, ascending."""
    if max((int(x.max()) for x in ids if len(x)), default=0) >= MARKED:
        return np.unique(np.concatenate(ids)).astype(np.int64)
    met = np.zeros(MARKED, np.bool_)
    for x in ids:
        met[x] = True
    return np.flatnonzero(met).astype(np.int64)


def _with_ranks(encoded: DataFrame) -> DataFrame:
    """The documents, before each ``LOOKED_UP`` of them a row for every rank they have."""

    @common.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, LOOKED_UP) for b in batches for at in range(0, b.num_rows, LOOKED_UP)):
            used = _different([np.frombuffer(ids.as_py(), "<u4") for ids in batch.column(2)])
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(used), pa.binary()), pa.array(used)], schema=_ASKED)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.int64())], schema=_ASKED)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, rank long")


def decode(encoded: DataFrame, rank_file: str, keep_ids: bool = False) -> DataFrame:
    """Per row of ``encode``: doc_id, n_tokens, decoded (bytes) and, if asked for, ids_decimal,
    the ids in decimal joined by one space.

    The ids that some documents have are exploded, each once, and joined with the token table, which is
    broadcast: it is as large as the vocabulary.  Such a join keeps the order of its other side's
    rows, so the tokens come just before the documents that they are put together to.
    """
    kinds = "doc_id long, n_tokens long, decoded binary" + ", ids_decimal binary" * keep_ids
    names = ["doc_id", "n_tokens", "decoded"] + ["ids_decimal"] * keep_ids

    @common.giving_back
    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, tokens, decimal, open_ = np.empty(0, np.int64), None, [], [], False
        for batch in batches:
            is_rank = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(is_rank[1:] != is_rank[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if is_rank[a]:
                    if not open_:
                        known, place, tokens, decimal, open_ = np.empty(0, np.int64), None, [], [], True
                    if part.column(4).null_count:
                        raise ValueError("an id that the vocabulary doesn't have")
                    known = np.concatenate([known, part.column(3).to_numpy()])
                    tokens += part.column(4).to_pylist()
                    decimal = [str(x).encode() for x in known.tolist()] if keep_ids else []
                    continue
                open_ = False
                if place is None:  # of every rank in the lists: as long as the vocabulary
                    place = np.zeros(int(known.max(initial=-1)) + 1, np.int32)
                    place[known] = np.arange(len(known), dtype=np.int32)
                decoded, written = [], []
                for ids in part.column(2):
                    at = place[np.frombuffer(ids.as_py(), "<u4")].tolist()
                    decoded.append(b"".join([tokens[i] for i in at]))
                    if keep_ids:
                        written.append(b" ".join([decimal[i] for i in at]))
                columns = [part.column(0), part.column(1), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(written, pa.binary())] * keep_ids, names=names)

    tokens = token_table(encoded.sparkSession, rank_file)
    met = _with_ranks(encoded).join(F.broadcast(tokens), "rank", "left")
    return met.select("doc_id", "n_tokens", "ids", "rank", "token").mapInArrow(put_together, kinds)
