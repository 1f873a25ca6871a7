"""Id files, packing, byte-level BPE and WARC against plain versions, on odd inputs."""

import base64
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlens.llm import byte_bpe, id_files, packing, simple8b, warc_store
from stationlens.llm.token_ids import WordIds

from .conftest import prose

ODD = [
    "", None, " ", "plain words here", "A<|endoftext|>b", "é caf́e H̱ Å", "ends... well,\"", "x" * 3000,
    "it's 'll don't", "tab\tnew\nline\r\n", "　wide spaces\x85\x1cq", "emoji 😀😀 ok", "dup", "dup", "a  b   c ",
    prose(1, 3000), "Σ ΑΣ İ ß", "\x00nul",
]


def plain_ids(path, text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path("word_bpe_49k.json")).encode(text or "", add_special_tokens=False).ids


def as_ids(data):
    return np.frombuffer(bytes(data), "<u4").tolist()


def test_word_ids_are_the_librarys(path_of):
    ids = WordIds(path_of("word_bpe_49k.json"), limit=5)  # forgets all the time
    for text in ODD:
        if text is not None:
            assert as_ids(ids.of_text(text)) == plain_ids(path_of, text), text


@pytest.mark.parametrize("limit", [5, 500_000])
def test_arrays_of_texts_have_the_librarys_ids(path_of, monkeypatch, limit):
    """A word that an array has often is looked up once, and new words reach the library together."""
    import pyarrow as pa
    from stationlens.llm import token_ids
    monkeypatch.setattr(token_ids, "JOINED_WORDS", 7)
    monkeypatch.setattr(token_ids, "CALL_WORDS", 3)
    ids = WordIds(path_of("word_bpe_49k.json"), limit=limit)
    texts = [t or "" for t in ODD] + ["\u0344 x", " lead", "trail ", "a\x0bb\x0cc", "<|startoftext|> <|", "it's we'll", "A-b_c9"]
    for array in (pa.array(texts * 2), pa.array(texts)[3:8], pa.array(["", " "]), pa.array([], pa.string()), pa.array(["a"], pa.large_string())):
        found, counts = ids.of_array(array)
        want = [plain_ids(path_of, t) for t in array.to_pylist()]
        assert counts.tolist() == [len(w) for w in want]
        assert found.tolist() == [i for w in want for i in w]
    asked = []
    monkeypatch.setattr(WordIds, "__missing__", lambda self, word: asked.append(word))
    monkeypatch.setattr(WordIds, "of_text", lambda self, text: asked.append(text))
    ids.of_array(pa.array(["seldom seen wordds"] * 3))
    assert not asked


def test_letters_reach_the_model_as_they_are(path_of):
    import random
    rng = random.Random(5)
    ids = WordIds(path_of("word_bpe_49k.json"))
    assert ids.model is not None
    words = ["".join(rng.choice("etaoinshrdlux") for _ in range(rng.randrange(1, 25))) for _ in range(2000)]
    assert [as_ids(x) for x in ids._of_new([w.encode() for w in words])] == [plain_ids_of(ids, w) for w in words]
    for changed in ("normalizer", "pre_tokenizer"):
        from tokenizers import normalizers, pre_tokenizers
        other = WordIds(path_of("word_bpe_49k.json"))
        setattr(other.tokenizer, changed, {"normalizer": normalizers.Replace("e", "i"), "pre_tokenizer": pre_tokenizers.Split("e", "isolated")}[changed])
        assert not other._leaves_letters()


def plain_ids_of(ids, text):
    return ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_id_files_in_small_segments(spark, documents, path_of, monkeypatch):
    """Segments end with the document that fills them, wherever slices end."""
    from stationlens.llm import word_blocks
    monkeypatch.setattr(id_files, "SEGMENT_IDS", 40)
    monkeypatch.setattr(word_blocks, "SLICE_BYTES", 100)
    texts = [*ODD, *(prose(i, i) for i in range(30))]
    path = id_files.write_ids(documents(texts), path_of("word_bpe_49k.json"))
    at = 0
    for row in id_files.read_ids(spark, path).orderBy("doc_id").collect():
        want = plain_ids(path_of, texts[row.doc_id]) + [1]
        assert (row.start, row.n_tokens, as_ids(row.ids)) == (at, len(want), want)
        at += len(want)
    segments = spark.read.parquet(path).collect()
    assert all(sum(s.doc_tokens[:-1]) < 40 and s.tokens == sum(s.doc_tokens) for s in segments)
    assert len(segments) > 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_simple8b_round_trip(ids):
    data = simple8b.encode_segment(np.array(ids, np.uint64))
    assert simple8b.decode_segment(data).tolist() == ids


def test_simple8b_blocks_alone_and_damage():
    ids = np.arange(3 * simple8b.BLOCK_IDS + 7) % 50_000
    data = simple8b.encode_segment(ids)
    assert simple8b.decode_segment(data, 1, 2).tolist() == ids[simple8b.BLOCK_IDS : 2 * simple8b.BLOCK_IDS].tolist()
    with pytest.raises(ValueError):
        simple8b.decode_segment(data[:-1] + b"\x01")


def test_id_files(spark, documents, path_of):
    docs = documents(ODD)
    rows = id_files.read_ids(spark, id_files.write_ids(docs, path_of("word_bpe_49k.json"))).collect()
    at = 0
    for row in sorted(rows, key=lambda r: r.doc_id):
        want = plain_ids(path_of, ODD[row.doc_id]) + [1]
        assert (row.start, row.n_tokens, as_ids(row.ids)) == (at, len(want), want)
        at += len(want)
    assert len(rows) == len(ODD)


def test_id_files_null_and_repeated_ids_and_empty(spark, documents, path_of):
    docs = documents(["b", "a", "c", "c"], [5, 5, None, 5])
    rows = id_files.read_ids(spark, id_files.write_ids(docs, path_of("word_bpe_49k.json"))).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 5, 5, 5]
    assert rows[-1].start == sum(r.n_tokens for r in rows[:-1])
    assert id_files.read_ids(spark, id_files.write_ids(docs.limit(0), path_of("word_bpe_49k.json"))).count() == 0


def test_packing(spark, documents, path_of, monkeypatch):
    monkeypatch.setattr(packing, "ROW_IDS", 500)  # a document in several rows
    docs = documents([*ODD, "twice"], [*range(len(ODD)), None])
    pieces = packing.pack(docs.repartition(3), path_of("word_bpe_49k.json"), length=64)
    rows = pieces.collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc_id, own in by_doc.items():
        want = plain_ids(path_of, "twice" if doc_id is None else ODD[doc_id]) + [1]
        own.sort(key=lambda r: r.start)
        assert [i for r in own for i in as_ids(r.ids)] == want
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert {r.doc_tokens for r in own} == {len(want)}
    assert set(by_doc) == {*range(len(ODD)), None}
    for sequence_id, own in by_seq.items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == 64 or sequence_id == max(by_seq)
    whole = packing.sequences(pieces).collect()
    assert {r.sequence_id: len(as_ids(r.ids)) for r in whole} == {k: sum(r.length for r in v) for k, v in by_seq.items()}
    assert packing.pack(docs.limit(0), path_of("word_bpe_49k.json")).count() == 0


def test_packing_repeated_ids(spark, documents, path_of, monkeypatch):
    """Rows that share an id, or have none, are packed one by one."""
    monkeypatch.setattr(packing, "ROW_IDS", 40)
    texts = [prose(i, 30 + i) for i in range(12)] + [prose(3, 33)] * 3 + [None, ""]
    docs = documents(texts, [None if i % 3 == 0 else 5 if i % 3 == 1 else i for i in range(len(texts))])
    whole = packing.sequences(packing.pack(docs.repartition(4), path_of("word_bpe_49k.json"), length=64)).orderBy("sequence_id").collect()
    packed = [i for r in whole for i in as_ids(r.ids)]
    found, now = [], []
    for i in packed:
        now.append(i)
        if i == 1:
            found.append(now)
            now = []
    assert not now and sorted(found) == sorted(plain_ids(path_of, t) + [1] for t in texts)


def test_byte_bpe(spark, documents, path_of):
    import tiktoken
    from public_tokenizers import PATTERN
    ranks = path_of("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks(ranks), special_tokens={})
    texts = [*ODD, "  a", "a  ", " \n b", "a\n\n b", "a \n"]
    docs = documents(texts)
    encoded = byte_bpe.encode(docs, ranks, PATTERN, store=True)
    got = {r.doc_id: r for r in encoded.collect()}
    for i, text in enumerate(texts):
        assert as_ids(got[i].ids) == plain.encode_ordinary(text or ""), text
        assert got[i].n_tokens == len(as_ids(got[i].ids))
    decoded = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(encoded, ranks).collect()}
    assert decoded == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert byte_bpe.encode(docs.limit(0), ranks, PATTERN).count() == 0
    assert byte_bpe.decode(encoded.limit(0), ranks).count() == 0


@pytest.mark.parametrize("looked_up", [1, 3, 256])
def test_byte_bpe_null_and_repeated_ids(spark, documents, path_of, monkeypatch, looked_up):
    """Decoding joins the token table, some documents at a time; ids tell nothing."""
    import tiktoken
    from public_tokenizers import PATTERN
    monkeypatch.setattr(byte_bpe, "LOOKED_UP", looked_up)
    ranks = path_of("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks(ranks), special_tokens={})
    texts = [t or "" for t in ODD] * 3
    docs = documents(texts, [None if i % 3 else 7 for i in range(len(texts))])
    decoded = byte_bpe.decode(byte_bpe.encode(docs, ranks, PATTERN, store=True), ranks, keep_ids=True)
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    got = sorted((bytes(r.decoded).decode(), bytes(r.ids_decimal).decode(), r.n_tokens) for r in decoded.collect())
    want = [(t, plain.encode_ordinary(t)) for t in texts]
    assert got == sorted((t, " ".join(map(str, ids)), len(ids)) for t, ids in want)


def test_arrays_of_texts_are_cut_like_each_text():
    """Whole arrays of texts are cut as each text alone, odd ones among plain ones."""
    import sys

    import pyarrow as pa
    from public_tokenizers import PATTERN
    split, split_array = byte_bpe.splitter(PATTERN), byte_bpe.array_splitter(PATTERN)
    spaces = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    texts = [t or "" for t in ODD] + [x for c in spaces for x in (f"a{c * 3}b", f"a b{c * 2}", f" a{c}b c ")]
    for array in (pa.array(texts), pa.array(texts)[5:9], pa.array(["", ""]), pa.array(["a b", "", " c"], pa.large_string())):
        words, sizes = split_array(array)
        want = [split(t) for t in array.to_pylist()]
        assert sizes.tolist() == [len(w) for w in want]
        assert [w for part in words for w in part.to_pylist()] == [w for own in want for w in own]


def test_cutting_holds_texts_once(spark, documents, path_of, monkeypatch):
    """Words stay in the texts' own buffer until a block's different ones are taken: no object for each."""
    import tiktoken
    from public_tokenizers import PATTERN

    def refuse(*_):
        raise AssertionError("a list of words is made")
    texts = [prose(i, 400) for i in range(40)] + ["", None, " a", "b "]
    ranks = path_of("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks(ranks), special_tokens={})
    monkeypatch.setattr(byte_bpe, "splitter", lambda pattern: refuse)
    monkeypatch.setattr(byte_bpe.wb, "SLICE_BYTES", 3000)
    monkeypatch.setattr(byte_bpe.wb, "BLOCK_LENGTH", 2500)  # several blocks of several slices
    blocks = byte_bpe.encode(documents(texts), ranks, PATTERN, store=True)
    assert {r.doc_id: as_ids(r.ids) for r in blocks.collect()} == {
        i: plain.encode_ordinary(t or "") for i, t in enumerate(texts)
    }


def test_byte_bpe_workers_give_memory_back():
    """What waits for its next task keeps nothing: every step of encoding and decoding gives memory back."""
    import inspect
    source = inspect.getsource(byte_bpe)
    assert source.count("(batches: Iterator[pa.RecordBatch])") == source.count("@common.giving_back")


def test_ranks_above_the_marked_ones(monkeypatch):
    ids = [np.array(x, "<u4") for x in ([5, 3, 5], [], [4_000_000_000, 3])]
    assert byte_bpe._different(ids).tolist() == [3, 5, 4_000_000_000]
    assert byte_bpe._different(ids[:2]).tolist() == [3, 5]
    assert byte_bpe._different([]).tolist() == []


def test_byte_bpe_refuses_unknown_ids(spark, path_of):
    rows = spark.createDataFrame([(1, 1, bytearray((60_000_000).to_bytes(4, "little")))], "doc_id long, n_tokens long, ids binary")
    with pytest.raises(Exception, match="doesn't have"):
        byte_bpe.decode(rows, path_of("byte_bpe_50k.tiktoken")).collect()


def test_byte_bpe_stops_if_the_input_changes(spark, path_of):
    """Without a stored copy the input is read twice; rows that differ are found out."""
    from public_tokenizers import PATTERN
    from uuid import uuid4

    from pyspark.sql import functions as F
    other = F.udf(lambda i: uuid4().hex).asNondeterministic()
    docs = spark.range(50).select(F.col("id").alias("doc_id"), other("id").alias("text"))
    with pytest.raises(Exception, match="differ between two readings"):
        byte_bpe.encode(docs, path_of("byte_bpe_50k.tiktoken"), PATTERN).collect()


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")


def test_warc(spark):
    rows = [(3, "u3\r\nWARC-Type: warcinfo", "<p>é</p>"), (1, "u1", "<p>é</p>"), (2, None, None), (4, "u4", ""), (5, "u5", "x" * 100_000),
            (None, "n", "<p>é</p>"), (None, "m", "alone"), (7, "u7", "same"), (7, "u7", "same"), (8, "u8", "same")]
    paths = warc_store.write_archive(_pages(spark, rows))
    got = warc_store.read_archive(spark, paths).collect()
    assert len(got) == len(rows)
    assert spark.read.parquet(paths["payloads"]).count() == len({r[2] or "" for r in rows})
    for r in got:
        data = bytes(r.payload)
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert body == (data if r.record_type == "response" else b"") + b"\r\n\r\n"
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert (lines["WARC-Type"], lines["X-Page-ID"]) == (r.record_type, "" if r.page_id is None else str(r.page_id))
        assert lines["WARC-Payload-Digest"] == f"sha1:{r.payload_digest}" and lines["WARC-Record-ID"] == r.record_id
        assert int(lines["Content-Length"]) == len(body) - 4 and r.record_bytes == len(r.record)
        if r.record_type == "revisit":
            assert lines["WARC-Refers-To"] in {x.record_id for x in got if x.page_id == r.refers_to and x.record_type == "response"}
    assert len({r.record_id for r in got}) == len(got)
    assert set(spark.read.parquet(paths["headers"]).columns) == {"content_key", "header"}  # nothing beside the bytes
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in got)
    assert kinds == [(-1, "response", None), (-1, "revisit", 1), (1, "response", None), (2, "response", None),
                     (3, "revisit", 1), (4, "revisit", 2), (5, "response", None), (7, "response", None),
                     (7, "response", None), (8, "revisit", 7)]


def test_warc_small_payloads_and_empty(spark):
    rows = [(1, "a", "ab"), (2, "b", "ab"), (3, "c", "abcd"), (4, "d", "abcd")]
    paths = warc_store.write_archive(_pages(spark, rows), min_revisit_bytes=3)
    got = {r.page_id: r.record_type for r in warc_store.read_archive(spark, paths).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    empty = warc_store.write_archive(_pages(spark, rows).limit(0))
    assert warc_store.read_archive(spark, empty).count() == 0


def test_crc32_is_the_zlib_one(spark):
    from pyspark.sql import functions as F
    row = spark.range(1).select(F.crc32(F.lit(b"\x01\x00\x00\x00")).alias("c")).first()
    assert row.c == zlib.crc32(b"\x01\x00\x00\x00")
