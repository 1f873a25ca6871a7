"""Registered queries of the operators in this subpackage, and their DuckDB SQL."""

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bond, byte_bpe, cover_tree, id_files, lm, minhash, mixing, multi_index, packing, periodic_runs, quality, toxicity, warc_store
from .common import table, tokenizer_file
from .oracle import ORACLE_SQL  # noqa: F401

WORD_VOCABULARY = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"), least_cosine=0.98)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=75)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(WORD_VOCABULARY))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = id_files.write_ids(table(spark, sf_dir, "documents"), tokenizer_file(WORD_VOCABULARY))
    return id_files.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    ranks = tokenizer_file(RANKS)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, PATTERN)
    return byte_bpe.decode(encoded, ranks, keep_ids=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_decimal", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc_store.write_archive(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return warc_store.read_archive(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_bytes"
    )


def op11_bond(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return bond.hard_negatives(rows, F.col("vec_id") % 100 == 0, scale=256.0)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most_copies=3).drop("digest")


def planted_runs(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a run planted in one text of ten, told by its id; a null id has none."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + period] * ((n - a) // period + 1))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), least_length=12, rewrite=planted_runs)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        "n_runs",
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multi_index": op1_multi_index,
    "op2_minhash": op2_minhash,
    "op3_packing": op3_packing,
    "op4_cover_tree": op4_cover_tree,
    "op5_gru_lm": op5_gru_lm,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_id_files": op8_id_files,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_warc_store": op10_warc_store,
    "op11_bond": op11_bond,
    "op12_mixing": op12_mixing,
    "op13_periodic_runs": op13_periodic_runs,
}
