"""From raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes the session, the documents that its
predecessor kept and the folder of the tables.  All but the last return documents with their
columns; the last returns packed pieces with their token ids.  ``run`` applies them to the
``documents`` table, each stage's result written to the shared folder and read again.

Stages take rows with null or repeated ids, null, empty and very long texts, repeated rows, empty
tables and further columns; what becomes of them is told in the operators' modules.
"""

from pyspark.sql import DataFrame, SparkSession

from stationlens.llm import common, minhash, packing, quality, toxicity

VOCABULARY = "word_bpe_49k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"), threshold=0.5)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity network rejects."""
    return toxicity.keep_clean(docs, common.table(spark, sf_dir, "labels"), threshold=0.7)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near-duplicates."""
    return minhash.one_of_each(docs, threshold=75)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the documents' tokens into sequences of 2048.

    Workers that have run the stages before hold more memory, so this remembers fewer words.
    """
    return packing.pack(docs, common.tokenizer_file(VOCABULARY), length=2048, remembered=120_000)


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("minhash near-dedup", one_of_each),
    ("packing", packed),
]

#: The learned stages have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
