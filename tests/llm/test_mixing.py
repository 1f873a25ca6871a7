"""Mixing against a plain systematic sample, on odd inputs."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stationlens.llm import mixing

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain_targets(sizes, weights, most):
    """Share by weight, stop what is above, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {s for s in names if sizes[s] == 0}, sum(sizes.values())
    while True:
        left = [s for s in names if s not in full]
        if not left:
            return {s: float(most * sizes[s]) for s in names}
        share = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in left)
        above = {s for s in left if share * weight[s] >= most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in full else share * weight[s] for s in names}
        full |= above


def plain_mix(rows, weights=(5, 2, 1), most=3, seed="mix"):
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        size = len(SPACED.findall(text or ""))
        by_source[source].append((size, md5("" if doc_id is None else str(doc_id)), -1 if doc_id is None else doc_id, md5(text or ""), doc_id))
    sizes = {s: sum(r[0] for r in found) for s, found in by_source.items()}
    targets, out = plain_targets(sizes, weights, most), []
    for s, found in by_source.items():
        offset = int(md5(seed + ("" if s is None else "=" + s))[:6], 16)
        step = int(targets[s] / sizes[s] * 2**24) if sizes[s] else 0
        for i, (size, _, _, _, doc_id) in enumerate(sorted(found, key=lambda r: r[:4])):
            copies = (offset + (i + 1) * step >> 24) - (offset + i * step >> 24)
            out.append((doc_id, size, sizes[s], targets[s], copies, copies * size))
    return sorted(out, key=repr)


def corpus():
    rows = [(i, " ".join(["word"] * (i * 37 % 101 + 1)), f"s{i % 4}" if i % 3 else "s0") for i in range(600)]
    rows += [(1000 + i, "a b c", None) for i in range(20)] + [(2000, None, "empty"), (2001, " \t\x0b\x0c\r\n ", "empty")]
    rows += [(None, "x", "s1")] * 7 + [(5, "same id, other text", "s1"), (5, "same id", "s2")] + [(3000, "copy of a row", "s3")] * 40
    rows += [(4000, "w " * 30_000, "long"), (4001, "one", "long"), (4002, "x y", ""), (4003, "é ü　z a\x1cb", "ä"), (4004, "\n lead", "ä")]
    return rows


def mixed(spark, rows, **options):
    docs = spark.createDataFrame(
        [(*r, 1, "b") for r in rows], "doc_id long, text string, source string, size int, bucket string"
    )
    return mixing.mix(docs.repartition(5), **options)


def as_rows(df):
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r.copies, r.taken) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bucket, chunk", [(50_000, 10_000), (3, 4)])
def test_mix_is_the_plain_sample(spark, monkeypatch, bucket, chunk):
    monkeypatch.setattr(mixing, "BUCKET", bucket)  # the places don't depend on buckets, nor on how rows unfold
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = corpus()
    assert as_rows(mixed(spark, rows)) == plain_mix(rows)
    assert as_rows(mixed(spark, rows[::-1])) == plain_mix(rows)


def test_other_weights_and_caps(spark):
    rows = corpus()
    assert as_rows(mixed(spark, rows, weights=(1, 9), most_copies=2, seed="again")) == plain_mix(rows, (1, 9), 2, "again")


def test_taken_words_are_near_the_target(spark):
    found = mixed(spark, corpus()).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("longest"), F.max("copies").alias("copies")
    )
    for r in found.collect():
        assert abs(r.taken - r.target) <= r.longest + 1 and r.copies <= 3, r


def test_targets_stop_and_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), ("d", 0), (None, 500)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found == {"a": 30.0, "b": pytest.approx(2 / 4 * (1515 - 30 - 15)), "c": 15.0, "d": 0.0, None: pytest.approx(2 / 4 * 1470)}
    assert sum(found.values()) == pytest.approx(1515)


def test_texts_come_as_often_as_taken(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, copies int")
    mix = mixing.mix(docs)
    wanted = defaultdict(int)
    for r in mix.collect():
        wanted[(r.doc_id, r.source, r.digest)] += r.copies
    found = defaultdict(list)
    for r in mixing.texts(docs, mix).collect():
        found[(r.doc_id, r.source, md5(r.text))].append(r["copy"])
    assert {k: sorted(v) for k, v in found.items()} == {k: list(range(n)) for k, n in wanted.items() if n}


def test_empty_table(spark):
    assert mixed(spark, []).collect() == []


def test_word_count(spark):
    texts = ["", None, " ", "a", " a", "a ", "\x0b a\tb\r\nc  ", "x" * 100_000, "a b c\x1cd", "x xx x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [len(SPACED.findall(t or "")) for t in texts]


def test_no_python_in_the_plan(spark):
    plan = mixed(spark, corpus())._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
