"""Hard negatives against brute force, on odd inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlens.llm import bond

SCHEMA = "vec_id long, embedding array<double>, label string, dims int, score long, rank string"


def plain(rows, n_pos=5, n_neg=5, least=80, scale=256, every=10):
    good = [
        (i, l, [math.floor(scale * x) for x in v]) for i, v, l in rows
        if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, l, v in good:
        if i % every == 0 and (i not in anchors or (l, v) < anchors[i]):
            anchors[i] = (l, v)
    out = []
    for i, (l, v) in anchors.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in good if j != i and len(w) == len(v))
        positives = [(-s, j) for s, j, m in scored if m == l][:n_pos]
        for rank, (p, j) in enumerate(positives, 1):
            inside = [(-s, k) for s, k, m in scored if m != l and least * p <= 100 * -s <= 100 * p]
            out += [(i, rank, j, p, r, k, s) for r, (s, k) in enumerate(inside[:n_neg], 1)]
    return sorted(out)


def found(spark, rows, parts=4, every=10, **options):
    table = spark.createDataFrame([(*r, 1, 2, "r") for r in rows], SCHEMA).repartition(parts)
    mined = bond.hard_negatives(table, F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in mined.collect())


def cloud(n, dims=24, labels=3, seed=1, ids=None):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dims))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i if ids is None else ids[i], [float(x) for x in v[i]], f"l{rng.integers(labels)}") for i in range(n)]


@pytest.mark.parametrize("block, chunk", [(4096, 1 << 24), (16, 2000)])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(bond, "BLOCK", block)
    monkeypatch.setattr(bond, "CHUNK_BYTES", chunk)
    rows = cloud(400)
    want = plain(rows)
    assert len(want) > 100 and found(spark, rows) == want
    assert found(spark, rows, parts=1, n_positives=2, n_negatives=3, least_share=50) == plain(rows, 2, 3, 50)


def test_ties_copies_and_odd_rows(spark):
    rows = cloud(60, dims=20) + cloud(40, dims=7, seed=2, ids=range(500, 540))
    rows += [(i, rows[0][1], l) for i, l in ((70, "l0"), (71, "l1"), (72, "l1"), (73, "l2"), (80, "l0"))]  # copies: ties
    rows += [(90, None, "l0"), (91, [], "l0"), (100, [0.5] * 19 + [None], "l0"), (101, [0.5] * 19 + [math.nan], "l1")]
    rows += [(102, [0.5] * 19 + [-math.inf], "l1"), (None, [0.5] * 20, "l1"), (110, [0.1] * 20, None), (120, [0.0] * 20, "l0")]
    rows += [(121, [-0.0] * 20, "l0"), (122, [0.0] * 20, "l1"), (130, [-0.3] * 20, "only")]  # scores of 0; no positive
    rows += [(140, [0.2] * 20, "l0"), (140, [0.3] * 20, "l1"), (141, [0.25] * 20, "l0"), (141, [0.25] * 20, "l1")]  # repeated ids
    assert found(spark, rows) == plain(rows)


def test_large_components_are_exact_or_refused(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-(2**21), 2**21, 9)], f"l{i % 2}") for i in range(60)]  # scores beyond 2^53
    want = plain(rows)
    assert max(abs(r[3]) for r in want) > 2**53 and found(spark, rows) == want
    with pytest.raises(Exception, match="OverflowError"):
        found(spark, [(0, [1e300, 1.0], "a"), (1, [1.0, 1.0], "a")])
    with pytest.raises(Exception, match="OverflowError"):
        found(spark, [(0, [1e10, 1e10], "a"), (1, [1e10, 1e10], "a"), (2, [1e10, 1.0], "b")])


def test_empty_table_and_no_anchor(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], "a"), (2, [1.0], "b")]) == []


def test_scan_reads_less_than_all():
    """The bitmap shrinks: of clustered rows most leave it before all dimensions are read."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 64))
    near = np.floor(64 * (centres[np.repeat(np.arange(8), 50)] + 0.05 * rng.standard_normal((400, 64)))).astype(np.int64)
    block = bond.Block({
        "dims": 64, "ids": np.arange(400).tobytes(), "width": 8, "columns": np.ascontiguousarray(near.T).tobytes(),
        "names": ["a"], "edges": [0, 400],
    })
    anchors = bond.Anchors(np.array([1000]), ["a"], near[:1])
    block.ready(anchors)
    scores = near @ near[0]
    low = int(np.sort(scores)[-5])
    rows, exact, read = bond.vertical_scan(block, anchors, 0, np.arange(400), low, bond.HIGHEST)
    assert sorted(rows.tolist()) == np.flatnonzero(scores >= low).tolist() and (exact == scores[rows]).all()
    assert read < 0.7 * near.size
    # Without a score to reach, the sums so far tell which rows can't be among the best.
    rows, exact, read = bond.vertical_scan(block, anchors, 0, np.arange(400), bond.LOWEST, bond.HIGHEST, k=5)
    assert set(np.flatnonzero(scores >= low)) <= set(rows.tolist()) and (exact == scores[rows]).all()
    assert read < 0.8 * near.size
