"""MinHash, multi-index, cover tree and components against brute force, on odd inputs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from stationlens.llm import cover_tree, links, minhash, multi_index

from .conftest import prose


class Groups:
    """Union-find that keeps the least member as the root."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(a, b, threshold=75):
    return bool(a and b) and 100 * len(a & b) >= threshold * len(a | b)


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in text.split())


def corpus():
    base, passage = prose(1, 150), prose(99, 60)
    texts = ["", None, "  ", "one", "One", "one two three four", "a b c d e", "a b c d e", "A B C D E"]
    texts += [base] * 3 + [edited(base, s, i) for i, s in enumerate([0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.1, 0.3] * 5)]
    texts += [f"{prose(1000 + i, 40)} {passage} {prose(2000 + i, 30)}" for i in range(25)]
    chain = prose(5, 200)
    for i in range(6):  # each like the one before, the ends unlike
        texts.append(chain)
        chain = edited(chain, 0.02, 500 + i)
    texts += [prose(3, 4000), edited(prose(3, 4000), 0.02, 1), edited(prose(3, 4000), 0.5, 2)]
    return texts


def brute(texts, threshold=75):
    sets = [shingles(t) for t in texts]
    groups = Groups(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if linked(sets[a], sets[b], threshold):
            groups.join(a, b)
    return sets, groups


@pytest.mark.parametrize("block, threshold", [(minhash.BLOCK, 75), (8, 75), (8, 50), (minhash.BLOCK, 90)])
def test_minhash(spark, documents, monkeypatch, block, threshold):
    monkeypatch.setattr(minhash, "BLOCK", block)
    base = prose(77, 90)
    texts = corpus() + [edited(base, s, 900 + i) for i, s in enumerate([0.0, 0.005, 0.02, 0.05, 0.08] * 4)]
    sets, groups = brute(texts, threshold)
    rows = minhash.near_duplicates(documents(texts), threshold).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id])
        assert (r.component_id, r.kept) == (groups.root(r.doc_id), groups.root(r.doc_id) == r.doc_id), texts[r.doc_id]


def test_minhash_null_and_repeated_ids_and_empty(spark, documents):
    text = prose(7, 80)
    docs = documents([text, text, text, prose(8, 80), prose(9, 80), None], [4, None, 6, None, 4, 4])
    rows = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.n_shingles > 0, r.component_id or -1, r.kept) for r in rows) == [
        (-1, True, -1, True), (-1, True, 4, False), (4, False, 4, True), (4, True, 4, True), (4, True, 4, True), (6, True, 4, False)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    kept = minhash.one_of_each(docs).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == sorted([(-1, prose(8, 80)), (4, ""), (4, prose(9, 80)), (4, text)])
    assert minhash.one_of_each(docs).columns == docs.columns


def test_bounds_follow_from_the_threshold():
    assert minhash.bounds(75)[:2] == (48, 28)
    for threshold in (30, 50, 75, 90, 100):
        whole, shared, margin = minhash.bounds(threshold)
        assert whole == 64 * threshold // 100 and 1 <= shared <= 64 * threshold / 100 and 0 <= margin < 0.3
        n = np.arange(1, 200)
        least = minhash.least_shared(n, threshold)
        assert (least[n <= whole] >= n[n <= whole] * threshold / 100).all() and (least[n > whole] == shared).all()


def test_least_values_tell_whether_sets_may_be_linked():
    rng = np.random.default_rng(8)
    for size in (10, 300, 5000):
        for share in (0.2, 0.55, 0.74, 0.76, 0.8, 0.95, 1.0):
            both = int(size * share)
            values = rng.choice(2**62, 2 * size, replace=False).astype(np.uint64)
            x, y = np.sort(values[:size]), np.sort(np.concatenate([values[:both], values[size : 2 * size - both]]))
            linked = 100 * both >= 75 * (2 * size - both)
            found = minhash.near_enough(x[: minhash.WIDE], size, y[: minhash.WIDE], size, 75)
            assert found or not linked
            if size <= minhash.WIDE or both / (2 * size - both) < 0.6:
                assert found == linked


@pytest.mark.parametrize("broadcast", [minhash.MAX_BROADCAST_IDS, 0])
def test_one_of_each_tells_rows_by_id_and_text(spark, monkeypatch, broadcast):
    monkeypatch.setattr(minhash, "MAX_BROADCAST_IDS", broadcast)
    a, b, c, d = (prose(i, 80) for i in range(4))
    near_b = edited(b, 0.01, 1)
    rows = [(1, a), (1, b), (None, c), (None, c), (None, d), (2, b), (0, near_b), (3, a), (3, a), (5, d), (5, d), (5, ""), (6, None), (None, "")]
    names = ["dropped_id", "again_id", "kept_id", "row_id", "row_text", "out_id", "out_text", "_out_id", "node", "rows", "first", "salt"]
    docs = spark.createDataFrame([(i, t, *names) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    # a: 1 before 3; b and near_b: 0; c: one of the null ids; d: 5 (once) before null; no shingles: all.
    assert sorted(found, key=repr) == sorted([(1, a), (0, near_b), (None, c), (5, d), (5, ""), (6, None), (None, "")], key=repr)


def test_minhash_shuffle_join_when_ids_are_many(spark, documents, monkeypatch):
    monkeypatch.setattr(minhash, "MAX_BROADCAST_IDS", 0)
    texts = [prose(1, 60)] * 2 + [edited(prose(1, 60), 0.01, 1), prose(2, 60)]
    _, groups = brute(texts)
    rows = minhash.near_duplicates(documents(texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: groups.root(i) for i in range(len(texts))}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: groups.root(x) for x in groups.up}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vector_rows(n=400, dims=16):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((n, dims))
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(base)]
    for i in range(120):  # near ones around a few, so that one cell is crowded
        rows.append((n + i, (base[i % 4] + 0.02 * rng.standard_normal(dims)).tolist(), int((i % 4) % 3)))
    rows += [(900, base[0].tolist(), 0), (901, (2 * base[0]).tolist(), 0), (902, base[0].tolist(), 1), (903, base[0].tolist(), None),
             (904, None, 0), (905, [0.0] * dims, 0), (906, [float("nan")] + [1.0] * (dims - 1), 0), (907, [None] * dims, 0),
             (908, [], 0), (909, [1.0, 2.0], 0), (910, [1.0, 2.0], 0), (911, [float("inf")] * dims, 0)]
    return rows


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, cls int")


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block, cell, recall", [(multi_index.BLOCK, 512, 0.9995), (32, 4, 0.9995), (32, 4, 1.0), (64, 16, 1.0)])
def test_multi_index(spark, monkeypatch, block, cell, recall):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "CELL", cell)
    rows = vector_rows()
    n, groups = dict.fromkeys([r[0] for r in rows], 0), Groups([r[0] for r in rows])
    for (i, u, a), (j, v, b) in combinations(rows, 2):
        if a is not None and a == b and good(u) and good(v) and len(u) == len(v) and any(u) and any(v):
            if np.dot(u, v) >= 0.98 * np.linalg.norm(u) * np.linalg.norm(v):
                n[i] += 1
                n[j] += 1
                groups.join(i, j)
    got = {r.vec_id: r for r in multi_index.near_duplicates(vector_table(spark, rows), target_recall=recall).collect()}
    assert set(got) == set(n) and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    if recall == 1.0:  # by construction
        assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (n[i], groups.root(i)) for i in n}
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(n.values())
    assert all(got[i].n_links <= n[i] for i in n)
    assert sum(got[i].component_id != groups.root(i) for i in n) <= 0.01 * len(n)


def test_exact_limit_passes_over_cells_that_cannot_hold_a_link():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    sample = multi_index._unit(centres[rng.integers(6, size=600)] + 0.02 * rng.standard_normal((600, 16)))
    index = multi_index.MultiIndex(sample, 6, 0.98, 1.0)
    d = index.distances(sample)
    index.radii = [np.array([np.sqrt(x[x.argmin(axis=1) == c, c].max(initial=0)) for c in range(x.shape[1])]) for x in d]
    home = index.home(*d)
    linked = sample @ sample.T >= 0.98
    visited = [index.visits(a, b) for a, b in zip(*d, strict=True)]
    for i, cells in enumerate(visited):
        assert set(home[linked[i]].tolist()) <= set(cells) and len(set(cells)) == len(cells)
    assert np.mean([len(v) for v in visited]) < 0.2 * len(index.books[0]) * len(index.books[1])


def test_labels_are_compared_as_they_are(spark):
    rows = [(1, [1.0, 0.0], 1.2), (2, [1.0, 0.0], 1.7), (3, [1.0, 0.001], 1.2), (4, [1.0, 0.0], None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")
    got = {r.vec_id: (r.n_links, r.component_id) for r in multi_index.near_duplicates(table).collect()}
    assert got == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4)}


def test_multi_index_negative_zeros(spark):
    """A zero vector with -0.0 components links with nothing, is returned once and spoils no other."""
    rows = vector_rows()
    want = {r.vec_id: r for r in multi_index.near_duplicates(vector_table(spark, rows)).collect()}
    zeros = [(950, [-0.0] * 16, 0), (951, [0.0, -0.0] * 8, 0), (952, [-0.0] + [0.0] * 15, 0)]
    got = multi_index.near_duplicates(vector_table(spark, rows + zeros)).collect()
    assert len(got) == len(rows) + len(zeros)
    by_id = {r.vec_id: r for r in got}
    assert all((by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True) for i, _, _ in zeros)
    assert sum(r.n_links for r in want.values()) > len(want)
    assert {i: r for i, r in by_id.items() if i < 950} == want


def test_multi_index_odd_tables(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    table = vector_table(spark, rows)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in multi_index.near_duplicates(table).collect())
    assert got == [(-1, 0, -1, True), (-1, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]
    assert multi_index.near_duplicates(table.limit(0)).count() == 0
    assert multi_index.near_duplicates(vector_table(spark, [(1, None, 1), (2, [1.0], None)])).count() == 2


def test_multi_sequence_visits_nearest_cells_first():
    rng = np.random.default_rng(1)
    sample = multi_index._unit(rng.standard_normal((300, 8)))
    index = multi_index.MultiIndex(sample, 6, 0.9, 0.99)
    assert index.radii is None
    first, second = index.distances(sample)
    for a, b in zip(first[:40], second[:40], strict=True):
        cells = index.visits(a, b)
        d = (a[:, None] + b).ravel()
        assert sorted(cells) == np.flatnonzero(d <= d.min() + index.excess).tolist()
        assert np.all(np.diff(d[cells]) >= -1e-12)


def plain_top_k(rows, is_query, k=20, scale=64.0):
    usable = [(i, [int(np.floor(scale * x)) for x in v]) for i, v, _ in rows if i is not None and good(v)]
    asked = {}
    for i, q in usable:
        if is_query(i) and (i not in asked or np.array(q).tobytes() < np.array(asked[i]).tobytes()):
            asked[i] = q
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), j) for j, x in usable if j != i and len(x) == len(q))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def found_top_k(spark, rows, condition, **options):
    found = cover_tree.top_k(vector_table(spark, rows).repartition(3), condition, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


def clustered(n, dims, centres, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dims))
    return [(i, (middle[i % centres] + spread * rng.standard_normal(dims)).tolist(), 0) for i in range(n)]


@pytest.mark.parametrize(("rows_in_block", "queries_in_block", "chunk"), [(4096, 512, 1 << 24), (60, 7, 3000)])
def test_cover_tree(spark, monkeypatch, rows_in_block, queries_in_block, chunk):
    for name, value in (("ROWS", rows_in_block), ("QUERIES", queries_in_block), ("CHUNK_BYTES", chunk)):
        monkeypatch.setattr(cover_tree, name, value)
    rows = vector_rows() + [(2000 + i, v, x) for i, v, x in clustered(300, 16, 4)]
    is_query = lambda i: i % 20 == 0 or i == 909
    assert found_top_k(spark, rows, "vec_id % 20 = 0 or vec_id = 909") == plain_top_k(rows, is_query)


def test_cover_tree_few_rows_ties_and_repeated_queries(spark):
    rows = [(0, [1.0], 1), (1, [2.0], 1), (2, [2.0], 1), (0, [5.0], 1), (None, [9.0], 1), (3, [-4.0], 1), (3, [-4.0], 1)]
    got = found_top_k(spark, rows, "vec_id in (0, 3)", k=3)
    assert got == plain_top_k(rows, lambda i: i in (0, 3), k=3)
    assert [g[2] for g in got if g[0] == 0] == [1, 2, 3]  # one list for the repeated id
    assert cover_tree.top_k(vector_table(spark, rows).limit(0), "vec_id = 0").count() == 0
    assert found_top_k(spark, rows, "vec_id = 77") == []


def test_cover_tree_large_scores_are_exact_or_refused(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-(2**28), 2**28, 6)], 0) for i in range(300)]
    want = plain_top_k(rows, lambda i: i % 20 == 0, scale=1.0)
    assert max(abs(w[3]) for w in want) > 2**53
    assert found_top_k(spark, rows, "vec_id % 20 = 0", scale=1.0) == want
    for large in (1e300, 1e10):
        with pytest.raises(Exception, match="OverflowError"):
            found_top_k(spark, [(0, [large, 1.0], 0), (1, [large, 2.0], 0)], "vec_id = 0", scale=1.0)


def block_of(points, ids=None):
    whole = np.asarray(points).astype(np.int64)
    tree = cover_tree.CoverTree(whole.astype(float))
    ids = np.arange(len(whole)) if ids is None else ids
    return tree, cover_tree.Block({"dims": whole.shape[1], "ids": ids[tree.order].tobytes(), "matrix": whole[tree.order].tobytes(), "nodes": tree.packed()})


def test_cover_tree_covers():
    rng = np.random.default_rng(2)
    clusters = np.concatenate([c * 50 + rng.integers(-3, 4, (200, 6)) for c in rng.integers(-9, 10, (5, 6))]).astype(float)
    for points in (clusters, rng.standard_normal((500, 32)), np.zeros((100, 3)), np.ones((1, 2)), np.repeat(clusters[:40], 5, axis=0)):
        tree = cover_tree.CoverTree(points)
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        placed = points[tree.order]
        for centre, radius, a, b, first, last in tree.nodes:
            assert a <= centre < b
            assert np.linalg.norm(placed[a:b] - placed[centre], axis=1).max() <= radius + 1e-9
            if first < last:
                spans = [n[2:4] for n in tree.nodes[first:last]]
                assert spans[0][0] == a and spans[-1][1] == b
                assert all(x[1] == y[0] for x, y in zip(spans[:-1], spans[1:], strict=True))
                assert all(n[1] <= radius / 2 + 2 * tree.slack for n in tree.nodes[first:last])


def test_clustered_data_has_a_tree_and_is_pruned():
    rows = np.floor(64 * np.array([v for _, v, _ in clustered(4096, 64, 16)]))
    tree, block = block_of(rows)
    assert len(tree.nodes) > 16
    asked = np.floor(64 * np.array([v for _, v, _ in clustered(256, 64, 16, spread=0.06)]))
    _, queries = block_of(asked, np.arange(10_000, 10_256))
    best = cover_tree.Best(256, 20, np.full(256, cover_tree.LOWEST))
    taken = cover_tree.search(queries, block, best)
    assert taken < 0.15 * 256 * 4096
    scores = queries.points @ block.points.T
    for i in range(256):
        want = np.lexsort((block.ids, -scores[i]))[:20]
        at = best.query == i
        assert best.ids[at].tolist() == block.ids[want].tolist() and best.scores[at].tolist() == scores[i][want].tolist()


def test_cells_without_a_best_row_are_not_read():
    """Whole cells are pruned by centre and radius, and those that stay hold all of the best rows."""
    rows = np.floor(64 * np.array([v for _, v, _ in clustered(2000, 32, 20, seed=3)]))
    centres = cover_tree._net(rows[:500], 20)
    cell = ((rows[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    radii = np.array([np.linalg.norm(rows[cell == c] - centres[c], axis=1).max() for c in range(20)])
    cells = cover_tree.Cells(np.arange(20), centres, radii)
    open_share = []
    for c in range(20):
        _, queries = block_of(rows[cell == c][:10])
        scores = queries.points @ rows.T
        floor = np.sort(scores, axis=1)[:, -20]
        open_ = cells.open(queries, floor)
        assert set(np.unique(cell[(scores >= floor[:, None]).any(axis=0)])) <= set(open_.tolist())
        open_share.append(len(open_) / 20)
    assert np.mean(open_share) < 0.4
