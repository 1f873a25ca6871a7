"""The learned operators: gradients, held-out accuracy, odd inputs; and the pipeline."""

import collections
import math
import pathlib
import random
import subprocess
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationlens.llm import common, gru, lm, quality, toxicity
from stationlens.llm import word_blocks as wb

from .conftest import WORDS, prose
from .test_near_duplicates import brute


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_gru_gradients():
    rng = np.random.default_rng(0)
    x, u, h = rng.standard_normal((4, 3, 6)), rng.standard_normal((2, 6)), rng.standard_normal((3, 2))
    keep = (rng.random((4, 3)) < 0.7).astype(float)
    target = rng.standard_normal((4, 3, 2))

    def loss():
        return float((gru.forward(x, u, h, keep)[0] * target).sum())

    d_x, d_u = gru.backward(target, u, gru.forward(x, u, h, keep)[1])
    for array, grad in ((x, d_x), (u, d_u)):
        for at in list(np.ndindex(array.shape))[::3]:
            array[at] += 1e-6
            up = loss()
            array[at] -= 2e-6
            assert grad[at] == pytest.approx((up - loss()) / 2e-6, abs=1e-5)
            array[at] += 1e-6


def test_gru_step_is_forward():
    rng = np.random.default_rng(0)
    x, u, h = rng.standard_normal((5, 3, 6)), rng.standard_normal((2, 6)), np.zeros((3, 2))
    states, _ = gru.forward(x, u, h)
    for t in range(5):
        h = gru.step(x[t], h, u)
        assert np.allclose(h, states[t])


def test_lanes_last_is_the_same_layer():
    rng = np.random.default_rng(0)
    x, u, h = rng.standard_normal((4, 3, 6)), rng.standard_normal((2, 6)), rng.standard_normal((3, 2))
    keep = (rng.random((4, 3)) < 0.7).astype(float)
    target = rng.standard_normal((4, 3, 2))
    states, kept = gru.forward(x, u, h, keep)
    lanes, lanes_kept = gru.forward_lanes(x.transpose(0, 2, 1), u, h.T, keep)
    assert np.allclose(states, lanes.transpose(0, 2, 1))
    for one, other in zip(gru.backward(target, u, kept), gru.backward_lanes(target.transpose(0, 2, 1), u, lanes_kept), strict=True):
        assert np.allclose(one, other.transpose(0, 2, 1) if other.ndim == 3 else other)
    assert np.allclose(gru.step(x[0], h, u), gru.step_lanes(x[0].T, h.T, u.T).T)


def junk(seed):
    words = prose(seed, 60).split()
    kind = seed % 3
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(w + random.Random(seed).choice(["***", "$$$", "###"]) for w in words)
    return " | ".join(words)


def labelled(spark, n=600):
    """Texts of ids 0..n-1: every tenth junk, every sixth toxic; labels for two thirds."""
    texts, labels = [], []
    for i in range(n):
        text = junk(i) if i % 10 == 0 else prose(i, 30 + i % 90)
        if i % 6 == 1:
            words = text.split()
            for k in range(0, len(words), 15):
                words[k] = ("vileword", "badthing", "hateful")[(i + k) % 3]
            text = " ".join(words)
        texts.append(text)
        if i % 3:
            labels.append((i, int(i % 10 != 0), int(i % 6 == 1), "x"))
        elif i % 2:
            labels.append((i, None, None, "x"))
    labels += [(10**9, 1, 1, "x"), (None, 1, 0, "x")]
    return texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string")


def test_quality(spark, documents):
    texts, labels = labelled(spark)
    docs = documents([*texts, "", None, prose(1, 20_000), "dup"], [*range(len(texts)), 7_001, 7_002, 7_003, None])
    rows = quality.score(docs, labels).collect()
    assert len(rows) == len(texts) + 4
    for r in rows:
        assert r.held_out == (fold("" if r.doc_id is None else r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < len(texts)]
    clean = [r.predicted for r in held if r.doc_id % 10]
    assert np.mean(clean) >= 0.97
    assert np.mean([r.predicted for r in held if r.doc_id % 10 == 0]) <= 0.2
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)


def test_quality_without_labels_and_empty(spark, documents):
    _, labels = labelled(spark, 30)
    docs = documents(["a b", None])
    assert [r.predicted for r in quality.score(docs, labels.limit(0)).collect()] == [1, 1]
    assert quality.score(docs.limit(0), labels).count() == 0


def test_quality_prior_from_histograms():
    rng = np.random.default_rng(0)
    good, bad = rng.beta(8, 2, 40_000), rng.beta(2, 8, 10_000)
    bins = [np.histogram(x, bins=512, range=(0, 1))[0] for x in (good[:20_000], np.concatenate([good[20_000:], bad]))]
    assert quality.estimate_prior(*bins) == pytest.approx(2 / 3, abs=0.03)


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 84, 85, 500):
        starts = toxicity.window_starts(n)
        covered = {w for s in starts for w in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and len(set(starts)) == len(starts)


def test_toxicity(spark, documents):
    texts, labels = labelled(spark)
    long = prose(3, 5_000)
    docs = documents([*texts, "", None, long, f"{long} vileword badthing hateful vileword {long}"], [*range(len(texts)), 7_001, None, 7_003, 7_004])
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == len(texts) + 4
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < len(texts)]
    assert np.mean([r.predicted for r in held if r.doc_id % 6 == 1]) >= 0.85
    assert np.mean([r.predicted for r in held if r.doc_id % 6 != 1]) <= 0.05
    by_id = {r.doc_id: r for r in rows}
    assert by_id[7_004].score > by_id[7_003].score  # wherever in the text it is
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_attention_and_recurrence_gradients():
    rng = np.random.default_rng(5)
    net = toxicity.Net()
    w = {k: v.astype(np.float64) for k, v in net.w.items()}
    for k in ("word", "prefix"):
        w[k] += 0.1 * rng.standard_normal(w[k].shape)
    words = [b"some", b"words", b"of", b"a", b"longer", b"text"]
    cut = toxicity.slots(words)
    windows = rng.integers(0, len(words), (3, toxicity.WINDOW))
    windows[1, 5:] = -1  # filling gets no attention
    labels, seen = np.array([1.0, 0.0, 1.0]), np.array([1, 0, 1, 1, 1, 1.0])

    def loss():
        _, z = toxicity.gradients(w, cut, windows, labels, seen)
        return float((np.logaddexp(0, z) - labels * z).mean())

    grads, z = toxicity.gradients(w, cut, windows, labels, seen)
    for k, grad in grads.items():
        for at in np.argsort(-np.abs(grad).ravel())[:5].tolist():
            at = np.unravel_index(at, grad.shape)
            w[k][at] += 1e-5
            up = loss()
            w[k][at] -= 2e-5
            assert grad[at] == pytest.approx((up - loss()) / 2e-5, rel=1e-3, abs=1e-8), k
            w[k][at] += 1e-5
    net.w = {k: v.astype(np.float32) for k, v in w.items()}
    scored = toxicity.score_windows(net, toxicity.embed(net.w, cut), windows)
    plain = toxicity.gradients(w, cut, windows, labels, np.ones(len(words)))[1]
    assert np.allclose(scored, plain, atol=1e-4)


@pytest.mark.parametrize("long", [50, 300, 2000])
def test_long_texts_are_scored_in_pieces(monkeypatch, long):
    """With the windows that the whole text has."""
    net = toxicity.Net()
    rng = np.random.default_rng(6)
    net.w["word"] += rng.standard_normal(net.w["word"].shape).astype(np.float32)
    net.slope, net.shift = 1.0, 0.0
    texts = [prose(i, n) for i, n in enumerate((1, 20, 47, 48, 49, 84, 85, 400, 1000))]
    texts += ["x" * 3000, " " * 3000, "a b " + "y" * 2500 + " c", "ΑΣ " * 300, ""]
    whole = toxicity.score_texts(net, texts)
    monkeypatch.setattr(toxicity, "LONG", long)
    assert np.allclose(toxicity.score_texts(net, texts), whole, atol=1e-6)
    assert all("".join(toxicity.pieces_of(t)) == t for t in texts)


def test_toxicity_without_labels(spark, documents):
    _, labels = labelled(spark, 30)
    assert [r.predicted for r in toxicity.score(documents(["a", None]), labels.limit(0)).collect()] == [0, 0]


def test_fits_sample_only_the_documents_at_hand(spark, documents, monkeypatch):
    """Labels of far more documents than there are take no places in the bounded samples."""
    texts, labels = labelled(spark, 300)
    others = spark.range(10_000, 30_000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic", "'x' as score")
    docs, labels = documents(texts), labels.unionByName(others)
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda *found: taken.append(found))
    toxicity.fit(docs, labels, n_toxic=20, n_clean=40)
    ((found, toxic),) = taken
    assert ((toxic == 1).sum(), (toxic == 0).sum()) == (20, 40) and set(found) <= set(texts)
    seen = common.fold(F.col("doc_id"), 3) != 1
    rows = quality._training_rows(common.id_and_text(docs), labels, seen, 50, 60).collect()
    assert [sum(r.role == y for r in rows) for y in (1, 0)] == [50, 60] and all(r.doc_id < 300 for r in rows)


def test_a_hot_id_takes_one_place(spark, documents, monkeypatch):
    """Rows that repeat an id, and repeated labels, bring one text to the driver."""
    texts, labels = labelled(spark, 90)
    hot = next(i for i in range(90) if i % 3 and i % 6 != 1 and fold(i, 3) != 1)
    docs = documents(texts + [f"again {i}" for i in range(2000)], [*range(90), *[hot] * 2000])
    labels = labels.unionByName(spark.range(500).selectExpr(f"{hot}L as doc_id", "1 as quality", "0 as toxic", "'x' as score"))
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda *found: taken.append(found))
    toxicity.fit(docs, labels)
    ((found, toxic),) = taken
    assert len(found) == len(set(found)) <= 90 and min([texts[hot], "again 0"]) in found
    model = quality.fit(docs, labels)
    assert np.isfinite(model.weights["w"]).all()


def test_sampled_rows(spark):
    rows = spark.range(20_000).selectExpr("id % 5000 as x").repartition(7)
    found = common.sampled(rows, F.xxhash64("x"), 300)
    got = [r.x for r in found.collect()]
    assert len(got) == len(set(got)) == 300
    assert got == [r.x for r in common.sampled(rows.repartition(3).distinct(), F.xxhash64("x"), 300).collect()]
    assert common.sampled(rows, F.xxhash64("x"), 10_000).count() == 5000


def test_nnpu_gradient_and_bound():
    rng = np.random.default_rng(2)
    positive, unlabelled = rng.standard_normal((30, 5)) + 1, rng.standard_normal((50, 5))
    for prior, scale in ((0.4, 0.3), (0.9, 3.0)):
        weights = {"w": scale * rng.standard_normal(5) + scale, "b": np.array([0.2])}
        if prior > 0.5:  # positives are told so well that the estimate goes below its bound
            weights = {"w": np.full(5, 4.0), "b": np.array([6.0])}
        below = quality.negative_risk(weights, positive, unlabelled, prior) < 0
        assert below == (prior > 0.5)

        def risk():
            zp = positive @ weights["w"] + weights["b"][0]
            estimate = quality.negative_risk(weights, positive, unlabelled, prior)
            ridge = quality.RIDGE / 2 * (weights["w"] ** 2).sum()
            return (-estimate if below else prior * np.logaddexp(0, -zp).mean() + estimate) + ridge

        grads = quality._nnpu_gradient(weights, positive, unlabelled, prior)
        for k in weights:
            for i in range(len(weights[k])):
                weights[k][i] += 1e-6
                up = risk()
                weights[k][i] -= 2e-6
                assert grads[k][i] == pytest.approx((up - risk()) / 2e-6, rel=1e-4, abs=1e-7)
                weights[k][i] += 1e-6


def test_every_unlabelled_text_teaches(spark, documents):
    """One text more, among many, moves the weights: no sample stands for the texts."""
    texts, labels = labelled(spark, 120)
    more = [prose(10_000 + i, 40) for i in range(300)]
    changed = next(i for i in range(250, 300) if fold(len(texts) + i, 3) != 1)
    one = quality.fit(documents(texts + more).repartition(2, "doc_id"), labels, n_start=50)
    more[changed] = "### !!! ***"
    other = quality.fit(documents(texts + more).repartition(2, "doc_id"), labels, n_start=50)
    assert not np.array_equal(one.weights["w"], other.weights["w"])


def test_language_model(spark, documents):
    rng = random.Random(1)
    texts = []
    for i in range(300):  # every word tells the next ones: odd texts have one half of the words
        own = WORDS[:15] if i % 2 else WORDS[15:]
        texts.append(" ".join(rng.choice(own) + rng.choice(["", "", ".", "x%d" % rng.randrange(300)]) for _ in range(120)))
    texts += ["", None, "never seen words qqq", texts[0].upper(), " ".join(texts[:40])]
    ids = [*range(len(texts) - 1), None]
    rows = lm.score(documents(texts, ids)).collect()
    counts = collections.Counter()
    for i, t in zip(ids, texts, strict=True):
        if fold("" if i is None else i, 10):
            counts.update((t or "").lower().split())
            counts[None] += 1
    n, norm = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    base = model = 0
    for i, t in zip(ids, texts, strict=True):
        r, tokens = by_id[i], [*(t or "").lower().split(), None]
        assert (r.n_tokens, r.train_tokens) == (len(tokens), n)
        assert r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.held_out == (fold("" if i is None else i, 10) == 0)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / norm) for w in tokens))
        assert r.score < 0
        if r.held_out:
            base, model = base + r.base_score, model + r.score
    assert model > base * 0.95
    assert lm.score(documents(texts).limit(0)).count() == 0


def test_language_model_learns_from_every_training_document(spark, documents):
    """Also of a corpus that counts far more tokens than this one."""
    texts = [*(prose(i, 20) for i in range(200)), "", None]
    docs = common.id_and_text(documents(texts)).withColumn("flag", (common.fold(F.col("doc_id"), 10) == 0).cast("int"))
    blocks = wb.cut_blocks(docs, lm.split, lambda held_out: not held_out)
    totals, _ = common.stored(lm.bucket_totals(blocks), "test-totals")
    answers, _ = common.stored(lm.total_counts(blocks, totals), "test-counts")
    want = {i for i in range(len(texts)) if fold(i, 10)}
    for n in (1, 10**7, 10**9):
        counts = lm.corpus_counts(totals, len(want))
        counts.n = n
        met = wb.to_blocks(blocks, answers)
        rows = lm._training_sequences(met, spark.sparkContext.broadcast(counts)).collect()
        assert {r.doc_id for r in rows} == want and len(rows) == len(want)
        assert {r.turn for r in rows} == set(range(len(lm.TURNS)))
        assert all(len(r.ids) == 2 * (len((texts[r.doc_id] or "").split()) + 1) for r in rows)


def some_counts():
    head = [(b"w%d" % i, 1000 - i) for i in range(lm.HEAD - 1)] + [(lm.END, 5)]
    return lm.Counts(head, np.full(lm.TAIL_CLASSES, 50.0), np.full(lm.TAIL_CLASSES, 9.0))


def test_many_trainers_see_every_document_once(spark, documents, monkeypatch):
    """Also rows that share an id: they are dealt out, and the weights averaged as a tree."""
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(lm, "TRAINER_TOKENS", 100)
    monkeypatch.setattr(lm, "FAN", 3)
    monkeypatch.setattr(lm, "TURNS", (0.01, 0.01))

    def train(w, streams, end, rate):
        used = 0
        for ids in streams:
            seen.add(1)
            used += len(ids)
            w["cls_bias"] += len(ids)
        return used

    monkeypatch.setattr(lm, "train_stream", train)
    rows = [(i, i % 2, i * 7, np.full(5, 3, np.uint16).tobytes()) for i in range(300)]
    rows += [(None, i % 2, i * 11 + 1, np.full(5, 3, np.uint16).tobytes()) for i in range(200)]
    sequences = spark.createDataFrame(rows, "doc_id long, turn int, deal int, ids binary")
    counts, trainers = some_counts(), 25
    weights = lm.fit(sequences, counts, 100 * trainers)
    assert seen.value == 500
    # Each turn adds the mean of the trainers' tokens, weighted by them.
    want = lm.start_weights(counts)["cls_bias"].astype(float)
    for turn in (0, 1):
        tokens = collections.Counter()
        for _, t, deal, _ in rows:
            tokens[deal % trainers] += 5 * (t == turn)
        want += sum(n * n for n in tokens.values()) / sum(tokens.values())
    assert np.allclose(weights["cls_bias"], want, rtol=1e-5)


def test_repeated_ids_are_dealt_out(spark, documents):
    docs = common.id_and_text(documents(["a b c d"] * 400, [None] * 200 + [1] * 200)).withColumn("flag", F.lit(0))
    blocks = wb.cut_blocks(docs, lm.split, lambda held_out: not held_out)
    totals, _ = common.stored(lm.bucket_totals(blocks), "test-totals")
    met = wb.to_blocks(blocks, lm.total_counts(blocks, totals))
    counts = lm.corpus_counts(totals, 400)
    rows = lm._training_sequences(met, spark.sparkContext.broadcast(counts)).collect()
    places = collections.Counter((r.turn, r.deal % 5) for r in rows)
    assert len(rows) == 400 and len(places) == 20 and max(places.values()) < 60


def test_factored_softmax_gradients():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in lm.start_weights(some_counts()).items()}
    for k in w:
        w[k] = w[k] + 0.1 * rng.standard_normal(w[k].shape)
    h = 0.3 * rng.standard_normal((lm.HIDDEN, 3))
    targets = rng.integers(0, lm.HEAD + lm.TAIL_CLASSES, (5, 3))
    targets[0], inputs = (1, 2, lm.HEAD + 3), rng.integers(0, 40, (5, 3))
    keep = (rng.random((5, 3)) < 0.7).astype(float)

    def loss():
        x = (w["in"] + w["in_bias"])[inputs].transpose(0, 2, 1)
        states, _ = gru.forward_lanes(np.ascontiguousarray(x), w["u"], h, keep)
        return -lm.log_probs(w, states.transpose(1, 0, 2).reshape(lm.HIDDEN, -1), targets.ravel()).mean()

    grads, _ = lm.gradients(w, h, inputs, targets, keep)
    for k, grad in grads.items():
        flat = np.abs(grad).ravel()
        for at in np.argsort(-flat)[:6].tolist() + [int(np.flatnonzero(flat)[0])]:
            at = np.unravel_index(at, grad.shape)
            w[k][at] += 1e-5
            up = loss()
            w[k][at] -= 2e-5
            assert grad[at] == pytest.approx((up - loss()) / 2e-5, rel=1e-3, abs=1e-8), k
            w[k][at] += 1e-5


def test_training_takes_every_token(monkeypatch):
    head = [(b"w%d" % i, 1000 - i) for i in range(lm.HEAD - 1)] + [(lm.END, 5)]
    counts = lm.Counts(head, np.full(lm.TAIL_CLASSES, 50.0), np.full(lm.TAIL_CLASSES, 9.0))
    end, seen = counts.words[lm.END], collections.Counter()

    def note(w, adam, h, inputs, targets, keep):
        seen.update(targets.ravel().tolist())
        return h

    monkeypatch.setattr(lm, "train_window", note)
    for sizes in ([5], [40], [30_000, 40_001, 3, 1], [70_000, 70_000, 17]):
        seen.clear()
        docs = [np.append(np.arange(n - 1) % 900, end) for n in sizes]
        assert lm.train_stream(lm.start_weights(counts), iter(docs), end, 0.02) == sum(sizes)
        assert seen == collections.Counter(np.concatenate(docs).tolist())


def test_language_model_is_a_distribution():
    """Class and head-word probabilities sum to one, wherever the state is."""
    rng = np.random.default_rng(0)
    head = [(b"w%d" % i, 1000 - i) for i in range(lm.HEAD - 1)] + [(lm.END, 5)]
    counts = lm.Counts(head, np.full(lm.TAIL_CLASSES, 50.0), np.full(lm.TAIL_CLASSES, 9.0))
    w = lm.start_weights(counts)
    for k in ("cls", "word"):
        w[k] = rng.standard_normal(w[k].shape).astype(np.float32)
    ids = np.arange(lm.HEAD + lm.TAIL_CLASSES)
    h = np.repeat(rng.standard_normal((lm.HIDDEN, 1)).astype(np.float32), len(ids), axis=1)
    assert np.exp(lm.log_probs(w, h, ids)).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_over_windows():
    """Documents scored together give what each gives when run step by step."""
    rng = np.random.default_rng(0)
    head = [(b"w%d" % i, 1000 - i) for i in range(lm.HEAD - 1)] + [(lm.END, 5)]
    counts = lm.Counts(head, np.full(lm.TAIL_CLASSES, 50.0), np.full(lm.TAIL_CLASSES, 9.0))
    w = lm.start_weights(counts)
    w["cls"] = rng.standard_normal(w["cls"].shape).astype(np.float32)
    end, sizes = counts.words[lm.END], np.array([100, 3, 33, 1, 70])
    ids = rng.integers(0, lm.HEAD, sizes.sum())
    got = lm.score_documents(w, ids, sizes, end)
    at = 0
    for size, value in zip(sizes, got, strict=True):
        h, last, total = np.zeros((1, lm.HIDDEN), np.float32), end, 0.0
        for token in ids[at : at + size]:
            h = gru.step((w["in"] + w["in_bias"])[[last]], h, w["u"])
            total += float(lm.log_probs(w, h.T, np.array([token]))[0])
            last = token
        assert value == pytest.approx(total, rel=1e-4)
        at += size


def test_pipeline(spark, documents, tmp_path, path_of):
    """Each stage against a plain version of it on what its predecessor kept."""
    import corpus_pipeline
    from stationlens.llm import common, packing

    texts, labels = labelled(spark, 360)
    texts += [texts[2], texts[3], None, ""]
    docs = documents(texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = common.table(spark, str(tmp_path), "documents"), set(range(len(texts)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        found = {r.doc_id for r in after.collect()}
        assert found < kept or name.startswith("minhash"), name
        if name.startswith("minhash"):
            own = sorted(kept)
            sets, groups = brute([texts[i] for i in own])
            assert found == {own[k] for k in range(len(own)) if not sets[k] or groups.root(k) == k}
        docs, _ = common.stored(after, "stage")
        kept = found
    assert sum(i < 360 and i % 10 == 0 for i in kept) <= 4  # of 36
    good = [i for i in range(360) if i % 10 and i % 6 != 1]
    assert len(kept & set(good)) >= 0.9 * len(good)
    assert not {360, 361} & kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == kept
    whole = {}
    for r in sorted(pieces, key=lambda r: r.start):
        whole[r.doc_id] = whole.get(r.doc_id, b"") + bytes(r.ids)
    want = packing.word_ids(path_of("word_bpe_49k.json"))
    assert whole == {i: want.of_text(texts[i] or "") + packing.END_ID for i in kept}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()} == kept


def test_pipeline_with_repeated_and_null_ids_and_clashing_names(spark, tmp_path, path_of):
    """No text is lost because another one has its id, or none; only copies go."""
    import corpus_pipeline
    from stationlens.llm import packing

    texts, labels = labelled(spark, 360)
    own = list(enumerate(texts))
    more = [(None, prose(9_000 + i, 60)) for i in range(6)] + [(2, prose(9_100 + i, 60)) for i in range(6)]
    copies = [(None, more[0][1]), (2, more[7][1]), (2, more[7][1]), (9_999, texts[3]), (None, texts[4])]
    names = ["row_id", "row_text", "node", "score", "kept", "out_id", "part", "length", "ids", "role", "bucket"]
    rows = [(i, t, *names) for i, t in own + more + copies]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = common.table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        docs, _ = common.stored(after, "stage")
    kept = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    assert max(kept.values()) == 1 and set(kept) <= set(own + more)
    good = {(i, t) for i, t in own if i % 10 and i % 6 != 1}
    assert len(set(more) & set(kept)) >= 11 and len(good & set(kept)) >= 0.9 * len(good)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    want = packing.word_ids(path_of("word_bpe_49k.json"))
    assert sum(r.length for r in pieces) == sum(len(want.of_text(t) + packing.END_ID) // 4 for _, t in kept)


def test_pipeline_on_an_empty_table(spark, documents, tmp_path):
    import corpus_pipeline

    _, labels = labelled(spark, 30)
    documents(["a"]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_quality_scores_some_texts_at_a_time(spark):
    model = quality.Model(np.zeros(quality.INPUTS), np.ones(quality.INPUTS))
    model.weights = {"w": np.linspace(-1, 1, quality.INPUTS), "b": np.zeros(1)}
    texts = pd.Series([f"word {i} of {i * i}," * (i % 5) for i in range(3 * quality.STEP_TEXTS + 7)])
    want = model.scores(np.stack([quality.inputs(t) for t in texts]).astype(np.float64))
    sizes, whole = [], model.scores
    model.scores = lambda x: sizes.append(len(x)) or whole(x)
    got = quality.scorer(model).func(texts)
    assert np.allclose(got, want, rtol=0, atol=1e-12) and sum(sizes) == len(texts)
    assert max(sizes) <= quality.STEP_TEXTS
    assert not len(quality.scorer(model).func(texts[:0]))


def test_scoring_workers_hold_no_pandas():
    """Workers that run the pipeline's stages don't load pandas (24 MB in each of them)."""
    stages = "quality, toxicity, minhash, packing"
    code = f"import sys; from stationlens.llm import {stages}; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=pathlib.Path(quality.__file__).parents[2]).returncode == 0


def test_toxicity_scores_some_texts_at_a_time(monkeypatch):
    texts = ["" if i % 7 == 0 else f"word{i} of {i * i}, " * (i % 90) for i in range(toxicity.SCORED_TEXTS + 200)]
    net = toxicity.Net()
    net.slope, net.shift = 1.0, 0.0
    sizes, freed, whole = [], [], toxicity.score_texts
    want = whole(net, texts)
    monkeypatch.setattr(toxicity, "score_texts", lambda net, some: sizes.append(len(some)) or whole(net, some))
    monkeypatch.setattr(common, "give_back", lambda: freed.append(len(sizes)))
    shared = type("Broadcast", (), {"value": net})
    context = type("Context", (), {"broadcast": lambda self, x: shared})()
    score = toxicity.scorer(type("Session", (), {"sparkContext": context}), net).func
    got = list(score(iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert np.allclose(got[0], want, rtol=0, atol=1e-6) and [len(x) for x in got] == [len(texts), 0]
    assert sizes == [toxicity.SCORED_TEXTS, 200] and freed == [2]
