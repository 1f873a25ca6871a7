"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of a vector for its hash, the mean vector of its character
trigrams, and vectors for its first characters.  Every text is cut into overlapping windows of words that cover all of it; the
network scores each window and the text has the score of its worst one.  Training is on
whole texts of labelled rows: first every window of a toxic text counts as toxic, then only
those that the network itself scores highest.  A last logistic step maps the worst
window's score to a probability.

Only the fit sees a bounded number of labelled rows (``n_toxic`` and ``n_clean`` documents, the first by
a hash of their id).  A text of more than ``LONG`` characters is read piece by piece.

Defined cases: null and empty texts have one empty window; windows of texts shorter than a window are
filled up and the filling gets no attention; rows with null or repeated ids are scored one by one;
labels that are null or of unknown ids are not used; without labels of both classes every score
is 0; an empty table gives an empty table.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, gru
from .word_blocks import Numbered

FIT_TOXIC = 800
FIT_CLEAN = 3_000
WINDOW, STRIDE = 48, 36
#: Characters of texts that are scored together, and of a piece of a longer text.
LONG = 1 << 20
#: Texts of a batch that are Python strings at a time.
SCORED_TEXTS = 512
WORD_SLOTS, TRIGRAM_SLOTS, PREFIX_SLOTS, WIDTH, HIDDEN = 1 << 15, 1 << 13, 1 << 14, 12, 8
#: Lengths of the beginnings of words, in bytes, that are inputs besides trigrams.
PREFIXES = (4, 6)
#: Texts of a class that are left out of the steps at least, if any are.
LEFT_OUT = 30
SPACE = re.compile(r"[\x20\x09-\x0D]")
SIGNS = b".,;:!?\"'()[]{}<>|*#%&$_-+=/~`"


class Net:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {
            "word": np.zeros((WORD_SLOTS, WIDTH), np.float32),
            "prefix": np.zeros((PREFIX_SLOTS, WIDTH), np.float32),
            "char": 0.1 * rng.standard_normal((TRIGRAM_SLOTS, WIDTH)).astype(np.float32),
            "in_f": small(WIDTH, 3 * HIDDEN), "in_b": small(WIDTH, 3 * HIDDEN),
            "bias_f": np.zeros(3 * HIDDEN, np.float32), "bias_b": np.zeros(3 * HIDDEN, np.float32),
            "u_f": small(HIDDEN, 3 * HIDDEN), "u_b": small(HIDDEN, 3 * HIDDEN),
            "look": 0.1 * small(2 * HIDDEN), "out": small(2 * HIDDEN), "out_bias": np.zeros(1, np.float32),
        }
        self.slope, self.shift = 0.0, -50.0

    def doc_score(self, worst: np.ndarray) -> np.ndarray:
        return gru.sigmoid(self.slope * worst.astype(np.float64) + self.shift)


def slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash slots of words, of all their trigrams, where each word's trigrams begin, and the
    slots of the words' beginnings."""
    prefix = np.array([[zlib.crc32(w[:n], n) % PREFIX_SLOTS for n in PREFIXES] for w in words], np.int64).reshape(-1, len(PREFIXES))
    word_slot = np.fromiter((zlib.crc32(w) % WORD_SLOTS for w in words), np.int64, len(words))
    octets = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    codes = (octets[:-2] * 961 + octets[1:-1] * 31 + octets[2:]) * 40503 % 1_000_003 % TRIGRAM_SLOTS
    inside = np.ones(len(octets), bool)
    inside[starts + lengths - 1] = inside[starts + lengths - 2] = False
    trigrams = codes[inside[:-2]]
    counts = lengths - 2
    return word_slot, trigrams, np.cumsum(counts) - counts, prefix


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without the signs around them; whole text."""
    return [w.strip(SIGNS) or w for w in (text or "").lower().encode().split()]


def window_starts(n: int) -> list[int]:
    """Starts that cover n words: every STRIDE, the last ending with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def windows_of(texts: list, numbered: Numbered) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (windows, WINDOW), -1 as filling, and the text of each window."""
    out, owner = [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        numbers = np.fromiter(map(numbered.__getitem__, words), np.int64, len(words))
        if len(words) < WINDOW:
            numbers = np.concatenate([numbers, np.full(WINDOW - len(words), -1)])
        starts = np.array(window_starts(len(words)))
        out.append(numbers[starts[:, None] + np.arange(WINDOW)])
        owner += [i] * len(starts)
    return np.concatenate(out), np.array(owner)


def embed(w: dict, cut: tuple, seen: np.ndarray | None = None) -> np.ndarray:
    """Word vectors; where ``seen`` is 0, of the characters alone."""
    word_slot, trigrams, starts, prefix = cut
    if not len(word_slot):
        return np.zeros((0, WIDTH), np.float32)
    counts = np.diff(np.append(starts, len(trigrams)))[:, None]
    whole = w["word"][word_slot] if seen is None else w["word"][word_slot] * seen[:, None]
    return whole + np.add.reduceat(w["char"][trigrams], starts, axis=0) / counts + w["prefix"][prefix].sum(axis=1)


def score_windows(net: Net, vectors: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Logits of windows over word vectors; nothing is kept for training."""
    w = net.w
    none = np.zeros((1, WIDTH), np.float32)  # number -1 is the last row
    vectors = np.concatenate([vectors, none])
    projected = {d: vectors @ w[f"in_{d}"] + w[f"bias_{d}"] for d in "fb"}
    out = np.empty(len(windows), np.float32)
    for a in range(0, len(windows), 4096):
        cut = np.ascontiguousarray(windows[a : a + 4096].T)
        states = np.empty((WINDOW, cut.shape[1], 2 * HIDDEN), np.float32)
        for d, order, at in (("f", range(WINDOW), slice(0, HIDDEN)), ("b", range(WINDOW - 1, -1, -1), slice(HIDDEN, 2 * HIDDEN))):
            h = np.zeros((cut.shape[1], HIDDEN), np.float32)
            for t in order:
                h = gru.step(projected[d].take(cut[t], axis=0), h, w[f"u_{d}"])
                states[t, :, at] = h
        attend = np.where(cut < 0, -1e9, states @ w["look"])
        weight = np.exp(attend - attend.max(axis=0))
        value = states @ w["out"]
        out[a : a + 4096] = (weight * value).sum(axis=0) / weight.sum(axis=0) + w["out_bias"]
    return out


def gradients(w: dict, cut: tuple, windows: np.ndarray, labels: np.ndarray, seen: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the mean logistic loss of windows, and their logits."""
    vectors = np.concatenate([embed(w, cut, seen), np.zeros((1, WIDTH), w["word"].dtype)])
    index = windows.T
    x = vectors[index]
    h0 = np.zeros((len(windows), HIDDEN), x.dtype)
    states, kept = {}, {}
    for d, flip in (("f", 1), ("b", -1)):
        s, kept[d] = gru.forward((x @ w[f"in_{d}"] + w[f"bias_{d}"])[::flip], w[f"u_{d}"], h0)
        states[d] = s[::flip]
    both = np.concatenate([states["f"], states["b"]], axis=2)
    logit_a = np.where(index < 0, -1e9, both @ w["look"])
    weight = np.exp(logit_a - logit_a.max(axis=0))
    weight /= weight.sum(axis=0)
    value = both @ w["out"]
    z = (weight * value).sum(axis=0) + w["out_bias"]
    dz = ((gru.sigmoid(z) - labels) / len(labels)).astype(x.dtype)
    d_value = weight * dz
    d_attend = weight * (value - (weight * value).sum(axis=0)) * dz * (index >= 0)
    grads = {
        "out": np.einsum("tbh,tb->h", both, d_value), "out_bias": dz.sum(keepdims=True),
        "look": np.einsum("tbh,tb->h", both, d_attend),
    }
    d_both = d_value[..., None] * w["out"] + d_attend[..., None] * w["look"]
    d_x = np.zeros_like(x)
    for d, flip, at in (("f", 1, slice(0, HIDDEN)), ("b", -1, slice(HIDDEN, 2 * HIDDEN))):
        dp, grads[f"u_{d}"] = gru.backward(d_both[::flip, :, at], w[f"u_{d}"], kept[d])
        dp = dp[::flip]
        grads[f"in_{d}"] = np.einsum("tbi,tbj->ij", x, dp)
        grads[f"bias_{d}"] = dp.sum(axis=(0, 1))
        d_x += dp @ w[f"in_{d}"].T
    flat = index.ravel()
    real = flat >= 0
    d_words = np.stack([np.bincount(flat[real], d_x.reshape(-1, WIDTH)[real, j], len(cut[0])) for j in range(WIDTH)], axis=1)
    word_slot, trigrams, starts, prefix = cut
    counts = np.diff(np.append(starts, len(trigrams)))
    d_tri = np.repeat(d_words / counts[:, None], counts, axis=0)
    for name, at, g, n in (("word", word_slot, d_words * seen[:, None], WORD_SLOTS), ("char", trigrams, d_tri, TRIGRAM_SLOTS), ("prefix", prefix.ravel(), np.repeat(d_words, len(PREFIXES), axis=0), PREFIX_SLOTS)):
        grads[name] = np.stack([np.bincount(at, g[:, j], n) for j in range(WIDTH)], axis=1).astype(x.dtype)
    return grads, z


def _train_step(net: Net, adam: gru.Adam, cut: tuple, windows: np.ndarray, labels: np.ndarray, seen: np.ndarray) -> None:
    adam.step(gradients(net.w, cut, windows, labels, seen)[0], clip=1e9)


def train(texts: list, toxic: np.ndarray, seed: int = 7, batch: int = 384, rounds: tuple = (100, 80, 100, 100)) -> Net:
    """Fit on whole texts; ``rounds`` are the steps on all windows, then on the worst ones.

    Every batch has as many windows of toxic texts as of clean ones.  One text in four is
    left out, if there are enough, of these steps; the last step fits probabilities on those.
    """
    net = Net(seed)
    if len(set(toxic.tolist())) < 2:
        return net
    rng = np.random.default_rng(seed)
    numbered = Numbered()
    windows, owner = windows_of(texts, numbered)
    cut = slots(list(numbered))
    all_words = list(numbered)
    label = toxic[owner].astype(np.float32)
    fitted = np.ones(len(texts), bool)
    if min((toxic == 0).sum(), (toxic == 1).sum()) >= 4 * LEFT_OUT:
        for y in (0, 1):
            fitted[np.flatnonzero(toxic == y)[::4]] = False
    sampled = fitted[owner]
    adam = gru.Adam(net.w, 0.01, frozenset({"word", "char", "prefix"}))
    likely = {y: np.flatnonzero(sampled & (label == y)) for y in (0, 1)}
    hard = likely[0]
    worst = np.empty(len(texts))
    for steps in rounds:
        for _ in range(steps):
            chunk = np.concatenate([
                rng.choice(likely[1], batch // 2), rng.choice(likely[0], batch // 4), rng.choice(hard, batch // 4)
            ])
            used, local = np.unique(windows[chunk], return_inverse=True)
            gap = int(used[0] < 0)  # number -1 stays -1
            words = slots([all_words[i] for i in used[gap:]])
            if len(words[0]):
                seen = (rng.random(len(words[0])) >= 0.3).astype(np.float32)
                _train_step(net, adam, words, local.reshape(-1, WINDOW) - gap, label[chunk], seen)
        z = score_windows(net, embed(net.w, cut), windows)
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, owner, z)
        top = z >= worst[owner] - 1e-6
        likely[1] = np.flatnonzero(sampled & (label == 1) & (top | (z > 1)))
        hard = np.flatnonzero(sampled & (label == 0) & top)
    left = ~fitted if not fitted.all() else fitted
    _calibrate(net, worst[left], toxic[left])
    return net


def _calibrate(net: Net, worst: np.ndarray, toxic: np.ndarray) -> None:
    z = (worst - worst.mean()) / max(worst.std(), 1e-6)
    weights = {"a": np.ones(1), "b": np.zeros(1)}
    adam = gru.Adam(weights, 0.05)
    for _ in range(400):
        slope = (gru.sigmoid(weights["a"] * z + weights["b"]) - toxic) / len(z)
        adam.step({"a": np.array([(slope * z).sum()]) + 1e-3 * weights["a"], "b": np.array([slope.sum()])})
    net.slope = float(weights["a"][0] / max(worst.std(), 1e-6))
    net.shift = float(weights["b"][0] - net.slope * worst.mean())


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1,
    n_toxic: int = FIT_TOXIC, n_clean: int = FIT_CLEAN,
) -> Net:
    """Learn from labelled rows whose fold is not ``held_out``: at most ``n_toxic`` and ``n_clean``."""
    texts = common.id_and_text(docs, id_col, text_col)
    seen = (common.fold(F.col("doc_id").cast("long"), folds) != held_out) & F.col("doc_id").isNotNull()
    known = (
        labels.where(seen & F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .join(texts.select("doc_id"), "doc_id", "left_semi")  # places only for documents at hand
    )
    by_hash = F.xxhash64("doc_id", F.lit(11))
    rows = common.sampled(known.where("toxic = 1"), by_hash, n_toxic).unionByName(
        common.sampled(known.where("toxic = 0"), by_hash, n_clean)
    )
    # At most n_toxic + n_clean ids are broadcast and as many texts collected: of rows that share an
    # id the least.
    found = texts.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    found = sorted((r.doc_id, r.toxic, r.text) for r in found)
    return train([t for _, _, t in found], np.array([y for _, y, _ in found], int))


def pieces_of(text: str) -> Iterator[str]:
    """``text`` in pieces of some ``LONG`` characters that end before white space."""
    at = 0
    while at < len(text):
        found = SPACE.search(text, at + LONG)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def worst_of_long(net: Net, text: str) -> float:
    """The logit of a long text's worst window, with some pieces of it in memory."""
    worst, words, start, count = -np.inf, [], 0, 0  # words[0] is the text's word number ``count``
    for piece in pieces_of(text):
        words += words_of(piece)
        n = count + len(words)
        starts = list(range(start, n - WINDOW + 1, STRIDE))
        if starts:
            worst = max(worst, _worst_window(net, words, [s - count for s in starts]))
            start = starts[-1] + STRIDE
            drop = max(0, min(start, n - WINDOW) - count)
            words, count = words[drop:], count + drop
    n = count + len(words)
    if n < WINDOW:  # a long text of few words
        return float(_worst_of([text], net)[0])
    return max(worst, _worst_window(net, words, [n - WINDOW - count]))


def _worst_window(net: Net, words: list[bytes], starts: list[int]) -> float:
    numbered = Numbered()
    numbers = np.fromiter(map(numbered.__getitem__, words), np.int64, len(words))
    vectors = embed(net.w, slots(list(numbered)))
    return float(score_windows(net, vectors, numbers[np.array(starts)[:, None] + np.arange(WINDOW)]).max())


def _worst_of(texts: list, net: Net) -> np.ndarray:
    numbered = Numbered()
    windows, owner = windows_of(texts, numbered)
    z = score_windows(net, embed(net.w, slots(list(numbered))), windows)
    worst = np.full(len(texts), -np.inf)
    np.maximum.at(worst, owner, z)
    return worst


def score_texts(net: Net, texts: list) -> np.ndarray:
    """Scores of whole texts, a bounded number of characters at a time."""
    out = []
    start = 0
    while start < len(texts):
        if len(texts[start] or "") > LONG:
            out.append(net.doc_score(np.array([worst_of_long(net, texts[start])])))
            start += 1
            continue
        end, size = start, 0
        while end < len(texts) and len(texts[end] or "") <= LONG and (end == start or size < LONG):
            size += len(texts[end] or "")
            end += 1
        out.append(net.doc_score(_worst_of(texts[start:end], net)))
        start = end
    return np.concatenate(out) if out else np.empty(0)


def scorer(spark, net: Net):
    """A column function from text to score; the weights (1.6 MB, fixed) are broadcast."""
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    @common.giving_back
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.empty(len(texts))
            for at in range(0, len(texts), SCORED_TEXTS):
                some = texts.slice(at, SCORED_TEXTS).to_pylist()
                out[at : at + len(some)] = score_texts(shared.value, some)
            yield pa.array(out)

    return score


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
    n_toxic: int = FIT_TOXIC, n_clean: int = FIT_CLEAN,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    net = fit(docs, labels, id_col, text_col, n_toxic=n_toxic, n_clean=n_clean)
    return (
        common.id_and_text(docs, id_col, text_col)
        .select("doc_id", (common.fold(F.col("doc_id"), 3) == 1).alias("held_out"), scorer(docs.sparkSession, net)("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns, below the threshold."""
    net = fit(docs, labels)
    return docs.where(scorer(docs.sparkSession, net)(F.coalesce(F.col("text"), F.lit(""))) < threshold)
