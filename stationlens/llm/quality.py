"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of class 1; unlabelled are web texts whose labels are not
looked at.  The class prior is estimated from the scores of *all* texts of the training
folds: where a first classifier (positive against unlabelled) finds mostly positives, the
ratio of the unlabelled share to the positive share is the prior.  Then a logistic model
minimises the non-negative unbiased risk with that prior.

The fit starts from ``n_positive`` positives and ``n_start`` unlabelled texts, the first by a hash of
their id; then every text of the training folds is an unlabelled one once (``_taught_by_all``).  Labelled
rows are the only ones of which a bounded sample stands for all.

A text's inputs are shares of its bytes, of neighbouring byte kinds and of repeated words, over
the whole text.

Defined cases: null and empty texts have all-zero inputs and a score; rows with null or repeated
ids are scored one by one; labels that are null or of unknown ids are not used; with
fewer than two positives every score is the prior's start of 0.5 (predicted 1); an empty table gives an
empty table.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .gru import Adam, sigmoid

FIT_POSITIVE = 3_000
FIT_START = 5_000
#: Texts in a step of the pass over all texts (and that are scored together), and its learning rate.
STEP_TEXTS, STEP_RATE = 256, 0.002
RIDGE = 2e-3
BINS = 512

#: Kinds of bytes: lower, upper, digit, white space, sentence sign, other sign, non-ASCII lead, other.
KIND = np.full(256, 7, np.uint8)
KIND[ord("a") : ord("z") + 1] = 0
KIND[ord("A") : ord("Z") + 1] = 1
KIND[ord("0") : ord("9") + 1] = 2
KIND[[9, 10, 11, 12, 13, 32]] = 3
KIND[[ord(c) for c in ".,;:'-"]] = 4
KIND[[ord(c) for c in "!\"#$%&()*+/<=>?@[\\]^_`{|}~"]] = 5
KIND[192:] = 6
INPUTS = 8 + 64 + 128 + 4


def inputs(text: str | None) -> np.ndarray:
    """The inputs of one whole text."""
    out = np.zeros(INPUTS, np.float32)
    raw = (text or "").encode()
    if not raw:
        return out
    octets = np.frombuffer(raw, np.uint8)
    kinds = KIND[octets]
    pairs = np.bincount(kinds[:-1] * np.uint8(8) + kinds[1:], minlength=64) if len(raw) > 1 else np.zeros(64)
    out[:8] = np.bincount(kinds, minlength=8) / len(raw)
    out[8:72] = np.sqrt(pairs / len(raw))
    out[72:200] = np.sqrt(np.bincount(octets, minlength=256)[:128] / len(raw))
    words = raw.lower().split()
    if words:
        n = len(words)
        out[200] = len(set(words)) / n
        out[201] = sum(map(bytes.__eq__, words, words[1:])) / n
        out[202] = np.log1p(n) / 10
        lines = raw.split(b"\n")
        out[203] = len(set(lines)) / len(lines)
    return out


class Model:
    """Standardised inputs to a score; ``weights`` and ``bias`` of a logistic model."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale = mean, scale
        self.weights = {"w": np.zeros(INPUTS), "b": np.zeros(1)}

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.standard(x) @ self.weights["w"] + self.weights["b"][0])


def _fit_plain(model: Model, positive: np.ndarray, unlabelled: np.ndarray, steps: int = 300) -> None:
    """Positive against unlabelled, each class with half the weight."""
    x = np.concatenate([positive, unlabelled])
    y = np.concatenate([np.ones(len(positive)), np.zeros(len(unlabelled))])
    weight = np.where(y == 1, 0.5 / len(positive), 0.5 / len(unlabelled))
    adam = Adam(model.weights, 0.02)
    for _ in range(steps):
        slope = weight * (sigmoid(x @ model.weights["w"] + model.weights["b"][0]) - y)
        adam.step({"w": x.T @ slope + 1e-3 * model.weights["w"], "b": np.array([slope.sum()])})


def _fit_nnpu(model: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, floor: float = 0.0) -> None:
    """Minimise prior * R_p(+) + max(floor, R_u(-) - prior * R_p(-)) with the logistic loss."""
    adam = Adam(model.weights, 0.02)
    for _ in range(steps):
        adam.step(_nnpu_gradient(model.weights, positive, unlabelled, prior, floor))


def negative_risk(weights: dict, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """R_u(-) - prior * R_p(-): what the risk of negatives is estimated by, and may not go below 0."""
    zp, zu = (x @ weights["w"] + weights["b"][0] for x in (positive, unlabelled))
    return float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())


def _nnpu_gradient(weights: dict, positive: np.ndarray, unlabelled: np.ndarray, prior: float, floor: float = 0.0) -> dict:
    w, b = weights["w"], weights["b"][0]
    zp, zu = positive @ w + b, unlabelled @ w + b
    # loss(z, +) = log(1 + exp(-z)), slope -sigmoid(-z); loss(z, -) = log(1 + exp(z)).
    slope_p = -prior * sigmoid(-zp) / len(zp)
    to_p, to_u = -prior * sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)
    if negative_risk(weights, positive, unlabelled, prior) >= floor:
        gp, gu = slope_p + to_p, to_u
    else:  # go back up the part that has gone below its bound
        gp, gu = -to_p, -to_u
    return {"w": positive.T @ gp + unlabelled.T @ gu + RIDGE * w, "b": np.array([gp.sum() + gu.sum()])}


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio, over thresholds, of the shares above it in two histograms of scores."""
    p, u = positive[::-1].cumsum(), unlabelled[::-1].cumsum()
    if not p[-1] or not u[-1]:
        return 0.5
    share_p, share_u = p / p[-1], u / u[-1]
    enough = share_p >= 0.2
    return float(np.clip((share_u[enough] / share_p[enough]).min(), 0.05, 0.95))


def _training_rows(texts: DataFrame, labels: DataFrame, seen: Column, n_positive: int, n_start: int) -> DataFrame:
    """Bounded (doc_id, role): role 1 for trusted positives, 0 for unlabelled."""
    by_hash = F.xxhash64("doc_id", F.lit(7))
    ids = texts.where(seen & F.col("doc_id").isNotNull()).select("doc_id")
    positive = (
        labels.where((F.col("quality") == 1) & seen & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"))
        .join(texts.select("doc_id"), "doc_id", "left_semi")  # places only for documents at hand
    )
    return common.sampled(positive, by_hash, n_positive).withColumn("role", F.lit(1)).unionByName(
        common.sampled(ids, by_hash, n_start).withColumn("role", F.lit(0))
    )


def _taught_by_all(texts: DataFrame, model: Model, positive: np.ndarray, prior: float) -> dict[str, np.ndarray]:
    """The weights after every text has been an unlabelled one of the risk once.

    Every task starts from the model's weights and takes a step for each batch of its texts; the
    mean over tasks, by their texts, is what all have learned.
    """
    shared = texts.sparkSession.sparkContext.broadcast((model, positive))
    schema = pa.schema([("texts", pa.int64()), ("weights", pa.binary())])

    @common.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, positive = shared.value
        own = Model(model.mean, model.scale)
        own.weights = {k: v.copy() for k, v in model.weights.items()}
        adam, used = Adam(own.weights, STEP_RATE), 0
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_TEXTS):
                x = np.stack([inputs(t.as_py()) for t in batch.column(0).slice(at, STEP_TEXTS)]).astype(np.float64)
                some = positive[(used // STEP_TEXTS) % 8 :: 8] if len(positive) >= 80 else positive
                adam.step(_nnpu_gradient(own.weights, some, model.standard(x), prior))
                used += len(x)
        if used:
            total = np.append(own.weights["w"], own.weights["b"]) * used
            yield pa.RecordBatch.from_arrays([pa.array([used]), pa.array([total.tobytes()], pa.binary())], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, total = 0, np.zeros(INPUTS + 1)
        for batch in batches:
            for n, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                used, total = used + n, total + np.frombuffer(x.as_py(), np.float64)
        if used:
            yield pa.RecordBatch.from_arrays([pa.array([used]), pa.array([total.tobytes()], pa.binary())], schema=schema)

    # A row of 2 kB for each task, added up by at most 16 tasks.
    kind = "texts long, weights binary"
    sums = texts.select("text").mapInArrow(run, kind).repartitionById(16, F.pmod(F.xxhash64("weights"), F.lit(16)).cast("int"))
    rows = sums.sortWithinPartitions("texts", "weights").mapInArrow(add, kind).collect()
    used = sum(r.texts for r in rows)
    if not used:
        return model.weights
    mean = sum(np.frombuffer(r.weights, np.float64) for r in sorted(rows)) / used
    return {"w": mean[:-1], "b": mean[-1:]}


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1,
    n_positive: int = FIT_POSITIVE, n_start: int = FIT_START,
) -> Model:
    """Learn from the rows whose fold is not ``held_out``: from ``n_positive`` trusted positives and,
    after a start from ``n_start`` unlabelled texts, from all texts."""
    texts = common.id_and_text(docs, id_col, text_col)
    seen = common.fold(F.col("doc_id").cast("long"), folds) != held_out
    rows = _training_rows(texts, labels, seen, n_positive, n_start)

    @common.giving_back
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [inputs(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["role", "x"])

    # At most n_positive + n_start ids are broadcast and as many input rows collected: of rows that
    # share an id one text, the least.
    found = texts.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "role").agg(F.min("text").alias("text")).orderBy("doc_id", "role")
    kept = found.select("role", "text").mapInArrow(take, "role int, x binary").collect()
    x = np.frombuffer(b"".join(r.x for r in kept), np.float32).reshape(-1, INPUTS).astype(np.float64)
    role = np.array([r.role for r in kept])
    mean = x.mean(axis=0) if len(x) else np.zeros(INPUTS)
    model = Model(mean, np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(INPUTS))
    positive, unlabelled = model.standard(x[role == 1]), model.standard(x[role == 0])
    if len(positive) < 2 or len(unlabelled) < 2:
        return model

    # The prior comes from the scores of all texts of the training folds, against those of
    # positives that the first classifier has not seen.
    _fit_plain(model, positive[::2], unlabelled[::2])
    score = scorer(model)
    bins = (
        texts.where(seen).select(F.least(F.lit(BINS - 1), F.floor(score("text") * BINS)).alias("bin"))
        .groupBy("bin").count().collect()
    )
    unlabelled_bins = np.zeros(BINS)
    for bin_, n in bins:
        unlabelled_bins[int(bin_)] += n
    scores = model.scores(x[role == 1][1::2])
    positive_bins = np.bincount(np.minimum(BINS - 1, (scores * BINS).astype(int)), minlength=BINS)
    prior = estimate_prior(positive_bins, unlabelled_bins)
    model.weights = {"w": np.zeros(INPUTS), "b": np.array([np.log(prior / (1 - prior))])}
    _fit_nnpu(model, positive, unlabelled, prior)
    model.weights = _taught_by_all(texts.where(seen), model, positive, prior)
    model.prior = prior
    return model


def scorer(model: Model):
    """A column function from text to score."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        # Some texts at a time: the inputs of a whole batch are held several times as doubles.
        out = np.empty(len(texts))
        for at in range(0, len(texts), STEP_TEXTS):
            some = texts[at : at + STEP_TEXTS].tolist()
            out[at : at + len(some)] = model.scores(np.stack([inputs(t) for t in some]).astype(np.float64))
        common.give_back()
        return pa.array(out)

    return score


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
    n_positive: int = FIT_POSITIVE, n_start: int = FIT_START,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit(docs, labels, id_col, text_col, n_positive=n_positive, n_start=n_start)
    return (
        common.id_and_text(docs, id_col, text_col)
        .select("doc_id", (common.fold(F.col("doc_id"), 3) == 1).alias("held_out"), scorer(model)("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    model = fit(docs, labels)
    return docs.where(scorer(model)(F.coalesce(F.col("text"), F.lit(""))) >= threshold)
