"""A gated recurrent language model that scores whole documents.

Counts of every training word come from all training documents (``word_blocks``: the distinct
words of each block meet by hash).  The HEAD most frequent tokens are words of their own, the others
fall into tail classes by their endings.  The output softmax is factored: first the class
(of head words by frequency, or of the tail), then the word in its class.  Inside a tail
class words have their smoothed share of the class's counts, so the model gives every word
a probability, unseen ones included, as the unigram base does; before training it is that
base up to smoothing.

Training: every training document once, in ``TURNS`` turns of a share each.  In a turn the
share is dealt to trainers, one for ``TRAINER_TOKENS`` tokens of the corpus, so their number grows with it
and none has more to do; each runs truncated backpropagation from common weights in ``LANES`` lanes,
the state carried over windows and forgotten at document ends.  Their weights are averaged as a tree:
groups of ``FAN`` are summed by tasks until one group is left.

Scoring: documents of like length advance together, the state carried from window to window until each
document's end.

Arrays have lanes last, so that every operation runs over contiguous numbers.

Defined cases: null and empty texts are the end token alone; rows with null or repeated ids are
scored one by one (a null id hashes as the text ''); texts of any length are scored whole; with no
training documents the model is the uniform one over its classes and the base has N = V = 0; an
empty table gives an empty table; other columns are ignored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, gru
from . import word_blocks as wb

HEAD, HEAD_CLASS = 1_024, 32
HEAD_CLASSES, TAIL_CLASSES = HEAD // HEAD_CLASS, 32
CLASSES = HEAD_CLASSES + TAIL_CLASSES
HIDDEN, WINDOW, LANES = 16, 32, 256
#: Windows that a lane has before it goes on with other documents, at least.
LANE_WINDOWS = 32
#: Learning rate of each turn.
TURNS = (0.05, 0.04, 0.03, 0.01)
#: Training tokens of the corpus for each trainer.
TRAINER_TOKENS = 4_000_000
#: Trainers' weights that one task sums; at most so many rows reach the driver.
FAN = 16
#: Documents scored together.
SCORED = 2048
SMOOTHING = 0.1
END = b" end"  # no word has a space


def split(text: str) -> list[bytes]:
    return text.encode().lower().split()


def tail_class(word: bytes) -> int:
    core = word.rstrip(b".,;:!?\"')")
    sign = 0 if len(core) == len(word) else 1 if word[-1:] == b"." else 2
    return (zlib.crc32(core[-2:]) + 11 * sign) % TAIL_CLASSES


def pack_longs(x: np.ndarray) -> bytes:
    x = x.astype(np.uint64)
    return wb.join_parts(wb.pack_numbers(x & np.uint64(0xFFFFFFFF)), wb.pack_numbers(x >> np.uint64(32)))


def unpack_longs(data: bytes) -> np.ndarray:
    low, high = (wb.unpack_numbers(p).astype(np.int64) for p in wb.split_parts(data))
    return low + (high << 32)


ANSWERS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("check", pa.int64()), ("body", pa.binary())])
ANSWER_COLUMNS = "block long, part int, n int, check long, body binary"


def bucket_totals(blocks: wb.Blocks) -> DataFrame:
    """Each bucket's distinct words with their counts in all training documents, as block -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, {}

        def finish() -> pa.RecordBatch:
            words = sorted(total)
            counts = np.fromiter(map(total.__getitem__, words), np.int64, len(words))
            return wb.batch_of([(-1, part, len(words), 0, wb.join_parts(wb.pack_words(words), pack_longs(counts)))], ANSWERS)

        for row in wb.rows_of(batches):
            if row["part"] != part:
                if part is not None:
                    yield finish()
                part, total = row["part"], {}
            packed, counts = wb.split_parts(row["body"])
            for word, n in zip(wb.unpack_words(packed), wb.unpack_numbers(counts).tolist(), strict=True):
                total[word] = total.get(word, 0) + n
        if part is not None:
            yield finish()

    return wb.by_bucket(blocks).mapInArrow(run, ANSWER_COLUMNS)


def total_counts(blocks: wb.Blocks, totals: DataFrame) -> DataFrame:
    """Per block and bucket the words and their counts in all training documents.

    A bucket's totals come first, then its rows one by one, so a task holds one bucket's distinct
    words, however many blocks there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for row in wb.rows_of(batches):
            packed, counts = wb.split_parts(row["body"])
            words = wb.unpack_words(packed)
            if row["block"] == -1:
                total = dict(zip(words, unpack_longs(counts).tolist(), strict=True))
                continue
            counts = np.fromiter(map(total.__getitem__, words), np.int64, len(words))
            yield wb.batch_of([(row["block"], row["part"], row["n"], row["check"], wb.join_parts(packed, pack_longs(counts)))], ANSWERS)

    rows = blocks.words.select("block", "part", "n", "check", "body").unionByName(totals)
    return rows.repartition(blocks.buckets, "part").sortWithinPartitions("part", "block").mapInArrow(run, ANSWER_COLUMNS)


class Counts:
    """Corpus statistics: head words, N, V, and counts and distinct words of the tail classes."""

    def __init__(self, head: list[tuple[bytes, int]], tail: np.ndarray, tail_distinct: np.ndarray):
        self.words = {word: i for i, (word, _) in enumerate(head)}
        self.head = np.array([n for _, n in head], np.float64)
        self.tail, self.tail_distinct = tail, tail_distinct
        self.n = int(self.head.sum() + tail.sum())
        self.distinct = int((self.head > 0).sum() + tail_distinct.sum())
        self.norm = self.n + SMOOTHING * (self.distinct + 1)
        self.tail_norm = tail + SMOOTHING * (tail_distinct + 1)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Model ids: of head words their number, else HEAD + tail class."""
        number = self.words.get
        return np.fromiter((i if (i := number(w)) is not None else HEAD + tail_class(w) for w in words), np.int64, len(words))


def corpus_counts(totals: DataFrame, training_documents: int) -> Counts:
    """Bounded statistics of the whole corpus; the end token is always in the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("cls", pa.int32()), ("n", pa.int64()), ("distinct", pa.int64())])
        for row in wb.rows_of(batches):
            packed, counts = wb.split_parts(row["body"])
            words, counts = wb.unpack_words(packed), unpack_longs(counts)
            cls = np.fromiter(map(tail_class, words), np.int64, len(words))
            rows = [
                (None, c, int(counts[cls == c].sum()), int((counts[cls == c] > 0).sum())) for c in range(TAIL_CLASSES)
            ]
            rows += [(words[i], int(cls[i]), int(counts[i]), 1) for i in np.argsort(-counts, kind="stable")[:HEAD].tolist() if counts[i]]
            yield wb.batch_of(rows, schema)

    stats, path = common.stored(
        totals.select("body").mapInArrow(run, "word binary, cls int, n long, distinct long"), "lm-stats"
    )
    top = stats.where("word is not null").orderBy(F.desc("n"), "word").limit(HEAD - 1).collect()
    classes = stats.where("word is null").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct")).collect()
    common.remove(totals.sparkSession, path)
    tail, distinct = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for r in classes:
        tail[r.cls], distinct[r.cls] = r.n, r.distinct
    for r in top:
        tail[r.cls] -= r.n
        distinct[r.cls] -= 1
    head = sorted([(bytes(r.word), r.n) for r in top] + [(END, training_documents)], key=lambda x: (-x[1], x[0]))
    return Counts(head, tail, distinct)


def start_weights(counts: Counts, seed: int = 3) -> dict[str, np.ndarray]:
    """The unigram model: biases are log shares, what depends on the state is zero."""
    rng = np.random.default_rng(seed)
    head = np.full(HEAD, 0.0)
    head[: len(counts.head)] = counts.head + SMOOTHING
    by_class = head.reshape(HEAD_CLASSES, HEAD_CLASS)
    mass = np.concatenate([by_class.sum(axis=1), counts.tail_norm])
    weights = {
        "in": 0.3 * rng.standard_normal((HEAD + TAIL_CLASSES, 3 * HIDDEN)),
        "in_bias": np.concatenate([np.ones(HIDDEN), np.zeros(2 * HIDDEN)]),
        "u": rng.standard_normal((HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN),
        "cls": np.zeros((HIDDEN, CLASSES)),
        "cls_bias": np.log(np.maximum(mass, 1e-6) / mass.sum()),
        "word": np.zeros((HEAD_CLASSES, HIDDEN, HEAD_CLASS)),
        "word_bias": np.log(np.maximum(by_class, 1e-6) / np.maximum(by_class.sum(axis=1, keepdims=True), 1e-6)),
    }
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _class_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < HEAD, ids // HEAD_CLASS, ids - HEAD + HEAD_CLASSES)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Probabilities down the columns, in place."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _log_sum(logits: np.ndarray) -> np.ndarray:
    """Log normalisers of the columns; the logits are used up."""
    top = logits.max(axis=0)
    logits -= top
    np.exp(logits, out=logits)
    return np.log(logits.sum(axis=0)) + top


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Tokens of head words by class, and where each class begins and ends among them."""
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    edges = np.searchsorted(cls[order], np.arange(HEAD_CLASSES + 1)).tolist()
    return order[: edges[-1]], edges


def log_probs(w: dict, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log P(class) + log P(head word | class) of tokens after states ``h`` (hidden, tokens)."""
    cls = _class_of(ids)
    logits = w["cls"].T @ h
    logits += w["cls_bias"][:, None]
    out = logits[cls, np.arange(len(ids))].astype(np.float64)
    out -= _log_sum(logits)
    order, edges = _by_class(cls)
    states, words = h[:, order], ids[order] % HEAD_CLASS
    inside = np.empty(len(order))
    for c in range(HEAD_CLASSES):
        a, b = edges[c], edges[c + 1]
        if b > a:
            logits = w["word"][c].T @ states[:, a:b]
            logits += w["word_bias"][c][:, None]
            found = logits[words[a:b], np.arange(b - a)]
            inside[a:b] = found - _log_sum(logits)
    out[order] += inside
    return out


def gradients(w: dict, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, keep: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the mean log loss over a window (time, lanes) from states ``h`` (hidden, lanes)
    on, and the states after it."""
    time, lanes = inputs.shape
    given, ids = inputs.ravel(), targets.ravel()
    n = len(ids)
    x = (w["in"] + w["in_bias"]).take(given, axis=0).reshape(time, lanes, 3 * HIDDEN)
    states, kept = gru.forward_lanes(np.ascontiguousarray(x.transpose(0, 2, 1)), w["u"], h, keep)
    flat = np.ascontiguousarray(states.transpose(1, 0, 2)).reshape(HIDDEN, n)
    cls = _class_of(ids)
    p = w["cls"].T @ flat
    p += w["cls_bias"][:, None]
    _softmax(p)
    p[cls, np.arange(n)] -= 1
    p *= np.float32(1 / n)
    grads = {"cls": flat @ p.T, "cls_bias": p.sum(axis=1), "word": np.zeros_like(w["word"]), "word_bias": np.zeros_like(w["word_bias"])}
    d = w["cls"] @ p
    order, edges = _by_class(cls)
    own, words = flat[:, order], ids[order] % HEAD_CLASS
    d_own = np.empty_like(own)
    for c in range(HEAD_CLASSES):
        a, b = edges[c], edges[c + 1]
        if b > a:
            q = w["word"][c].T @ own[:, a:b]
            q += w["word_bias"][c][:, None]
            _softmax(q)
            q[words[a:b], np.arange(b - a)] -= 1
            q *= np.float32(1 / n)
            grads["word"][c], grads["word_bias"][c] = own[:, a:b] @ q.T, q.sum(axis=1)
            np.matmul(w["word"][c], q, out=d_own[:, a:b])
    d[:, order] += d_own
    d_states = np.ascontiguousarray(d.reshape(HIDDEN, time, lanes).transpose(1, 0, 2))
    d_x, grads["u"] = gru.backward_lanes(d_states, w["u"], kept)
    d_x = np.ascontiguousarray(d_x.transpose(0, 2, 1)).reshape(n, 3 * HIDDEN)
    grads["in_bias"] = d_x.sum(axis=0)
    order = np.argsort(given.astype(np.uint16), kind="stable")
    used, first = np.unique(given[order], return_index=True)
    grads["in"] = np.zeros_like(w["in"])
    grads["in"][used] = np.add.reduceat(d_x[order], first, axis=0)
    return grads, states[-1]


def train_window(w: dict, adam: gru.Adam, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """One step of truncated backpropagation; returns the states to carry on with."""
    grads, h = gradients(w, h, inputs, targets, keep)
    adam.step(grads, clip=1.0)
    return h


def train_stream(w: dict, streams: Iterator[np.ndarray], end: int, rate: float) -> int:
    """Train on documents (ids that end with ``end``) as they come, to the last token; returns
    the tokens used."""
    adam, used = gru.Adam(w, rate), 0
    waiting, size = [], 0
    h = np.zeros((HIDDEN, LANES), np.float32)

    def run(tokens: np.ndarray, n: int) -> np.ndarray:
        """Train in ``n`` lanes of equal length; returns the tokens left over."""
        nonlocal h
        cut = len(tokens) // n * n
        lanes, h = tokens[:cut].reshape(n, -1), h[:, :n]
        before = np.concatenate([np.full((n, 1), end), lanes[:, :-1]], axis=1)
        for a in range(0, lanes.shape[1], WINDOW):
            given = before[:, a : a + WINDOW].T
            h = train_window(w, adam, h, given, lanes[:, a : a + WINDOW].T, (given != end).astype(np.float32))
        return tokens[cut:]

    for ids in streams:
        waiting.append(ids)
        size += len(ids)
        used += len(ids)
        if size >= LANES * WINDOW * LANE_WINDOWS:
            waiting = [run(np.concatenate(waiting), LANES)]
            size = len(waiting[0])
    # What is left goes in fewer lanes, then its last tokens in one.
    for lanes in (max(1, size // (WINDOW * LANE_WINDOWS)), 1):
        if size:
            waiting = [run(np.concatenate(waiting), lanes)]
            size = len(waiting[0])
    return used


TRAINED = pa.schema([("trainer", pa.int32()), ("used", pa.int64()), ("weights", pa.binary())])


def averaged(trained: DataFrame, trainers: int) -> np.ndarray | None:
    """Mean of weights (trainer, used, weights * used as doubles), weighted by tokens used."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, used, total = None, 0, 0.0
        for row in wb.rows_of(batches):
            trainer = row["trainer"] if trainer is None else trainer
            used, total = used + row["used"], total + np.frombuffer(row["weights"], np.float64)
        if trainer is not None:
            yield wb.batch_of([(trainer // FAN, used, total.tobytes())], TRAINED)

    paths = []
    while trainers > FAN:
        groups = -(-trainers // FAN)
        dealt = trained.repartitionById(groups, F.expr(f"trainer div {FAN}").cast("int")).sortWithinPartitions("trainer")
        trained, path = common.stored(dealt.mapInArrow(add, "trainer int, used long, weights binary"), "lm-sums")
        paths.append(path)
        trainers = groups
    rows = trained.orderBy("trainer").collect()  # at most FAN
    common.remove(trained.sparkSession, *paths)
    used = sum(r.used for r in rows)
    return sum(np.frombuffer(r.weights, np.float64) for r in rows) / used if used else None


def fit(sequences: DataFrame, counts: Counts, tokens: int) -> dict[str, np.ndarray]:
    """Weights after all turns over ``sequences`` (doc_id, turn, deal, ids)."""
    spark = sequences.sparkSession
    weights, end = start_weights(counts), counts.words[END]
    trainers = max(1, tokens // TRAINER_TOKENS)
    for turn, rate in enumerate(TURNS):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = {k: v.copy() for k, v in shared.value.items()}  # noqa: B023
            trainer = None

            def documents() -> Iterator[np.ndarray]:
                nonlocal trainer
                for batch in batches:
                    trainer = batch.column(0)[0].as_py() if batch.num_rows and trainer is None else trainer
                    for ids in batch.column(1):
                        yield np.frombuffer(ids.as_py(), np.uint16).astype(np.int64)

            used = train_stream(w, documents(), end, rate)  # noqa: B023
            if used:
                flat = np.concatenate([w[k].ravel() for k in shared.value]).astype(np.float64) * used  # noqa: B023
                yield wb.batch_of([(trainer, used, flat.tobytes())], TRAINED)

        dealt = (
            sequences.where(F.col("turn") == turn).withColumn("trainer", F.pmod("deal", F.lit(trainers)).cast("int"))
            .repartitionById(trainers, "trainer").sortWithinPartitions("deal", "doc_id", "ids")
        )
        trained, path = common.stored(
            dealt.select("trainer", "ids").mapInArrow(run, "trainer int, used long, weights binary"), "lm-trained"
        )
        mean = averaged(trained, trainers)
        common.remove(spark, path)
        if mean is not None:
            at = 0
            for k, v in weights.items():
                weights[k] = mean[at : at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
        shared.unpersist()
    return weights


def score_documents(w: dict, ids: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """Natural log probabilities (classes and head words) of documents laid one after the other;
    each has its end token.  Documents of like length advance together, window by window."""
    order = np.argsort(-sizes, kind="stable")
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(len(sizes))
    table, u = w["in"] + w["in_bias"], np.ascontiguousarray(w["u"].T)
    for g in range(0, len(sizes), SCORED):
        group = order[g : g + SCORED]
        start, size = starts[group], sizes[group]
        # Documents with more than t tokens.
        live = np.searchsorted(-size, -np.arange(size[0]), side="left").tolist()
        h = np.zeros((HIDDEN, len(group)), np.float32)
        last = np.full(len(group), end)
        for a in range(0, int(size[0]), WINDOW):
            states, targets, lanes = [], [], []
            for t in range(a, min(a + WINDOW, int(size[0]))):
                n = live[t]
                h = gru.step_lanes(table.take(last[:n], axis=0).T, h[:, :n], u)
                last = ids[start[:n] + t]
                states.append(h)
                targets.append(last)
                lanes.append(group[:n])
            found = log_probs(w, np.concatenate(states, axis=1), np.concatenate(targets))
            np.add.at(out, np.concatenate(lanes), found)
    return out


class _Block:
    """A block's words with their counts, then its documents."""

    def __init__(self, counts: Counts):
        self.counts = counts
        self.words: list[bytes] = []
        self.totals: list[np.ndarray] = []
        self.checks: list[int] = []
        self.places, self.ready = wb.Places(), None

    def answer(self, row: dict) -> None:
        packed, totals = wb.split_parts(row["body"])
        self.words += wb.unpack_words(packed)
        self.totals.append(unpack_longs(totals))
        self.checks.append(row["check"])

    def document_words(self, row: dict) -> np.ndarray:
        wb.same_words(self.checks, row)
        if self.ready is None:
            c = np.concatenate(self.totals) if self.totals else np.empty(0, np.int64)
            ids = self.counts.ids(self.words)
            in_tail = np.zeros(len(ids))
            tail = ids >= HEAD
            in_tail[tail] = np.log((c[tail] + SMOOTHING) / self.counts.tail_norm[ids[tail] - HEAD])
            self.ready = np.log10((c + SMOOTHING) / self.counts.norm), c > 0, ids, in_tail
            self.words = []
        return self.places.of(row["body"])


def _blocks_of(batches: Iterator[pa.RecordBatch], counts: Counts) -> Iterator[tuple[_Block, list[dict]]]:
    """Each block with its rows of documents."""
    block, number, rows = None, None, []
    for row in wb.rows_of(batches):
        if row["block"] != number:
            if rows:
                yield block, rows
            block, number, rows = _Block(counts), row["block"], []
        if row["kind"] == wb.WORDS:
            block.answer(row)
        else:
            rows.append(row)
    if rows:
        yield block, rows


def _training_sequences(met: DataFrame, counts_shared) -> DataFrame:
    """(doc_id, turn, deal, ids) of all training documents.

    ``deal`` is a hash of the id and of the number of the block's rows with that id before, so that
    rows that share an id don't meet in one trainer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("turn", pa.int32()), ("deal", pa.int32()), ("ids", pa.binary())])
        counts = counts_shared.value
        end = counts.words[END]
        for block, rows in _blocks_of(batches, counts):
            seen: dict[int | None, int] = {}
            for row in rows:
                words = block.document_words(row)
                ends = np.cumsum(np.array(row["sizes"], np.int64))
                found = []
                for doc_id, flag, size, stop in zip(row["doc_ids"], row["flags"], row["sizes"], ends.tolist(), strict=True):
                    if not flag:
                        ids = np.append(block.ready[2][words[stop - size : stop]], end).astype(np.uint16)
                        seen[doc_id] = again = seen.get(doc_id, -1) + 1
                        deal = zlib.crc32(f"{doc_id} {again}".encode())
                        found.append((doc_id, deal % len(TURNS), deal // len(TURNS), ids.tobytes()))
                if found:
                    yield wb.batch_of(found, schema)

    return met.mapInArrow(run, "doc_id long, turn int, deal int, ids binary")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Documents whose fold is 0 are held out; scores are log10 probabilities.
    """
    spark = docs.sparkSession
    texts = common.id_and_text(docs, id_col, text_col).withColumn(
        "flag", (common.fold(F.col("doc_id"), folds) == 0).cast("int")
    )
    blocks = wb.cut_blocks(texts, split, lambda held_out: not held_out)
    totals, totals_path = common.stored(bucket_totals(blocks), "lm-totals")
    training = blocks.documents.select(F.explode("flags").alias("f")).where("f = 0").count()
    counts = corpus_counts(totals, training)
    shared = spark.sparkContext.broadcast(counts)
    answers, _ = common.stored(total_counts(blocks, totals), "lm-counts")
    common.remove(spark, totals_path)
    met = wb.to_blocks(blocks, answers)
    sequences, path = common.stored(_training_sequences(met, shared), "lm-sequences", partition_by="turn")
    weights = spark.sparkContext.broadcast(fit(sequences, counts, counts.n))
    common.remove(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
        ])
        counts, w = shared.value, weights.value
        end = counts.words[END]
        end_count = counts.head[end]
        for block, rows in _blocks_of(batches, counts):
            doc_ids, flags, n_words, known, base, tail, all_ids, sizes = [], [], [], [], [], [], [], []
            for row in rows:
                words = block.document_words(row)
                size = np.array(row["sizes"], np.int64)
                owner = np.repeat(np.arange(len(size)), size)
                log_base, is_known, ids, in_tail = block.ready
                for into, values in ((known, is_known), (base, log_base), (tail, in_tail)):
                    into.append(np.bincount(owner, values[words], len(size)))
                ends = np.cumsum(size)
                all_ids.append(np.insert(ids[words], ends, end).astype(np.int32))
                sizes.append(size + 1)
                doc_ids += row["doc_ids"]
                flags += row["flags"]
            sizes = np.concatenate(sizes)
            logs = score_documents(w, np.concatenate(all_ids), sizes, end)
            found = (logs + np.concatenate(tail)) / np.log(10)
            base_scores = np.concatenate(base) + np.log10((end_count + SMOOTHING) / counts.norm)
            knowns = np.concatenate(known).astype(np.int64) + int(end_count > 0)
            yield wb.batch_of(
                zip(doc_ids, [bool(f) for f in flags], sizes.tolist(), knowns.tolist(), [counts.n] * len(sizes),
                    base_scores.tolist(), found.tolist(), strict=True),
                schema,
            )

    return met.mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
