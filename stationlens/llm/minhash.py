"""MinHash near-duplicates by bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles, as 63-bit hashes; its sketch is the K
least of them.  Documents with one set (a 128-bit digest of all its hashes, and their number) are a
*class* with one representative, so copies are never compared.  Classes are then linked in two rounds:

1. Inverted lists of retained values give overlaps.  If two sets are similar enough to be linked,
   their sketches share at least T values (see ``least_shared``), so it is enough to list each class
   under its rarest ones (all but T - 1).  Each list names one leader, its class with the most
   common values; every class of the list is compared with that leader alone.
2. Classes that share a value share the leader of its list, so lists with one leader are joined
   to one, which a class is in once.  Where all its classes are in one component by now, nothing is left
   to do; in the others pairs of different components are compared, block by block, by their sketches.

In both rounds the union sketch (the K least values of two sketches) estimates the Jaccard
index; pairs whose estimate is near or over the threshold are confirmed on the full sets.  In round 2
blocks also carry the ``WIDE`` least values of each set (most sets are whole in these), and only pairs
that are near enough by them, and join components that the task's pairs haven't joined yet, leave the
task; so a large group doesn't become all its pairs.  What sketches must share and how near an estimate must be follow from the
threshold.

Defined cases: null and empty texts have an empty set and are linked with nothing; texts of
fewer than five words are one shingle; rows with a null id take part by their text (a component
of only null ids has the null id); repeated ids are compared row by row, a row being told by its id
and its text; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common, links
from .word_blocks import Numbered, batch_of

K = 64
WORDS = 5
#: Values of a set that blocks are compared by.
WIDE = 512
#: Fills up sketches of fewer than K values; no value of a sketch, as those are the least ones.
NONE = np.iinfo(np.int64).max
#: Standard deviations by which a sketch may understate a pair before it is passed over: in what it
#: shares, and in its estimate.
SHARED_DEVIATIONS, ESTIMATE_DEVIATIONS = 5.75, 4.6
#: Classes in a block of a joined list, about; and columns into which a block's values are hashed.
BLOCK, COLUMNS = 1_024, 1_024
#: Ids and digests of rows are broadcast up to this number (50 bytes each), else joined by shuffle.
MAX_BROADCAST_IDS = 500_000

SKETCHES = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("sketch", pa.list_(pa.int64())),
])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sets of texts in turn; words are hashed once for some texts together."""
    import xxhash

    for start in range(0, len(texts), 64):
        chunk = texts[start : start + 64]
        numbered = Numbered()
        split = [t.encode().lower().split() for t in chunk]
        numbers = [np.fromiter(map(numbered.__getitem__, w), np.int64, len(w)) for w in split]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbered), np.uint64, len(numbered))
        for n in numbers:
            h = hashes[n]
            if not len(h):
                yield h
                continue
            size = min(WORDS, len(h))
            out = np.full(len(h) - size + 1, size, np.uint64)
            for i in range(size):
                out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
            yield np.unique(out >> np.uint64(1))  # signed and unsigned order alike


def class_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(texts: DataFrame) -> DataFrame:
    @common.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            rows = []
            ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for doc_id, key, s in zip(ids, keys, shingle_sets(batch.column(1).to_pylist()), strict=True):
                rows.append((doc_id, key, len(s), class_key(s) if len(s) else None, s[:K].view(np.int64)))
            if rows:
                yield batch_of(rows, SKETCHES)

    return texts.select("doc_id", "text", "text_key").mapInArrow(
        run, "doc_id long, text_key binary, n_shingles long, key binary, sketch array<long>"
    )


def full_sets(rows: DataFrame) -> DataFrame:
    """(cls, shingles as bytes) of rows (cls, key, text) whose text is of the class."""

    @common.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("cls", pa.int64()), ("shingles", pa.binary())])
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            wanted = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            made = shingle_sets(batch.column(2).to_pylist())
            found = {c: s.tobytes() for (c, key), s in zip(wanted, made, strict=True) if len(s) and class_key(s) == key}
            if found:
                yield batch_of(found.items(), schema)

    # Rows that repeat an id and its text are several rows of one class.
    made = rows.select("cls", "key", "text").mapInArrow(run, "cls long, shingles binary")
    return made.groupBy("cls").agg(F.first("shingles").alias("shingles"))


def bounds(threshold: int) -> tuple[int, int, float]:
    """(whole, shared, margin) for a threshold in percent.

    Sets of up to ``whole`` shingles, and all sets linked with them, are whole in their sketches, which so
    share at least ``threshold`` percent of the larger.  Sketches of larger sets that are linked share K times the
    threshold on average and, but for ``SHARED_DEVIATIONS``, at least ``shared``.  An estimate is
    less than ``margin`` too low, but for ``ESTIMATE_DEVIATIONS``.
    """
    t = threshold / 100
    spread = math.sqrt(t * (1 - t))
    shared = max(1, math.floor(K * t - SHARED_DEVIATIONS * math.sqrt(K) * spread))
    return K * threshold // 100, shared, ESTIMATE_DEVIATIONS * spread / math.sqrt(K)


def least_shared(n, threshold: int):
    """Values that the sketches of two linked sets, one of ``n`` shingles, share at least."""
    whole, shared, _ = bounds(threshold)
    if isinstance(n, np.ndarray):
        return np.where(n <= whole, -(-n * threshold // 100), shared)
    return F.when(n <= whole, F.ceil(n * threshold / 100)).otherwise(F.lit(shared)).cast("int")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of pairs (a, b) those with 100 * shared >= threshold * all, by the full sets."""

    @common.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(x, y)
                shared = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep)) for c in (batch.column(0), batch.column(1))], names=["a", "b"]
            )

    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _estimate(x, y):
    """Share of the union sketch's values that both sketches have."""
    union = F.slice(F.array_sort(F.array_union(x, y)), 1, K)
    return F.size(F.array_intersect(F.array_intersect(x, y), union)) / F.size(union)


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The union sketch's estimate for rows of two arrays of sketches, filled up with NONE."""
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    real = both != NONE
    first = np.ones(both.shape, bool)
    first[:, 1:] = both[:, 1:] != both[:, :-1]
    rank = (first & real).cumsum(axis=1)
    inside = real & (rank <= K)
    return (inside & ~first).sum(axis=1) / np.maximum((inside & first).sum(axis=1), 1)


def near_enough(x: np.ndarray, n: int, y: np.ndarray, m: int, threshold: int) -> bool:
    """Whether sets of n and m values may be linked, by their least values ``x`` and ``y``: exact if
    these are all, else but for ``ESTIMATE_DEVIATIONS``."""
    missing = [v[-1] for v, size in ((x, n), (y, m)) if size > len(v)]
    if missing:  # below this value both are whole
        cut = min(missing)
        x, y = x[: np.searchsorted(x, cut, side="right")], y[: np.searchsorted(y, cut, side="right")]
    at = np.searchsorted(x, y)
    shared = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) and len(y) else 0
    union = len(x) + len(y) - shared
    if not missing:
        return 100 * shared >= threshold * union
    t = threshold / 100
    return shared >= (t - ESTIMATE_DEVIATIONS * math.sqrt(t * (1 - t) / union)) * union


def _across(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components in each pair of blocks that may be similar enough."""
    margin = bounds(threshold)[2]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "lead", "i", "j").sortWithinPartitions("lead", "i", "j", "block")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs_of(group: list[tuple]) -> Iterator[tuple]:
        block, cls, n, component = (np.array(c, np.int64) for c in list(zip(*(g[:4] for g in group), strict=True)))
        sketch = np.full((len(group), K), NONE)
        for row, g in zip(sketch, group, strict=True):
            row[: len(g[4])] = g[4]
        least = least_shared(n, threshold)
        at = np.nonzero(sketch != NONE)
        hashed = np.zeros((len(group), COLUMNS), np.float32)
        np.add.at(hashed, (at[0], sketch[at] % COLUMNS), 1)
        one = block[0] == block[-1]
        left = np.arange(len(group)) if one else np.flatnonzero(block == block[0])
        right = left if one else np.flatnonzero(block != block[0])
        # Every shared value adds at least one, so no pair with enough of them is passed over.
        near = hashed[left] @ hashed[right].T >= np.maximum(least[left][:, None], least[right])
        near &= component[left][:, None] != component[right]
        near &= 100 * np.minimum(n[left][:, None], n[right]) >= threshold * np.maximum(n[left][:, None], n[right])
        if one:
            near &= left[:, None] < right
        x, y = (side[z] for side, z in zip((left, right), np.nonzero(near), strict=True))
        wide: dict[int, np.ndarray] = {}
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        for start in range(0, len(x), 8192):
            u, v = x[start : start + 8192], y[start : start + 8192]
            likely = estimates(sketch[u], sketch[v]) >= threshold / 100 - margin
            for p, q in zip(u[likely].tolist(), v[likely].tolist(), strict=True):
                a, b = root(int(component[p])), root(int(component[q]))
                if a == b:  # linked by pairs that have left already
                    continue
                for z in (p, q):
                    if z not in wide:
                        wide[z] = np.frombuffer(group[z][5], np.uint64)
                if near_enough(wide[p], int(n[p]), wide[q], int(n[q]), threshold):
                    yield min(cls[p], cls[q]), max(cls[p], cls[q])
                    if max(n[p], n[q]) <= WIDE:  # compared whole, so this is a link
                        above[max(a, b)] = min(a, b)

    @common.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    found = list(pairs_of(group)) if len(group) > 1 else []
                    if found:
                        yield batch_of(found, schema)
                    key, group = row[:3], []
                group.append(row[3:])
        found = list(pairs_of(group)) if len(group) > 1 else []
        if found:
            yield batch_of(found, schema)

    return dealt.mapInArrow(run, "a long, b long")


def _joined(rows: DataFrame, few: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``few``, which has one row a key, and in ``size`` the key's number of rows.

    Keys with more than a thousandth of all rows (so there are fewer than a thousand) are joined
    where their rows are; only the others' rows are shuffled.  Both are stored tables.
    """
    total = few.agg(F.sum(size)).first()[0] or 0
    hot = few.where(F.col(size) * 1000 > total)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(few, key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return common.id_and_text(docs, id_col, text_col).withColumn("text_key", _text_key(F.col("text")))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _grouped(texts: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, component_id) of every row of ``texts``: ``node`` tells the
    component and is null for empty sets, ``component_id`` is its least doc_id."""
    spark, used = texts.sparkSession, []

    def stored(df: DataFrame, name: str) -> DataFrame:
        made, path = common.stored(df, name)
        used.append(path)
        return made

    rows = stored(sketches(texts), "sketches")
    n = F.col("n_shingles")
    one_size = F.when(F.min(n) == F.max(n), F.min(n)).otherwise(F.raise_error(F.lit("sets of two sizes have one digest")).cast("long"))
    # The number given to a class holds from here on, as the table is written.
    classes = stored(
        rows.where("n_shingles > 0").groupBy("key")
        .agg(one_size.alias("n"), F.min(F.struct("doc_id", "text_key")).alias("of"), F.min("doc_id").alias("least_id"), F.first("sketch").alias("sketch"), F.count("*").alias("m"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )

    # Inverted lists of the rarest retained values.  Values of one class alone list nothing.
    values = classes.select("cls", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("classes")).where("classes > 1")
    own = Window.partitionBy("cls")
    ranked = values.join(shared, "value").withColumns({
        "rank": F.row_number().over(own.orderBy("classes", "value")),
        "listed": F.count("*").over(own),
        "weight": F.sum("classes").over(own),
    })
    sizes = classes.select("cls", "n", F.size("sketch").alias("k"))
    lists = stored(
        ranked.join(sizes, "cls")
        .where(F.col("rank") + F.col("k") - F.col("listed") <= F.col("k") - least_shared(F.col("n"), threshold) + 1)
        .select("value", "cls", "n", "weight"),
        "lists",
    )

    def similar_size(n, m):
        return 100 * F.least(n, m) >= threshold * F.greatest(n, m)

    least = threshold / 100 - bounds(threshold)[2]
    side = classes.select("cls", "sketch")
    a, b = side.toDF("a", "x"), side.toDF("b", "y")

    # Round 1: every class of a list with the list's leader.
    leaders = lists.groupBy("value").agg(F.max(F.struct("weight", "cls", "n")).alias("lead"))
    with_leader = (
        lists.join(leaders, "value")
        .where((F.col("cls") != F.col("lead.cls")) & similar_size(F.col("n"), F.col("lead.n")))
        .select(F.least("cls", "lead.cls").alias("a"), F.greatest("cls", "lead.cls").alias("b")).distinct()
    )
    first = stored(
        with_leader.join(a, "a").join(b, "b").where(_estimate(F.col("x"), F.col("y")) >= least).select("a", "b"), "pairs"
    )
    wanted = stored(_representatives(lists, classes), "wanted")
    sets = stored(full_sets(_texts_of(wanted, texts)), "sets")
    linked = stored(_confirmed(first, sets, threshold), "linked")
    found = links.components(linked)

    # Round 2: pairs of different components in joined lists that still have several.
    joined = lists.join(leaders.select("value", F.col("lead.cls").alias("lead")), "value").select("lead", "cls", "n").distinct()
    placed = stored(
        joined.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls")),
        "placed",
    )
    several = stored(
        placed.groupBy("lead")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("classes"))
        .where("low < high").select("lead", "classes", F.ceil(F.col("classes") / BLOCK).cast("int").alias("blocks")),
        "several",
    )
    open_lists = (
        _joined(placed, several, "lead", "classes").join(side, "cls")
        .join(sets.select("cls", F.substring("shingles", 1, 8 * WIDE).alias("wide")), "cls")
        .withColumn("block", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("lead", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                "cls", "n", "component", "sketch", "wide")
    )
    second = stored(_across(open_lists, threshold).distinct(), "pairs")
    more = stored(_confirmed(second, sets, threshold), "linked")
    final = links.components(linked.union(more))

    # A component's id is the least document id of its classes' rows; a class alone is its own.
    members = stored(
        classes.select("cls", "key", "least_id", "m").join(final.withColumnRenamed("node", "cls"), "cls", "left"), "members"
    )
    together = members.where("component is not null")
    lowest = stored(
        together.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("classes")), "lowest"
    )
    named = stored(
        _joined(together, lowest, "component", "classes").select("key", "m", F.col("component").alias("node"), "component_id")
        .unionByName(
            members.where("component is null").select("key", "m", F.col("cls").alias("node"), F.col("least_id").alias("component_id"))
        ),
        "named",
    )
    columns = ["doc_id", "text_key", "n_shingles", "node", "component_id"]
    whole = _joined(rows.where("key is not null").drop("sketch"), named, "key", "m").select(*columns)
    none = rows.where("key is null").select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("node"), F.col("doc_id").alias("component_id")
    )
    answer, _ = common.stored(whole.unionByName(none), "near-duplicates")
    common.remove(spark, *used)
    return answer


def near_duplicates(docs: DataFrame, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; ``threshold`` is in percent."""
    found = _grouped(_keyed(docs, id_col, text_col), threshold)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def one_of_each(docs: DataFrame, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component, and all without shingles.

    The row with the least id stays (null ids last), of several the one with the least digest of its
    text; of rows alike in id and text any one.  Rows are told by both, so unlike texts under one id,
    or without an id, go their own ways.
    """
    found = _grouped(_keyed(docs, id_col, text_col), threshold).where("node is not null")
    row = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_key")
    groups = found.groupBy("node").agg(F.count("*").alias("rows"), F.min(row).alias("first")).where("rows > 1")
    groups, _ = common.stored(groups, "groups")
    members = _joined(found, groups, "node", "rows")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    # Of rows alike in id and text, those that stay are taken out as well, and one is put back.
    alike = members.groupBy("doc_id", "text_key").agg(F.count("*").alias("times"), F.max(stays).alias("stays"))
    out, _ = common.stored(alike.where("not stays or times > 1"), "dropped")
    again = out.where("stays")
    key = {name: _unused(docs, name) for name in ("row_id", "row_text")}
    keyed = docs.withColumns({
        key["row_id"]: docs[id_col].cast("long"), key["row_text"]: _text_key(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    })

    def those(rows: DataFrame, few: DataFrame, how: str) -> DataFrame:
        few = few.select(F.col("doc_id").alias(_unused(rows, "out_id")), F.col("text_key").alias(_unused(rows, "out_text")))
        id_, text = few.columns
        same = F.col(key["row_id"]).eqNullSafe(F.col(id_)) & (F.col(key["row_text"]) == F.col(text))
        return rows.join(F.broadcast(few) if few.count() <= MAX_BROADCAST_IDS else few, same, how)

    rest = those(keyed, out, "left_anti")
    if again.limit(1).count():
        rest = rest.unionByName(those(keyed, again, "left_semi").dropDuplicates(list(key.values())))
    return rest.select(*(rest[f"`{c}`"] for c in docs.columns))


def _unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it a name that no column has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _representatives(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, key, of_id, of_text) of all classes in any list."""
    return classes.join(lists.select("cls").distinct(), "cls", "left_semi").select(
        "cls", "key", F.col("of.doc_id").alias("of_id"), F.col("of.text_key").alias("of_text")
    )


def _texts_of(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(cls, key, text) of the rows with a representative's id and text."""
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_text"))
    return texts.join(wanted, same).select("cls", "key", "text")
