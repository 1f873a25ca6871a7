"""Runs of repeating words, by the dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least max(``least_length``, 2q)
long, that no neighbouring word extends with that period.

The dictionary names, for every power of two l, the stretches (factors) of l words: equal stretches
of a text have one name, made from the names of their halves; a stretch that is there once has none
and is never looked at again.  A run of period q, l <= q < 2l, starts with a factor that comes
again q words later, so for each factor its next occurrences l to 2l - 1 words on are looked up.  They
form one arithmetic progression: if there are several, they overlap, so the word before each but the first
is the same.  One comparison therefore tells whether all of them could be left-extended; those that
couldn't propose their distance as the period of a run that starts just here.  (A run's start is
proposed in this way once, and a progression is unfolded only at the start of a stretch of its own
difference, so proposals grow in proportion to the words, level by level.)  Proposals are
extended to the right over the dictionary, from the longest factors down, one step a level.  Of
proposals with the same stretch the smallest period stays: the others are multiples of it.

Many texts are worked on together, divided by a word that is nowhere else; a text is never cut.  Memory
is some 100 bytes a word of the longest text, or of ``CHUNK_WORDS`` words.

Defined cases: null and empty texts, and texts of white space, have no words, no run and the empty
collapsed text; rows are independent of one another, whether their ids are null or repeat; an empty
table gives an empty table; other columns are ignored, whatever their names.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .word_blocks import Numbered

#: Texts are worked on together up to so many words.
CHUNK_WORDS = 200_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("longest", RUN), ("runs", pa.list_(RUN)),
    ("collapsed", pa.string()),
])
COLUMNS = (
    "doc_id long, n_words long, n_runs long, longest struct<start:long,length:long,period:long>, "
    "runs array<struct<start:long,length:long,period:long>>, collapsed string"
)


def basic_factors(words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level k: the names of the factors of 2^k words by their start (below 0 and all
    different: there once), and the starts of the named ones."""
    n, levels = len(words), []
    at, key = np.arange(n), words
    while True:
        _, name, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times[name] > 1
        at, name = at[again], name[again]
        if not len(at):
            return levels
        names = -np.arange(1, n + 1)
        names[at] = name
        levels.append((names, at))
        size = 1 << (len(levels) - 1)
        inside = at + size < n
        at, name = at[inside], name[inside]
        other = names[at + size]
        both = other >= 0
        at, key = at[both], name[both] * np.int64(n) + other[both]


def common_length(levels: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that agree from i and from j > i on.  No factor of twice the top level's length comes
    again, so one step a level is enough."""
    agreed = np.zeros(len(i), np.int64)
    n = len(levels[0][0]) if levels else 0
    for k in range(len(levels) - 1, -1, -1):
        names = levels[k][0]
        inside = j + agreed < n
        agreed[inside] += (names[(i + agreed)[inside]] == names[(j + agreed)[inside]]) << k
    return agreed


def proposals(levels: list, k: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods, 2^k <= period < 2^(k + 1), whose first words come again a period later
    and cannot be extended to the left.  ``words[0]`` is there once."""
    names, at = levels[k]
    n, size = len(words), 1 << k
    named = names[at]
    order = np.argsort(named, kind="stable")
    place, base = at[order], named[order] * np.int64(n + 1)
    key = base + place
    first = np.searchsorted(key, base + np.minimum(place + size, n))
    end = np.searchsorted(key, base + np.minimum(place + 2 * size, n))
    some = end > first
    i, first, end = place[some], first[some], end[some]
    near = place[first]
    open_ = words[i - 1] != words[near - 1]
    starts, others = [i[open_]], [near[open_]]
    several = end - first > 1
    i, first, end = i[several], first[several], end[several]
    open_ = words[i - 1] != words[place[first + 1] - 1]
    i, first, count = i[open_], first[open_] + 1, (end - first)[open_] - 1
    if len(i):
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts.append(np.repeat(i, count))
        others.append(place[np.repeat(first, count) + step])
    start = np.concatenate(starts)
    return start, np.concatenate(others) - start


def runs_of(words: np.ndarray, least_length: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; ``words[0]`` is there once."""
    levels = basic_factors(words)
    found = []
    for k in range(len(levels)):
        start, period = proposals(levels, k, words)
        length = period + common_length(levels, start, start + period)
        whole = length >= 2 * period
        found.append(np.stack([start[whole], length[whole], period[whole]]))
    start, length, period = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    keep = smallest & (length >= least_length)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _structs(start: np.ndarray, length: np.ndarray, period: np.ndarray, mask: np.ndarray | None = None) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(RUN), mask=None if mask is None else pa.array(mask)
    )


def described(ids: list, texts: list[list[bytes]], least_length: int) -> pa.RecordBatch:
    """One row for each text (its words)."""
    number = Numbered()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(sizes + 1) - sizes  # one divider before each text
    total = int(sizes.sum()) + len(texts)
    # Words of different texts differ, and dividers from all.
    numbers = np.concatenate([np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    words = np.empty(total, np.int64)
    is_word = np.ones(total, bool)
    is_word[offsets - 1] = False
    words[is_word] = owner * np.int64(len(number)) + numbers
    words[offsets - 1] = -1 - np.arange(len(texts))
    start, length, period = runs_of(words, least_length)

    text = np.searchsorted(offsets, start, side="right") - 1
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    # The longest run of each text: the first by length, start and period.
    order = np.lexsort((period, start, -length, text))
    has = np.diff(edges) > 0
    best = order[np.minimum(edges[:-1], max(len(order) - 1, 0))] if len(order) else np.zeros(len(texts), np.int64)
    local = start - offsets[text]

    # Covered by what follows the first period of some run.
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover)[:-1] == 0
    collapsed = []
    for i, t in enumerate(texts):
        if has[i]:
            t = [w for w, k in zip(t, kept[offsets[i] : offsets[i] + sizes[i]].tolist(), strict=True) if k]
        collapsed.append(b" ".join(t))

    def of_best(x: np.ndarray) -> np.ndarray:
        return x[best] if len(order) else np.zeros(len(texts), np.int64)

    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array(sizes), pa.array(np.diff(edges)),
            _structs(of_best(local), of_best(length), of_best(period), ~has),
            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), _structs(local, length, period)),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        schema=SCHEMA,
    )


def find_runs(
    docs: DataFrame,
    least_length: int = 12,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_runs, longest (null without a run), runs, collapsed of every row.

    ``collapsed`` has the words that no run contains after its first period, joined by a space.
    ``rewrite`` is given each row's id and words, and returns the words to use in their place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_py().encode().split()
                if rewrite:
                    words = rewrite(doc_id, words)
                ids.append(doc_id)
                texts.append(words)
                size += len(words) + 1
                if size >= CHUNK_WORDS:
                    yield described(ids, texts, least_length)
                    ids, texts, size = [], [], 0
        if ids:
            yield described(ids, texts, least_length)

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, COLUMNS)
