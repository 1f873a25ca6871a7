"""Runs against every period of every stretch, on odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlens.llm import periodic_runs, queries

from .conftest import prose


def plain_runs(w, least=12):
    """Period by period the stretches of equal words that far apart; the smallest period of each stays."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        t = 0
        while t + q < len(w):
            start = t
            while t + q < len(w) and w[t] == w[t + q]:
                t += 1
            if t - start >= q:
                found.setdefault((start, t - start + q), q)
            t += 1
    return sorted((s, n, q) for (s, n), q in found.items() if n >= least)


def fast_runs(w, least=12):
    start, length, period = periodic_runs.runs_of(np.array([-1, *w], np.int64), least)
    return list(zip((start - 1).tolist(), length.tolist(), period.tolist(), strict=True))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("w", [
    [], [0], [0] * 11, [0] * 12, [0] * 200, [0, 1] * 6, [0, 1, 2, 3, 4, 5] * 2, ([0] * 20 + [1]) * 12, fibonacci(300),
    ([0, 1] * 9 + [2]) * 7 + [0, 1] * 9, list(range(30)) * 5, list(range(16)) * 2, list(range(17)) * 2 + [0], [1, 0, 0, 1] * 40,
])
def test_known_words(w):
    for least in (2, 12):
        assert fast_runs(w, least) == plain_runs(w, least)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 4), st.lists(st.integers(0, 3), max_size=40))
def test_random_words(base, times, rest):
    w = base * times + rest + base * times
    for least in (2, 12):
        assert fast_runs(w, least) == plain_runs(w, least)


def described(texts, least=12):
    batch = periodic_runs.described(list(range(len(texts))), [t.encode().split() for t in texts], least)
    return batch.to_pylist()


def plain_row(text):
    words = (text or "").encode().split()
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return len(words), runs, longest, b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()


def same(row, text):
    n, runs, longest, collapsed = plain_row(text)
    as_tuple = lambda r: r and (r["start"], r["length"], r["period"])
    assert (row["n_words"], row["n_runs"], row["collapsed"]) == (n, len(runs), collapsed), text
    assert [as_tuple(r) for r in row["runs"]] == runs and as_tuple(row["longest"]) == longest


def odd_texts():
    rng = random.Random(4)
    texts = ["", None, " \t ", "one", "la " * 40, "A a " * 9, "é è é " * 12, "a\x1cb " * 13, "x\ny\x0bz\x0c" * 5]
    texts += [prose(1, 30) + " " + prose(2, 20) * 4, prose(3, 400), ("same line here\n" * 30) + prose(1, 10)]
    for _ in range(40):
        unit = " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 30)))
        texts.append(f"{prose(rng.randrange(99), rng.randrange(20))} {(unit + ' ') * rng.randrange(1, 8)} {unit[:7]} b c a")
    return texts


def test_rows_do_not_meet_each_other():
    texts = [t or "" for t in odd_texts()]
    for chunk in (texts, texts + texts, texts[::-1], ["la " * 6] * 5):  # equal neighbours are no run of one text
        for row, text in zip(described(chunk), chunk, strict=True):
            same(row, text)


def test_job_on_odd_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 300)
    texts = odd_texts()
    ids = [None, None, 7, 7, *range(100, 100 + len(texts) - 4)]
    found = periodic_runs.find_runs(documents(texts, ids)).collect()
    assert len(found) == len(texts)
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] or 0, plain_row(texts[i])[3]))
    rows = sorted((r.asDict(recursive=True) for r in found), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["collapsed"]))
    for i, row in zip(order, rows, strict=True):
        same(row, texts[i])


def test_empty_table(documents):
    assert periodic_runs.find_runs(documents([])).collect() == []


def test_very_long_text():
    text = " ".join(f"w{i % 20_011}" for i in range(100_000))
    assert described([text])[0]["longest"] == {"start": 0, "length": 100_000, "period": 20_011}


def plain_planted(doc_id, words):
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()) & 0xFFFFFFFF, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_query_on_whole_table(spark, tmp_path, documents):
    texts = odd_texts() * 4
    ids = [None, *range(len(texts) - 1)]
    documents(texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
    assert sum(i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in ids) > 10
    rows = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in zip(ids, texts, strict=True):
        words = plain_planted(i, (text or "").encode().split())
        _, runs, longest, collapsed = plain_row(b" ".join(words).decode())
        row, longest = rows[i], longest or (None, None, None)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *longest)
        assert row.exponent_milli == (1000 * longest[1] // longest[2] if runs else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and row.collapsed_sha256 == sha(collapsed)
