"""Lyndon arrays and runs of words against brute force."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import awkward, documents
from wardflow.llm import word_runs


def slow_lyndon(w):
    def lyndon(x):
        return all(x < x[k:] for k in range(1, len(x)))

    return [max(k for k in range(1, len(w) - i + 1) if lyndon(w[i : i + k])) for i in range(len(w))]


def slow_runs(w, repeats=4, least=6):
    """All (start, length, period): stretches with a period that no neighbour extends, with no smaller period."""
    found, n = [], len(w)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, repeats * q):
                part = w[i : i + size]
                if not any(part[:-d] == part[d:] for d in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return [k.bit_count() & 1 for k in range(n)]


words = st.lists(st.integers(0, 3), max_size=30)
repetitive = st.builds(
    lambda a, x, k, b: a + x * k + x[: len(x) // 2] + b, words, st.lists(st.integers(0, 2), min_size=1, max_size=5),
    st.integers(1, 9), words,
)


@settings(max_examples=300, deadline=None)
@given(words | repetitive)
def test_lyndon_array(w):
    dense = [sorted(set(w)).index(x) for x in w]
    assert word_runs.lyndon_array(dense) == slow_lyndon(w)


@settings(max_examples=400, deadline=None)
@given(words | repetitive)
def test_runs(w):
    assert [tuple(r) for r in word_runs.runs(w).tolist()] == slow_runs(w)
    # The plain definition of runs, with two repetitions.
    assert [tuple(r) for r in word_runs.runs(w, repeats=2, least=2).tolist()] == slow_runs(w, 2, 2)


def test_runs_of_known_sequences():
    for w in (fibonacci(400), thue_morse(512), [0] * 300, [0, 1] * 150, list(range(300)), list(range(300))[::-1]):
        assert [tuple(r) for r in word_runs.runs(w, 2, 2).tolist()] == slow_runs(w, 2, 2)
        assert [tuple(r) for r in word_runs.runs(w).tolist()] == slow_runs(w)


def test_extensions():
    rng = random.Random(5)
    w = np.array([rng.randrange(2) for _ in range(60)] * 3)
    made = word_runs.Extensions(w)
    a = np.array([i for i in range(len(w)) for j in range(i + 1, len(w))])
    b = np.array([j for i in range(len(w)) for j in range(i + 1, len(w))])
    for i, j, right, left in zip(a, b, made.right(a, b), made.left(a, b), strict=True):
        assert right == next((k for k in range(len(w) - j) if w[i + k] != w[j + k]), len(w) - j)
        assert left == next((k for k in range(i + 1) if w[i - k] != w[j - k]), i + 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(repetitive | words, min_size=1, max_size=5))
def test_stretches_lose_no_run(parts):
    text = [b"w%d" % x for p in parts for x in p]
    document = word_runs.Document(text)
    for start, length, _ in slow_runs(text):
        assert any(a <= start and start + length <= b for a, b in document.stretches)


def slow_row(doc_id, text, spoil=True):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if spoil and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = slow_runs(w)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def rows_of(df):
    return [(r["doc_id"], *[r[f.name] for f in word_runs.RESULT]) for r in df.collect()]


def test_documents(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        n = rng.choice([0, 1, 5, 6, 20, 80, 200])
        text = [f"w{rng.randrange(rng.choice([2, 30]))}" for _ in range(n)]
        rows.append((i, rng.choice([" ", "\n", "\t\x0b"]).join(text)))
    rows += [(9_000, "a b " * 12 + "c d e " * 9 + "f"), (9_001, "é ü " * 8), (9_002, "x" + " x" * 9)]
    docs = documents(spark, rows)
    found = rows_of(word_runs.word_runs(docs, spoil=word_runs.repeat_tail, key="doc_id"))
    assert sorted(found) == sorted((i, *slow_row(i, t)) for i, t in rows)
    plain = rows_of(word_runs.word_runs(docs))
    assert sorted(plain) == sorted((i, *slow_row(i, t, spoil=False)) for i, t in rows)


def test_many_documents_at_once():
    # More words than are searched together: results do not depend on the grouping.
    texts = [b" ".join(b"%d" % (k % (i + 1)) for k in range(4_000)) for i in range(40)]
    assert word_runs.summaries(texts) == [word_runs.summaries([t])[0] for t in texts]


def test_long_periodic_text():
    w = b" ".join(b"w%d" % (k % 50_000) for k in range(300_000))
    (row,) = word_runs.summaries([w])
    assert row[:5] == (1, 0, 300_000, 50_000, 6_000)
    (row,) = word_runs.summaries([b"one " * 300_000])
    assert row[:5] == (1, 0, 300_000, 1, 300_000_000)
    assert row[6] == hashlib.sha256(b"one").hexdigest()


def test_awkward_rows(spark):
    docs = awkward(spark, extra=("n_runs", "period"))
    found = word_runs.word_runs(docs.select("doc_id", "text", "n_runs", "period"), spoil=word_runs.repeat_tail, key="doc_id")
    assert found.columns == ["doc_id", *[f.name for f in word_runs.RESULT]]
    expected = [(r["doc_id"], *slow_row(r["doc_id"], r["text"])) for r in docs.collect() if len(r["text"] or "") < 50_000]
    got = rows_of(found)
    assert len(got) == docs.count() and all(row in got for row in expected)
    assert word_runs.word_runs(documents(spark, [])).collect() == []
