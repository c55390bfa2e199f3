"""Periodic runs of words: Lyndon arrays from the first phase of a grouping suffix sorter, roots extended by LCE."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardflow.llm.common import byte_slices

#: A run repeats its period at least so many times, and has at least so many words.
REPEATS = 4
LEAST_WORDS = 6
#: Words of several documents that are sorted together, to spread the cost of a call; a longer text goes alone.
TOGETHER = 1 << 16
#: Bytes of texts taken from a batch at once.
BATCH_BYTES = 16 << 20
#: In a run every three words in a row stand at least three times; that follows from REPEATS and LEAST_WORDS.
GRAM, GRAM_TIMES = 3, 3

RESULT = T.StructType(
    [
        T.StructField("n_runs", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()),
        T.StructField("runs_sha256", T.StringType()),
        T.StructField("collapsed_sha256", T.StringType()),
    ]
)


def lyndon_array(letters: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by the grouping phase of suffix sorting.

    `letters` are numbers from 0 on; the end of the sequence is smaller than all. Suffixes start in one
    group per letter. Groups are visited from the highest down. The members of a group that is visited
    hold their whole Lyndon word; each hands it to the nearest earlier place of a lower group, whose
    word grows by it. Places that grow alike leave their group for a new one directly above it, those
    that got more copies higher up. Every place is handed on once, so the work is linear.
    """
    n = len(letters)
    if not n:
        return []
    top = max(letters) + 1
    members: list[list[int]] = [[] for _ in range(top)]
    for place, letter in enumerate(letters):
        members[letter].append(place)
    length = [1] * top
    # Neighbours in the order of groups; -1 ends the list below, `top` is above the highest.
    below = list(range(-1, top))
    above = list(range(1, top + 2))
    members.append([])
    length.append(0)
    group = list(letters)
    done = [False] * n
    before = [-1] * n
    found = [1] * n
    at = below[top]
    while at >= 0:
        size = length[at]
        grown: dict[tuple[int, int], list[int]] = {}
        target, copies = -1, 0
        for place in members[at]:
            if group[place] != at:
                continue  # has left for a higher group
            done[place] = True
            found[place] = size
            p = place - 1
            while p >= 0 and done[p]:
                p = before[p]
            before[place] = p
            # Members ascend, and so do the places they hand on to: equal ones are neighbours.
            if p == target:
                copies += 1
            else:
                if target >= 0:
                    grown.setdefault((copies, group[target]), []).append(target)
                target, copies = p, 1
        if target >= 0:
            grown.setdefault((copies, group[target]), []).append(target)
        members[at] = []
        for copies, old in sorted(grown, reverse=True) if len(grown) > 1 else grown:
            new = len(members)
            moved = grown[copies, old]
            members.append(moved)
            length.append(length[old] + copies * size)
            up = above[old]
            above[old], below[up] = new, new
            below.append(old)
            above.append(up)
            for place in moved:
                group[place] = new
        at = below[at]
    return found


class Extensions:
    """Longest common extensions of places in a sequence, exact: equal names mean equal stretches of 2^k letters."""

    def __init__(self, letters: np.ndarray) -> None:
        self.names = [letters.astype(np.int64)]
        n, step = len(letters), 1
        while 2 * step <= n:
            last = self.names[-1]
            pairs = last[: n - 2 * step + 1] * (n + 1) + last[step : n - step + 1]
            _, names = np.unique(pairs, return_inverse=True)
            self.names.append(names)
            if names.max() + 1 == len(names):
                break  # all stretches of this length differ, so all longer ones do
            step *= 2
        self.n = n

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal letters from the places a and b > a on."""
        same = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, step = self.names[k], 1 << k
            # More than once: the longest stretches named may be shorter than what is equal.
            while True:
                x, y = a + same, b + same
                fits = np.flatnonzero(y + step <= self.n)
                fits = fits[names[x[fits]] == names[y[fits]]]
                if not len(fits):
                    break
                same[fits] += step
                if k < len(self.names) - 1:
                    break
        return same

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal letters from the places a and b > a on, both included, backwards."""
        same = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, step = self.names[k], 1 << k
            while True:
                x, y = a - same - step + 1, b - same - step + 1
                fits = np.flatnonzero(x >= 0)
                fits = fits[names[x[fits]] == names[y[fits]]]
                if not len(fits):
                    break
                same[fits] += step
                if k < len(self.names) - 1:
                    break
        return same


def runs(letters: list[int], repeats: int = REPEATS, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs.

    Every run holds a Lyndon word of its period, under the order of letters or its reverse, that is the
    longest at its place; so the words of both Lyndon arrays, extended both ways, are all runs.
    """
    n = len(letters)
    if n < least:
        return np.empty((0, 3), dtype=np.int64)
    highest = max(letters)
    values = np.array(letters, dtype=np.int64)
    place = np.arange(n, dtype=np.int64)
    roots = []
    for ordered in (letters, [highest - x for x in letters]):
        period = np.array(lyndon_array(ordered), dtype=np.int64)
        end = place + period
        # A root whose next letter and whose last letter both fail to repeat is extended by nothing.
        after = (end < n) & (values[np.minimum(end, n - 1)] == values)
        ahead = np.concatenate(([False], values[end[1:] - 1] == values[:-1]))
        fit = (period * repeats <= n) & (after | ahead)
        roots.append(np.stack([place[fit], period[fit]], axis=1))
    pairs = np.unique(np.concatenate(roots), axis=0)
    if not len(pairs):
        return np.empty((0, 3), dtype=np.int64)
    a, period = pairs[:, 0], pairs[:, 1]
    extend = Extensions(values)
    left = extend.left(a - 1, a + period - 1)
    length = left + period + extend.right(a, a + period)
    whole = length >= np.maximum(least, repeats * period)
    return np.unique(np.stack([a - left, length, period], axis=1)[whole], axis=0)


def _stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [from, to) of hashed words that may hold runs; outside of them there is none for certain.

    In a run every three words in a row stand three times, so places where a triple is rarer cut the
    sequence, and so they do again within each part. Triples are counted in a table by their hash: what
    shares a field only makes a count too large.
    """
    ready, todo = [], [(0, len(words))]
    while todo:
        at, to = todo.pop()
        if to - at < LEAST_WORDS:
            continue
        w = words[at:to]
        triple = (w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
        bits = max(6, int(to - at).bit_length() + 2)
        field = ((triple ^ (triple >> np.uint64(29))) * np.uint64(0x165667B19E3779F9) >> np.uint64(64 - bits)).astype(np.int64)
        often = np.bincount(field, minlength=1 << bits)[field] >= GRAM_TIMES
        if often.all():
            ready.append((at, to))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], often, [False])).view(np.int8)))
        todo.extend((at + int(a), at + int(b) + GRAM - 1) for a, b in edges.reshape(-1, 2))
    return sorted(ready)


class Document:
    """Words of one document, its stretches worth a search, and the runs found in them."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        hashed = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
        self.stretches = _stretches(hashed) if len(words) >= LEAST_WORDS else []
        self.runs: list[tuple[int, int, int]] = []

    def result(self) -> tuple:
        """The columns of RESULT."""
        listed = hashlib.sha256()
        kept, best = bytearray(b"\x01") * len(self.words), None
        for start, length, period in sorted(self.runs, key=lambda r: (r[0], r[2])):
            listed.update(b"%d,%d,%d\n" % (start, length, period))
            kept[start + period : start + length] = bytes(length - period)
            if best is None or length * best[2] > best[1] * period:
                best = (start, length, period)
        words = [w for w, k in zip(self.words, kept, strict=True) if k] if self.runs else self.words
        digest = hashlib.sha256(b" ".join(words)).hexdigest()
        shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        return (len(self.runs), *shown, listed.hexdigest(), digest)


def _search(documents: list[Document]) -> None:
    """Finds the runs of all documents at once: their stretches in a row, parted by letters that stand once."""
    names: dict[bytes, int] = {}
    letters: list[int] = []
    pieces = []
    for document in documents:
        for at, to in document.stretches:
            pieces.append((len(letters), document, at))
            letters.extend([names.setdefault(w, len(names)) for w in document.words[at:to]])
            # Longer than any word, so it equals none.
            letters.append(names.setdefault(b" %d" % len(letters), len(names)))
    if not pieces:
        return
    firsts = np.array([at for at, _, _ in pieces])
    for start, length, period in runs(letters).tolist():
        at, document, offset = pieces[int(np.searchsorted(firsts, start, side="right")) - 1]
        document.runs.append((start - at + offset, length, period))


def summaries(texts: list[bytes], spoil=None, keys=None) -> list[tuple]:
    """The columns of RESULT for each text; `spoil(words, key)` may change its words beforehand."""
    done, waiting, held = [], [], 0
    for k, text in enumerate(texts):
        words = text.split()  # bytes: parted at blank, tab, line feed, vertical tab, form feed, carriage return
        document = Document(spoil(words, keys[k]) if spoil else words)
        done.append(document)
        size = sum(to - at for at, to in document.stretches)
        if size:
            waiting.append(document)
            held += size
            if held >= TOGETHER:
                _search(waiting)
                waiting, held = [], 0
    _search(waiting)
    return [document.result() for document in done]


def repeat_tail(words: list[bytes], doc_id) -> list[bytes]:
    """The planted periods of the digest query: in a tenth of the documents the words from a place on repeat."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def word_runs(docs: DataFrame, text: str = "text", spoil=None, key: str | None = None) -> DataFrame:
    """`docs` without its text, with the periodic runs of words of the whole text: the columns of RESULT.

    Words stand between ASCII white space and are numbered from 0. A run is a stretch with smallest
    period q of at least max(6, 4 q) words that no neighbouring word extends. Shown is the run with the
    greatest quotient of length and period, of equal ones the first, then the shortest period; NULLs if
    there is none. runs_sha256 digests all runs, collapsed_sha256 the words without those that a run
    repeats. A NULL or blank text has no words and no runs. Each row is judged by itself: repeated rows
    give repeated results, an empty table none. Columns of `docs` with names of results are replaced.
    `spoil(words, value of key)` may change the words before the search. Nothing is shuffled; memory is
    that of the longest text, times the logarithm of its periodic part.
    """
    names = [f.name for f in RESULT]
    rest = [c for c in docs.columns if c not in (text, *names)]
    schema = T.StructType([*[docs.schema[c] for c in rest], *RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, text, BATCH_BYTES):
            keys = part.column(key).to_pylist() if key else None
            found = summaries([t or b"" for t in part.column(text).cast(pa.binary()).to_pylist()], spoil, keys)
            made = [
                pa.array([row[k] for row in found], pa.string() if name.endswith("sha256") else pa.int64())
                for k, name in enumerate(names)
            ]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *made], [*rest, *names])

    return docs.select(*rest, text).mapInArrow(run, schema)
