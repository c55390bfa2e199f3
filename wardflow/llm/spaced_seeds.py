"""Benchmark decontamination by spaced seeds: substitution-tolerant overlaps of texts with benchmark items."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import combinations, repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens in a compared window, and how many of them may differ.
WINDOW = 12
SUBSTITUTIONS = 2
#: A document is contaminated from this many covered tokens of one item on.
MIN_OVERLAP = 8
#: Benchmark text indexed at once; a larger benchmark is searched in several blocks, each a pass over the documents.
BLOCK_CHARS = 1 << 20

#: ASCII between tokens: all other than letters and digits.
_GAPS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Distinct further characters between tokens up to which they are replaced one by one.
MAX_REPLACED = 16
#: Scripts written without spaces, by the beginning of their characters' names; each letter is a token.
UNSPACED = (
    "CJK ", "HIRAGANA", "KATAKANA", "HALFWIDTH KATAKANA", "BOPOMOFO", "IDEOGRAPHIC", "KANGXI", "NUSHU", "TANGUT", "YI ",
    "THAI", "LAO ", "KHMER", "MYANMAR", "TAI ", "NEW TAI", "JAVANESE", "BALINESE",
)


@cache
def _kind(c: str) -> str:
    """Whether a character is in a "spaced" or an "unspaced" script, one of the "marks", or a "gap"."""
    kind = unicodedata.category(c)[0]
    if kind not in "LN":
        return "marks" if kind == "M" else "gap"
    return "unspaced" if unicodedata.name(c, "").startswith(UNSPACED) else "spaced"


def _ranges(codes: list[int]) -> str:
    """The inside of a character class that holds `codes`, ascending."""
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@cache
def _token() -> re.Pattern[str]:
    """A run of letters and digits, or one letter of an unspaced script, with the marks on them."""
    kinds: dict[str, list[int]] = {"spaced": [], "unspaced": [], "marks": [], "gap": []}
    for c in range(sys.maxunicode + 1):
        kinds[_kind.__wrapped__(chr(c))].append(c)
    spaced, unspaced, marks = (_ranges(kinds[k]) for k in ("spaced", "unspaced", "marks"))
    return re.compile(f"[{spaced}][{spaced}{marks}]*|[{unspaced}][{marks}]*")


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits; in scripts without spaces each letter. Marks belong to their letter."""
    lowered = (text or "").lower()
    if not lowered.isascii():
        special = {c: kind for c in set(lowered) if c > "\x7f" and (kind := _kind(c)) != "spaced"}
        if len(special) > MAX_REPLACED or any(kind != "gap" for kind in special.values()):
            return [t.encode("utf-8", "surrogatepass") for t in _token().findall(lowered)]
        for c in special:
            lowered = lowered.replace(c, " ")
    return lowered.encode("utf-8").translate(_GAPS).split()


def masks(window: int, substitutions: int) -> list[tuple[int, ...]]:
    """Token positions that each seed looks at.

    The window is cut into substitutions + 2 blocks and each mask looks at two of them. As at least two
    blocks are free of substitutions, every window within the tolerance is hit by some mask.
    """
    blocks = substitutions + 2
    edges = [i * window // blocks for i in range(blocks + 1)]
    parts = [tuple(range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [a + b for a, b in combinations(parts, 2)]


def _tolerance(window: int) -> int:
    return SUBSTITUTIONS * window // WINDOW


def _hash(ids: np.ndarray, starts: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hashes of what `mask` sees of the windows at `starts`."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in mask:
        out = (out ^ ids[starts + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Index:
    """Seeds of one block of the benchmark."""

    item_ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray  # where each item begins in `ids`
    ids: np.ndarray  # tokens of all items, one after another
    seeds: dict[int, list[tuple[tuple[int, ...], np.ndarray, np.ndarray]]]  # window -> mask, hashes, places


def build(items: list[tuple]) -> Index:
    """The index of (item_id, text); items without tokens match nothing.

    An item shorter than WINDOW is one window of its own length, with tolerance in proportion.
    """
    vocabulary: dict[bytes, int] = {}
    coded = [[vocabulary.setdefault(t, len(vocabulary) + 1) for t in tokens(text)] for _, text in items]
    starts = np.cumsum([0, *map(len, coded)])
    ids = np.array([x for item in coded for x in item], dtype=np.int64)
    places: dict[int, list[np.ndarray]] = {}
    for at, item in zip(starts, coded, strict=False):
        if item:
            width = min(WINDOW, len(item))
            places.setdefault(width, []).append(np.arange(at, at + len(item) - width + 1))
    seeds: dict[int, list] = {}
    for width, found in places.items():
        where = np.concatenate(found)
        for mask in masks(width, _tolerance(width)):
            hashes = _hash(ids, where, mask)
            order = np.argsort(hashes, kind="stable")
            seeds.setdefault(width, []).append((mask, hashes[order], where[order]))
    return Index([i for i, _ in items], vocabulary, starts, ids, seeds)


def search(text: str | None, index: Index) -> list[tuple[int, int, int]]:
    """(number of the item, item tokens covered, windows) for each item that overlaps the text.

    Windows of the text with enough benchmark words are hashed under each mask and looked up; each hit
    is verified by counting the tokens that differ.
    """
    words = tokens(text)
    ids = np.fromiter(map(index.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words))
    known = np.concatenate(([0], np.cumsum(ids != 0)))
    covered: dict[int, set[int]] = {}
    pairs: dict[int, int] = {}
    for width, seeds in index.seeds.items():
        if len(ids) < width:
            continue
        need = width - _tolerance(width)
        starts = np.flatnonzero(known[width:] - known[:-width] >= need)
        if not len(starts):
            continue
        hits = []
        for mask, hashes, places in seeds:
            seen = _hash(ids, starts, mask)
            low = np.searchsorted(hashes, seen, "left")
            count = np.searchsorted(hashes, seen, "right") - low
            if count.any():
                at = np.repeat(starts, count)
                first = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count)
                hits.append(np.stack([at, places[np.arange(count.sum()) + first]], axis=1))
        if not hits:
            continue
        found = np.unique(np.concatenate(hits), axis=0)
        steps = np.arange(width)
        same = (ids[found[:, :1] + steps] == index.ids[found[:, 1:] + steps]).sum(axis=1)
        for _, place in found[same >= need].tolist():
            item = int(np.searchsorted(index.starts, place, "right")) - 1
            covered.setdefault(item, set()).update(range(place, place + width))
            pairs[item] = pairs.get(item, 0) + 1
    return [(item, len(places), pairs[item]) for item, places in covered.items()]


def _limit(index: Index, item: int, short_items: bool) -> int:
    """Covered tokens from which on the item contaminates a document."""
    return min(MIN_OVERLAP, int(index.starts[item + 1] - index.starts[item])) if short_items else MIN_OVERLAP


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[Index]:
    """The benchmark, the stated query set, in blocks of a bounded size."""
    items = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    count = ceil(size / block_chars)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(count, 1)))
    for k in range(count):
        yield build([tuple(r) for r in items.filter(number == k).collect()])


def overlaps(
    docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS, short_items: bool = True
) -> DataFrame:
    """doc_id, item_id, covered, n_tokens, n_windows and contaminated for each document and item that overlap.

    Two windows of WINDOW tokens overlap if at most SUBSTITUTIONS tokens differ. `covered` counts the
    item's tokens in such windows, `n_windows` the pairs of windows, `n_tokens` all tokens of the item.
    A document is contaminated from MIN_OVERLAP covered tokens on; with `short_items`, the default, from all tokens of an
    item on that has fewer.
    Whole texts are read; documents are never shuffled. NULL and empty texts overlap nothing. Repeated
    documents or items give a row each; an empty table on either side gives an empty result; further
    columns are ignored.
    """
    spark = docs.sparkSession
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = (
        f"doc_id {kinds[0]}, item_id {kinds[1]}, covered bigint, n_tokens bigint, n_windows bigint, contaminated boolean"
    )
    rows = docs.select("doc_id", "text")
    names = ["doc_id", "item_id", "covered", "n_tokens", "n_windows", "contaminated"]
    found = []
    for index in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                out = [
                    (
                        doc_id.as_py(), index.item_ids[item], covered, int(index.starts[item + 1] - index.starts[item]),
                        n, covered >= _limit(index, item, short_items),
                    )
                    for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True)
                    for item, covered, n in search(text.as_py(), index)
                ]
                if out:
                    columns = [pa.array(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

        found.append(rows.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS, short_items: bool = True
) -> DataFrame:
    """The rows of `docs` that no benchmark item contaminates, as in `overlaps`, in place, with all their columns."""
    for index in _blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                keep = [
                    all(covered < _limit(index, item, short_items) for item, covered, _ in search(text.as_py(), index))
                    for text in batch.column("text")
                ]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
