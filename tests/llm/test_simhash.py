"""Fingerprints, BK-trees and groups against brute force."""

import random

import xxhash

from tests.llm.helpers import awkward, documents
from wardflow.llm import simhash_trees


def slow_print(text, shingle=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in ["", None, "One", "a B c", "Ä ö A a", "a b c d e f g h", "a\tb\x0bc  d\n e"]:
        assert simhash_trees.fingerprint(text, 4) == slow_print(text)


def test_tree_finds_all_within_radius():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash_trees.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.within(q, 3)) == sorted({v for v in values if (v ^ q).bit_count() <= 3})


def brute_components(ids, prints, radius=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(root(i), []).append(x)
    return {root(i): min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(ids))}, root


def chained(spark):
    rng = random.Random(3)
    rows, value = [], 0
    for k in range(40):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows), value))
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randint(0, 63)
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in rows]
    return rows, spark.createDataFrame(signed, "doc_id bigint, fingerprint bigint")


def test_groups_are_brute_force(spark):
    rows, prints = chained(spark)
    want, root = brute_components([i for i, _ in rows], [v for _, v in rows])
    for size in (simhash_trees.TREE_SIZE, 2):
        got = {r["doc_id"]: r["component_id"] for r in simhash_trees.groups(prints, 4, size).collect()}
        assert got == {i: want[root(k)] for k, (i, _) in enumerate(rows)}


def test_awkward_rows(spark):
    docs = awkward(spark, extra=("fingerprint", "component_id"))
    rows = simhash_trees.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r["component_id"] for r in rows if r["fingerprint"] == 0} == {2}
    kept = simhash_trees.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 1, 2, 5, 6]
    assert [r["text"] for r in kept.collect() if r["doc_id"] is None] == ["A row without an id, but with some words."]
    assert simhash_trees.near_duplicates(docs.limit(0)).count() == 0


def test_copies_fall_together(spark):
    text = " ".join(f"word{i}" for i in range(400))
    near = text.replace("word7 ", "other ")
    docs = documents(spark, [(9, text), (4, text), (6, near), (1, "something else entirely written here")])
    got = {r["doc_id"]: r["component_id"] for r in simhash_trees.near_duplicates(docs).collect()}
    assert got == {9: 4, 4: 4, 6: 4, 1: 1}
