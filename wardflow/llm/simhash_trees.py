"""SimHash near-duplicates: fingerprints, sharded BK-trees, linked groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import join_by_key
from wardflow.session import settle

BITS = 64
HASH_SEED = 42
#: Fingerprints in one tree; larger shards are cut into several trees that each query visits in turn.
TREE_SIZE = 4096
#: Shingles hashed at once, to bound the memory of one long text.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in more than half of the shingle hashes; 0 for a text without words."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(spans), CHUNK):
        part = b"".join([digest(line[a:b], HASH_SEED) for a, b in spans[at : at + CHUNK]])
        ones += np.unpackbits(np.frombuffer(part, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(ones * 2 > len(spans))
    return int.from_bytes(set_bits.tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, out: str = "fingerprint") -> DataFrame:
    """`docs` without its text and with a signed 64-bit fingerprint of the whole text."""
    rest = [c for c in docs.columns if c not in (text, out)]
    schema = T.StructType([*[docs.schema[c] for c in rest], T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text)], dtype=np.uint64)
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], [*rest, out])

    return docs.select(*rest, text).mapInArrow(run, schema)


class BKTree:
    """Children keyed by their integer Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        """Hangs the value below the node where its distance has no edge yet; equal values are not kept twice."""
        if self.values:
            at = 0
            while d := (self.values[at] ^ value).bit_count():
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = len(self.values)
                    break
                at = below
            else:
                return
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Values at most `radius` away; only edges in [d - radius, d + radius] are followed."""
        stack = [0] if self.values else []
        values, children = self.values, self.children
        while stack:
            at = stack.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                yield values[at]
            for edge, child in children[at].items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)


def tree_links(tree_rows: list[int], query_rows: list[int] | None, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what lies within `radius`, one per merge of two groups, never all pairs.

    Without `query_rows` the tree's own rows are linked with each other.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    tree = BKTree()
    if query_rows is not None:
        for value in tree_rows:
            tree.add(value)
    for value in tree_rows if query_rows is None else query_rows:
        for other in tree.within(value, radius):
            a, b = root(value), root(other)
            if a != b:
                parent[a] = b
                yield value, other
        if query_rows is None:
            tree.add(value)


def _block_masks(radius: int) -> list[int]:
    """Masks of two blocks each: of radius + 2 blocks, at least two are free of the differing bits."""
    blocks = radius + 2
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(one, 2)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def links(prints: DataFrame, radius: int, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links (a, b) between distinct fingerprints of `prints`, enough to connect all within `radius` bits.

    Two fingerprints within the radius agree on two whole blocks, so they meet in a shard keyed by these
    blocks. Each shard gets a BK-tree; a shard of more than `tree_size` is cut into several trees, and
    each of its fingerprints visits all of them, in units of one tree and one part of the queries.
    """
    masks = [_signed(m) for m in _block_masks(radius)]
    value = F.col("fingerprint")
    sharded = prints.select(
        value, F.posexplode(F.array(*[value.bitwiseAND(F.lit(m)) for m in masks])).alias("table", "shard")
    )
    large = settle(
        sharded.groupBy("table", "shard")
        .count()
        .filter(F.col("count") > tree_size)
        .select("table", "shard", F.ceil(F.col("count") / tree_size).cast("int").alias("parts"))
    )
    one = F.lit(0)
    if large.isEmpty():
        units = sharded.withColumns({"tree": one, "query": one})
    else:
        # Shards above the size number at most rows / tree_size; Spark broadcasts them if they are small.
        placed = sharded.join(large, ["table", "shard"], "left").withColumns(
            {"parts": F.coalesce("parts", F.lit(1))}
        ).withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
        every = F.explode(F.sequence(one, F.col("parts") - 1))
        units = placed.withColumn("other", every).select(
            "fingerprint",
            "table",
            "shard",
            F.least("part", "other").alias("tree"),
            F.greatest("part", "other").alias("query"),
            (F.col("part") > F.col("other")).alias("asks"),
        )
    if "asks" not in units.columns:
        units = units.withColumn("asks", F.lit(False))
    keys = ["table", "shard", "tree", "query"]
    dealt = units.repartition(*keys).sortWithinPartitions(*keys, "asks", "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_groups(batches, keys):
            found = []
            for at, to in block["groups"]:
                values = block["values"][at:to]
                asks = block["asks"][at:to]
                if asks[-1] and not asks[0]:
                    cut = asks.index(True)
                    found.extend(tree_links(values[:cut], values[cut:], radius))
                elif not asks[0]:
                    found.extend(tree_links(values, None, radius))
            if found:
                pairs = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict]:
    """Groups of two or more rows out of sorted batches; a group that runs into the next batch is held."""
    held: pa.Table | None = None

    def parted(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        n = table.num_rows
        change = np.zeros(n, dtype=bool)
        change[0] = True
        for k in keys:
            column = table.column(k).to_numpy()
            change[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(change)
        return starts, np.append(starts[1:], n)

    def block(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> dict:
        many = ends - starts > 1
        return {
            "groups": list(zip(starts[many].tolist(), ends[many].tolist(), strict=True)),
            "values": table.column("fingerprint").to_numpy().view(np.uint64).tolist(),
            "asks": table.column("asks").to_pylist(),
        }

    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        table = new if held is None else pa.concat_tables([held, new])
        starts, ends = parted(table)
        held = table.slice(int(starts[-1]))
        if len(starts) > 1:
            yield block(table.slice(0, int(starts[-1])), starts[:-1], ends[:-1])
    if held is not None:
        starts, ends = parted(held)
        yield block(held, starts, ends)


def connect(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), by alternating large and small stars.

    Each round is written to the shared folder. Hubs are handled by `join_by_key`.
    """

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(pairs: DataFrame) -> DataFrame:
        least = settle(pairs.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        return join_by_key(pairs, least, "a", "n").withColumn("m", F.least("a", "m"))

    now = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (seen := state(now)) != before:
        before = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = settle(
            star(both).filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        below = star(large)
        now = settle(
            below.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(below.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def groups(prints: DataFrame, radius: int = 4, tree_size: int = TREE_SIZE) -> DataFrame:
    """Settled `prints` (doc_id, fingerprint, ...) with component_id, the smallest doc_id reachable.

    Equal fingerprints are one node. NULL ids take part but name no group: a group of NULL ids only has
    a NULL component_id. The column root, a fingerprint, tells such groups apart.
    """
    nodes = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    edges = settle(links(nodes.select("fingerprint"), radius, tree_size))
    if edges.isEmpty():
        return join_by_key(
            prints, nodes.withColumns({"root": F.col("fingerprint"), "component_id": F.col("first")}).drop("first"),
            "fingerprint", "n",
        )
    rooted = settle(
        nodes.join(connect(edges).withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
            "root", F.coalesce("root", "fingerprint")
        )
    )
    smallest = settle(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("k")))
    named = settle(join_by_key(rooted.drop("first"), smallest, "root", "k"))
    return join_by_key(prints, named, "fingerprint", "n")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, tree_size: int = TREE_SIZE
) -> DataFrame:
    """doc_id, fingerprint, component_id and root per row of `docs` (doc_id, text).

    Whole texts are hashed; A-Z is lower-cased. A NULL or empty text has fingerprint 0 and links like any
    other. Repeated rows stay, each with the same group. An empty table gives an empty result; further
    columns of `docs` are ignored.
    """
    prints = settle(fingerprints(docs.select("doc_id", "text"), "text", shingle))
    return groups(prints, radius, tree_size)


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of `docs` for each group, one with the smallest doc_id, with the columns of `docs`.

    A group of NULL ids only keeps one of its rows. Where an id is repeated, its rows are told apart by
    their fingerprints.
    """
    found = settle(near_duplicates(docs, shingle, radius))
    per_id = settle(
        found.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("doc_id") == F.col("component_id")).alias("first"))
    )
    # Ids kept grow with the table: one way at every size.
    first = per_id.filter("n = 1 AND first").select("doc_id").hint("merge")
    kept = docs.join(first, "doc_id", "left_semi").select(docs.columns)
    repeated = per_id.filter("n > 1").select("doc_id")
    odd = [docs.filter("doc_id IS NULL")] if not found.filter("doc_id IS NULL").isEmpty() else []
    odd += [docs.join(repeated, "doc_id", "left_semi").select(docs.columns)] if not repeated.isEmpty() else []
    for rows in odd:
        printed = fingerprints(rows.select(F.struct(*docs.columns).alias("row"), "text"), "text", shingle)
        named = found.select("fingerprint", "root", "component_id").distinct()
        first = printed.join(named, "fingerprint").filter(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
        kept = kept.unionByName(first.dropDuplicates(["root"]).select("row.*"))
    return kept
