"""Line dedup by an exact set-similarity join: rarity order, prefix, position, length and bitmap filters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import SPACE, Scratch, brief_shuffles, join_by_key, let
from wardflow.session import settle

SHINGLE = 5
SIMILARITY = 0.8
#: Token counts are kept per bucket; tokens of a rare bucket come first in the order.
BUCKETS = 1 << 16
#: Narrow rows, of 24 bytes or so, that may be broadcast; a larger relation is joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Sets of one token in one unit of comparison; a token of more sets is split into several units.
UNIT_ROWS = 500
#: Wanted lines are looked up in this many bits, in blocks of BLOCK_BITS, before lines are shuffled: 2 MB at every size.
PLACE_BITS = 1 << 24
BLOCK_BITS = 1 << 15
#: Sets of as many tokens or more count as that large where sizes are packed.
LARGEST = (1 << 21) - 1
#: Pairs are compared by the tokens of one class in so many before all tokens travel.
PARTS = 4

#: Dictionaries do not shorten hashes.
HASHES = {"parquet.enable.dictionary": "false"}

LINE = ["doc_id", "version", "pos"]


def _plain(line: Column) -> Column:
    """The words of a line with one blank between them."""
    line = F.coalesce(line, F.lit(""))
    outer = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    odd = outer | F.contains(line, F.lit("  ")) | line.rlike(r"[\x09-\x0D]")
    return F.when(odd, F.trim(F.regexp_replace(line, SPACE, " "))).otherwise(line)


def _tokens(plain: Column, size: int) -> Column:
    """Distinct 32-bit hashes of `size` words in a row; a shorter line is one shingle.

    A match is looked up ahead and steps over one word, so that matches overlap.
    """
    word = "[^ ]+"
    found = F.regexp_extract_all(plain, F.lit(rf"\G(?=({' '.join([word] * size)}|^[\s\S]+)){word} ?"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda s: F.shiftright(F.xxhash64(s), 32).cast("int")))


def line_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per line of `docs` (doc_id, text): its place, its token set and a 128-bit name of its words.

    Tokens are hashes of word shingles. Lines without words have an empty set.
    """
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.posexplode_outer(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"),
    ).select(*LINE, _plain(F.col("line")).alias("plain"))
    names = [F.xxhash64("plain").alias("h1"), F.xxhash64(F.lit(1), "plain").alias("h2")]
    return lines.select(*LINE, _tokens(F.col("plain"), shingle).alias("tokens"), *names)


def _levels(lines: DataFrame) -> Column:
    """Literal array: for each token bucket, the logarithm of how many tokens of all lines fall into it."""
    tokens = lines.select(F.explode("tokens").alias("t"))
    counts = tokens.groupBy(_bucket(F.col("t")).alias("b")).count()
    level = ["0"] * BUCKETS
    for row in counts.collect():  # one row per bucket
        level[row["b"]] = str(int(math.log2(row["count"] + 1)))
    return F.split(F.lit(",".join(level)), ",").cast("array<bigint>")


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit(BUCKETS - 1))


def _ceil(x: Column) -> Column:
    """Rounded up; whole numbers that floating point overshoots by a hair stay as they are."""
    return F.ceil(x - 1e-9).cast("int")


def _ordered(tokens: Column, levels: Column) -> Column:
    """Tokens in the order of rarity, each with its level above its 32 bits; never NULL, so that they sort as numbers."""
    return F.sort_array(
        F.transform(
            tokens,
            lambda t: F.coalesce(
                F.shiftleft(F.get(levels, _bucket(t)), 32) + t.cast("bigint"), F.lit(0).cast("bigint")
            ),
        )
    )


def _prefix(ordered: Column, similarity: float) -> Column:
    """First tokens in the order of rarity; two similar sets share one of theirs."""
    size = F.size(ordered)
    first = F.slice(ordered, F.lit(1), size - _ceil(F.lit(similarity) * size) + 1)
    return F.transform(first, lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))


def _bitmap(tokens: Column) -> Column:
    """Which of 64 classes of tokens a set holds; a shift by n is one by n modulo 64."""
    one = F.lit(1).cast("bigint")
    return F.aggregate(
        tokens,
        F.lit(0).cast("bigint"),
        lambda bits, t: bits.bitwiseOR(F.call_function("shiftleft", one, F.shiftright(t, 16))),
    )


def distinct_sets(lines: DataFrame, similarity: float) -> DataFrame:
    """One row per distinct line: first (its earliest place), m (the size of its set), the set's prefix and bitmap."""
    # `ordered` is read three times, so Spark computes it in a step of its own, where its sort is compiled.
    ordered = lines.filter(F.size("tokens") > 0).select(
        "h1", "h2", F.struct(*LINE).alias("line"), "tokens", _ordered(F.col("tokens"), _levels(lines)).alias("ordered")
    )
    named = ordered.select(
        "h1",
        "h2",
        "line",
        F.size("ordered").alias("m"),
        _bitmap(F.col("tokens")).alias("bits"),
        _prefix(F.col("ordered"), similarity).alias("prefix"),
    )
    same = [F.first(c).alias(c) for c in ("m", "bits", "prefix")]
    # Grouping needs this order anyway; stated here, the rows carry their prefix through it whatever the optimizer merges.
    sets = named.sortWithinPartitions("h1", "h2").groupBy("h1", "h2").agg(F.min("line").alias("first"), *same)
    return sets.drop("h1", "h2").withColumn("id", F.monotonically_increasing_id())


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _fits(low: Column, high: Column, rest: Column, apart: Column, similarity: float) -> Column:
    """Length, position and bitmap filters for two sets of sizes `low` and `high` that share a token.

    Besides the token at most `rest` more of either set, counted with it, are shared. Each of the `apart` bits in
    which the bitmaps differ stands for a token that only one of the sets holds.
    """
    need = _ceil(F.lit(similarity / (1 + similarity)) * (low + high))
    return (low >= F.lit(similarity) * high - 1e-9) & (rest >= need) & (apart <= low + high - 2 * need)


def _may_match(similarity: float) -> Column:
    """The filters for postings a and b of one token, which sits at places a.i and b.i of the order."""
    rest = F.least(F.col("a.m") - F.col("a.i"), F.col("b.m") - F.col("b.i"))
    apart = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
    return _fits(F.least("a.m", "b.m"), F.greatest("a.m", "b.m"), rest, apart, similarity)


def shared_tokens(places: DataFrame, similarity: float) -> DataFrame:
    """Tokens that several sets have in their prefix, and how many (n).

    Of tokens of two sets, by far the most of them, those go whose sets can't match. Size, place and half the bitmap
    of a set travel as one number, so that the least and the greatest of a token are those of its two sets.
    """
    size, place = F.least("m", F.lit(LARGEST)).cast("bigint"), F.least("i", F.lit(1023)).cast("bigint")
    half = F.col("bits").bitwiseAND(F.lit((1 << 32) - 1))
    packed = places.select("token", (F.shiftleft(size, 42) + F.shiftleft(place, 32) + half).alias("set"))
    counts = packed.groupBy("token").agg(F.count("set").alias("n"), F.min("set").alias("a"), F.max("set").alias("b"))
    low, high = (F.shiftright(x, 42) for x in "ab")
    rest = F.least(*[F.shiftright(x, 42) - F.shiftright(x, 32).bitwiseAND(F.lit(1023)) for x in "ab"])
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(F.lit((1 << 32) - 1)))
    pair = (high == LARGEST) | _fits(low, high, rest, apart, similarity)
    return counts.filter((F.col("n") > 2) | ((F.col("n") == 2) & pair)).select("token", "n")


def _maybe_at(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """`lines` without most that stand at no place of `wanted`: places are looked up in a bitmap of a fixed size."""
    name = F.pmod(F.xxhash64(*LINE), F.lit(PLACE_BITS))
    bit = name.bitwiseAND(F.lit(BLOCK_BITS - 1))
    block = F.floor(name / BLOCK_BITS).cast("int")
    blocks = wanted.groupBy(block.alias("__block")).agg(F.bitmap_construct_agg(bit).alias("__bitmap"))
    looked = lines.withColumn("__bit", bit).join(F.broadcast(blocks), block == F.col("__block"))
    byte = F.conv(F.hex(F.substring("__bitmap", F.shiftright("__bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, F.col("__bit").bitwiseAND(F.lit(7)).cast("int")) == 1
    return looked.filter(held).drop("__bit", "__block", "__bitmap")


def _verified(pairs: DataFrame, sets: DataFrame, lines: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Ids x of the settled distinct pairs (x, y) of sets that have the similarity."""
    brief = Scratch(lines.sparkSession)
    ids = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct()
    wanted = brief.settle(ids.join(sets, "id").select("id", *[F.col(f"first.{c}").alias(c) for c in LINE]))
    maybe = _maybe_at(lines.select(*LINE, "tokens"), wanted)
    same = maybe["doc_id"].eqNullSafe(wanted["doc_id"]) & (maybe["version"] == wanted["version"])
    tokens = maybe.join(wanted, same & (maybe["pos"] == wanted["pos"])).select("id", "tokens")
    # A row of the table that is repeated has its lines repeated.
    part = F.filter("tokens", lambda t: t.bitwiseAND(F.lit(PARTS - 1)) == 0)
    tokens = brief.settle(tokens.dropDuplicates(["id"]).withColumn("m", F.size("tokens")).withColumn("part", part), HASHES)

    def joined(pairs: DataFrame, kept: str) -> DataFrame:
        x = tokens.select(F.col("id").alias("x"), F.col("m").alias("mx"), F.col(kept).alias("tx"))
        y = tokens.select(F.col("id").alias("y"), F.col("m").alias("my"), F.col(kept).alias("ty"))
        return pairs.join(x, "x").join(y, "y")

    # Similar sets differ in few tokens, so in no more of any class; most pairs differ in more of one class already.
    apart = F.size("tx") + F.size("ty") - 2 * F.size(F.array_intersect("tx", "ty"))
    sizes = F.col("mx") + F.col("my")
    most = sizes - 2 * _ceil(F.lit(similarity / (1 + similarity)) * sizes)
    near = brief.settle(joined(pairs, "part").filter(apart <= most).select("x", "y"))
    shared = F.size(F.array_intersect("tx", "ty"))
    found = joined(near, "tokens").filter(shared >= F.lit(similarity) * (sizes - shared) - 1e-9)
    ids = scratch.settle(found.select(F.col("x").alias("id")).distinct())
    brief.clear()
    return ids


def later_matches(lines: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Ids of the settled `sets` that are similar to one which occurs earlier."""
    first, second = Scratch(lines.sparkSession), Scratch(lines.sparkSession)
    places = sets.select("id", "m", "bits", F.posexplode("prefix").alias("i", "token"))
    counts = first.settle(shared_tokens(places, similarity))
    # Tokens of one set only, by far the most, need no comparison. The way is the same at every size, and so is its growth.
    flagged = counts.withColumn("size", F.col("n"))
    shared = join_by_key(places.drop("m", "bits"), flagged, "token", "n").filter("size IS NOT NULL")
    shared = first.settle(shared.withColumnRenamed("size", "n"))
    whole = F.struct("first", "id", "m", "i", "bits").alias("a")
    postings = second.settle(shared.join(sets.drop("prefix"), "id").select("token", "n", whole))
    first.clear()

    # Near copies mostly match the earliest set that has a token in common; those need no other partner.
    heads = first.settle(postings.groupBy("token").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("k")))
    to_head = join_by_key(postings.drop("n"), heads, "token", "k").filter("a.id <> b.id").filter(_may_match(similarity))
    pairs = second.settle(to_head.select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).distinct())
    first.clear()
    matched = _verified(pairs, sets, lines, similarity, scratch)

    # The others meet all earlier sets of their tokens, in units of bounded size.
    units = F.ceil(F.col("n") / UNIT_ROWS).cast("int")
    earlier = postings.select("token", F.explode(F.sequence(F.lit(0), units - 1)).alias("unit"), F.col("a").alias("b"))
    left = postings.withColumn("id", F.col("a.id")).join(_small(matched), "id", "left_anti")
    probes = left.select("token", F.pmod(F.xxhash64("id"), units).cast("int").alias("unit"), "a")
    meet = probes.join(earlier, ["token", "unit"]).filter((F.col("b.first") < F.col("a.first")) & _may_match(similarity))
    pairs = first.settle(meet.select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).distinct())
    second.clear()
    rest = _verified(pairs, sets, lines, similarity, scratch)
    first.clear()
    return matched.union(rest)


def _kept_text(text: Column, kept: Column) -> Column:
    """The lines at the sorted places `kept`, and those without words."""
    flags = F.flatten(
        F.transform(
            kept,
            lambda p, k: F.concat(
                F.array_repeat(F.lit(False), p - F.coalesce(F.get(kept, k - 1), F.lit(-1)) - 1), F.array(F.lit(True))
            ),
        )
    )
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return let(
        flags,
        lambda f: F.filter(
            lines, lambda line, k: F.coalesce(F.get(f, k), F.lit(False)) | ~line.rlike(r"[^\x20\x09-\x0D]")
        ),
    )


def dedup_lines(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, text: str = "text"
) -> DataFrame:
    """`docs` with `text` cut to the lines that repeat no earlier line, and with n_lines and n_removed.

    Lines are compared as sets of word shingles. In the order of (doc_id, text version, place), NULL ids
    first, a line goes if an earlier line, itself kept or not, has Jaccard similarity of at least
    `similarity`. Lines without words stay. A NULL text becomes an empty one. Rows that repeat both
    doc_id and text are one document and end up alike; equal ids with different texts are told apart.
    An empty table gives an empty result. Columns of `docs` stay; n_lines and n_removed are replaced.
    """
    scratch = Scratch(docs.sparkSession)
    with brief_shuffles(docs.sparkSession):
        lines = scratch.settle(line_sets(docs.select("doc_id", F.col(text).alias("text")), shingle), HASHES)
        sets = scratch.settle(distinct_sets(lines, similarity))
        gone = later_matches(lines, sets, similarity, scratch)
        firsts = sets.join(gone, "id", "left_anti").select("first.*")
        kept = firsts.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list("pos")).alias("__kept"))
        kept = settle(kept.select(F.col("doc_id").alias("__doc"), F.col("version").alias("__same"), "__kept"))
    scratch.clear()
    own = docs.drop("n_lines", "n_removed").withColumn("__version", F.xxhash64(text))
    joined = own.join(kept, own["doc_id"].eqNullSafe(kept["__doc"]) & (own["__version"] == kept["__same"]), "left")
    cut = joined.withColumn("__lines", _kept_text(F.col(text), F.coalesce("__kept", F.array().cast("array<int>"))))
    total = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    return (
        cut.withColumn("n_lines", total.cast("bigint"))
        .withColumn("n_removed", (total - F.size("__lines")).cast("bigint"))
        .withColumn(text, F.array_join("__lines", "\n"))
        .drop("__version", "__doc", "__same", "__kept", "__lines")
    )
