"""Pairs of items that occur together in one entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.aggregates import ordered_list
from wardflow.operators.ordered import Sizes, asc, group_totals, join_facts, ordered_window, running
from wardflow.operators.relational import left_null_safe, share_of_total
from wardflow.session import settle

BLOCK_ITEMS = 1000


def cooccurrence_pairs(
    df: DataFrame, entity: str, item: str, label: str, min_support: int = 2
) -> DataFrame:
    """Unordered item pairs with the number, share and list of entities that have both.

    Items found in fewer than `min_support` entities cannot be part of a supported pair and are
    dropped before pairing. The items of a large entity are cut into blocks of about 1000, so its
    pairs are made by many tasks.
    """
    known = F.col(item).isNotNull() & F.col(entity).isNotNull()
    things = settle(df.select(entity, item, label).filter(known).distinct())
    support = group_totals(things, [item, label], __support=F.count(F.lit(1)))
    frequent = support.filter(F.col("__support") >= min_support).drop("__support")
    # Both sides of the join below read this.
    sized = settle(group_totals(frequent, [entity], __items=F.count(F.lit(1))))
    blocks = F.ceil(F.col("__items") / BLOCK_ITEMS).cast("int")
    left = sized.select(
        F.col(entity).alias("__e"), F.col(item).alias("item_1"), F.col(label).alias("label_1"),
        F.pmod(F.xxhash64(item), blocks).cast("int").alias("__b"),
    )
    right = sized.select(
        F.col(entity).alias(entity), F.col(item).alias("item_2"), F.col(label).alias("label_2"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("__block"),
    )
    same = (F.col("__e") == F.col(entity)) & (F.col("__b") == F.col("__block"))
    pairs = left.join(right, same & (F.col("item_1") < F.col("item_2")))
    keys = ["item_1", "item_2", "label_1", "label_2"]
    # Counts first, without lists: by far the most pairs end here, summed up before they are shuffled.
    counted = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("support"))
    supported = settle(counted.filter(F.col("support") >= min_support))
    # Then the pairs are made again, and only the supported ones get a list.
    sizes = _supported_sizes(supported)
    named = join_facts(pairs, supported.select(*keys, F.lit(True).alias("__held")), keys, sizes, how="inner")
    lists = ordered_list(named, keys, [entity], F.col(entity), "entities", sizes)
    joined = share_of_total(left_null_safe(supported, lists, keys), prevalence="support")
    return joined.select(*keys, "support", "entities", "prevalence", F.xxhash64("item_1", "item_2").alias("pair_hash"))


def _supported_sizes(supported: DataFrame) -> Sizes:
    """How the rows of supported pairs fall to them: known from their support, without counting again."""
    row = supported.agg(F.sum("support"), F.count(F.lit(1)), F.max("support")).first()
    return Sizes(int(row[0] or 0), int(row[1] or 0), int(row[2] or 0))


def pair_rule_counts(
    df: DataFrame, entity: str, item: str, rules: list[tuple[Column, Column, str]], labels: list[str]
) -> DataFrame:
    """Per entity: number of row pairs (a, b) with a.item < b.item, in all and per rule label.

    A rule (left, right, label) fits when `left` holds for a and `right` for b; the first fit wins.
    No pair is built: rows are counted per item and per set of predicates they meet, items are put
    in order, and each item is multiplied with the running counts of the items before it.
    """
    n = 2 ** len(rules)

    def met(side: int) -> Column:
        bits = [F.when(rule[side], F.lit(2**i)).otherwise(F.lit(0)) for i, rule in enumerate(rules)]
        return sum(bits, F.lit(0))

    def label_of(left_bits: int, right_bits: int) -> str | None:
        for i, rule in enumerate(rules):
            if left_bits >> i & 1 and right_bits >> i & 1:
                return rule[2]
        return None

    marked = df.filter(F.col(item).isNotNull()).select(entity, item, met(0).alias("__l"), met(1).alias("__r"))
    counts = marked.groupBy(entity, item).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col("__l") == s).alias(f"__l{s}") for s in range(n)],
        *[F.count_if(F.col("__r") == s).alias(f"__r{s}") for s in range(n)],
    )
    before = ordered_window(
        settle(counts), [entity], [asc(item)],
        __upto=running("sum", F.col("__n")),
        **{f"__u{s}": running("sum", F.col(f"__l{s}")) for s in range(n)},
    )
    out = [F.sum(F.col("__n") * (F.col("__upto") - F.col("__n"))).alias("pair_count")]
    for label in labels:
        fits = [
            F.col(f"__r{r}") * (F.col(f"__u{s}") - F.col(f"__l{s}"))
            for s in range(n)
            for r in range(n)
            if label_of(s, r) == label
        ]
        out.append(F.sum(sum(fits, F.lit(0).cast("bigint"))).alias(label))
    return before.groupBy(entity).agg(*out)
