from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from wardflow.operators import pairs as P


def baskets(spark):
    """40 entities over 25 items; entity 0 has every item, and rows repeat."""
    return spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("e"),
        F.concat(F.lit("i"), F.lpad((F.col("id") * 7 % 25).cast("string"), 2, "0")).alias("item"),
        (F.col("id") % 2).alias("route"),
    ).withColumn("lab", F.substring("item", 1, 2)).filter("e = 0 or e % 25 > id % 7")


@pytest.mark.parametrize("block", [3, 1000])
@pytest.mark.parametrize("limited", [False, True])
def test_pairs_equal_brute_force(spark, monkeypatch, block, limited, request):
    if limited:
        request.getfixturevalue("tight")
    monkeypatch.setattr(P, "BLOCK_ITEMS", block)
    df = baskets(spark)
    have = defaultdict(set)
    for r in df.collect():
        have[r.e].add(r["item"])
    expected = defaultdict(set)
    for e, items in have.items():
        for a, b in combinations(sorted(items), 2):
            expected[a, b].add(e)
    expected = {k: sorted(v) for k, v in expected.items() if len(v) >= 2}
    got, shares = defaultdict(list), {}
    for r in P.cooccurrence_pairs(df, "e", "item", "lab", 2).collect():
        assert r.support == len(expected[r.item_1, r.item_2])
        got[r.item_1, r.item_2] += r.entities
        shares[r.item_1, r.item_2] = r.prevalence
    assert dict(got) == expected
    assert sum(shares.values()) == pytest.approx(1)


@pytest.mark.parametrize("limited", [False, True])
def test_rule_counts_equal_brute_force(spark, limited, request):
    if limited:
        request.getfixturevalue("tight")
    df = baskets(spark)
    item, route = F.col("item"), F.col("route")
    rules = [(item == "i01", item == "i09", "HIGH"), (item.like("%1"), item.like("%2"), "HIGH"), (route == 1, route == 1, "MID")]
    got = {r.e: (r.pair_count, r.HIGH, r.MID) for r in P.pair_rule_counts(df, "e", "item", rules, ["HIGH", "MID"]).collect()}
    by_entity = defaultdict(list)
    for r in df.collect():
        by_entity[r.e].append((r["item"], r.route))
    for e, things in by_entity.items():
        counts = Counter()
        for a, ra in things:
            for b, rb in things:
                if a < b:
                    counts["all"] += 1
                    if (a == "i01" and b == "i09") or (a.endswith("1") and b.endswith("2")):
                        counts["HIGH"] += 1
                    elif ra == 1 and rb == 1:
                        counts["MID"] += 1
        assert got[e] == (counts["all"], counts["HIGH"], counts["MID"])
