"""URL filter: fixed rules by host and path, and association rules mined from labelled URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import join_by_key
from wardflow.session import settle

#: Share of the URLs of a class that must show a combination of three or more tokens, labelled URLs that must show a rule,
#: and what a rule must reach.
SUPPORT = 0.01
MIN_ROWS = 5
CONFIDENCE = 0.6
LIFT = 1.1
#: Standard deviations from chance that a rule in less than the share SUPPORT must reach.
DEVIATIONS = 3
#: Rules that may be broadcast; more are joined by shuffle.
BROADCAST_RULES = 100_000
#: URLs that a task is given.
TASK_ROWS = 5_000
#: Classes as items of a transaction.
BLOCK, ALLOW = "class=block", "class=allow"

_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 2), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, like net/es/, and its verdict; NULL if none fits.

    `rules` are (verdict, rule). A rule fits its host and all subdomains if the path starts with its path.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels, path parts, file ending, query parts and fragment.

    Runs of digits count as one kind of token. NULL has none.
    """
    whole = F.coalesce(url, F.lit(""))
    plain = F.regexp_replace(whole, "[0-9]+", "0")
    ending = F.regexp_extract(path_of(plain), r"\.([A-Za-z]+)$", 1)
    query = F.regexp_extract(plain, r"\?([^#]*)", 1)
    fragment = F.regexp_extract(plain, "#(.*)$", 1)

    def marked(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(f"{kind}="), p))

    return F.array_distinct(
        F.concat(
            marked("scheme", F.array(F.regexp_extract(plain, "^([A-Za-z]+)://", 1))),
            marked("host", F.split(host_of(whole), r"\.")),
            marked("path", F.split(path_of(plain), "/")),
            marked("ending", F.array(ending)),
            marked("query", F.split(query, "&")),
            marked("fragment", F.array(fragment)),
        )
    )


def label_transactions(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Token sets of the labelled pages, each with its class.

    A page belongs to the document whose number is the first path part made of digits. A label with
    quality 0 or toxic 1 means block. Several labels of a document count as one, block before allow.
    """
    number = F.regexp_extract(path_of(F.col("url")), "/([0-9]{1,18})(?:[^0-9/][^/]*)?(?:/|$)", 1)
    numbered = pages.select("url", F.try_to_number(number, F.lit("9" * 18)).cast("bigint").alias("doc_id"))
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    classes = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return numbered.join(classes, "doc_id").select(
        F.array_append(tokens_of(F.col("url")), F.when(F.col("bad"), BLOCK).otherwise(ALLOW)).alias("items")
    )


def _spread(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Rows dealt out by their number, as few bytes of URL are much work."""
    return df.repartition(max(1, -(-rows // TASK_ROWS)), key)


def _meet(exploded: DataFrame, index: DataFrame) -> DataFrame:
    """`exploded` (token and more) with each `entry` that `index` (token, n, entry) lists under the token.

    n is the number of rows of `exploded` with the token.
    """
    if index.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        return exploded.join(F.broadcast(index.drop("n")), "token")
    lists = settle(index.groupBy("token").agg(F.first("n").alias("n"), F.collect_list("entry").alias("entries")))
    return join_by_key(exploded, lists, "token", "n").withColumn("entry", F.explode("entries")).drop("entries")


def _itemised(transactions: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Settled (row, bad, have) with items for tokens, and (item, members, n, n_bad) for each item.

    Tokens that stand in the very same labelled URLs cannot be told apart and make one item, named after the
    least of them: whatever their number, they add no combinations. Same URLs means the same counts and
    the same sums of two hashes of the row. Tokens of fewer than MIN_ROWS URLs belong to no rule.
    """
    plain = F.array_except("items", F.array(F.lit(BLOCK), F.lit(ALLOW)))
    bad = F.array_contains("items", BLOCK).cast("bigint")
    held = settle(transactions.select(F.monotonically_increasing_id().alias("row"), plain.alias("have"), bad.alias("bad")))
    exploded = held.select("row", "bad", F.explode("have").alias("token"))
    sums = [F.sum(F.xxhash64("row", F.lit(k)).cast("decimal(20,0)")).alias(f"sum{k}") for k in (1, 2)]
    counts = F.count(F.lit(1)).alias("n"), F.sum("bad").alias("n_bad")
    single = settle(exploded.groupBy("token").agg(*counts, *sums).filter(F.col("n") >= MIN_ROWS))
    # All members stand in one URL, so that a list is no longer than its tokens.
    members = F.sort_array(F.collect_list("token")).alias("members")
    items = single.groupBy("n", "n_bad", "sum1", "sum2").agg(members)
    items = settle(items.select(F.get("members", F.lit(0)).alias("item"), "members", "n", "n_bad"))
    # One member stands for its item.
    named = items.select(F.col("item").alias("token"), F.lit(True).alias("known"), "n")
    kept = join_by_key(exploded, named, "token", "n").filter("known")
    sets = kept.groupBy("row", "bad").agg(F.sort_array(F.collect_list("token")).alias("have"))
    return settle(_spread(sets, rows, "row")), items


def _longer(sets: DataFrame, items: DataFrame, support: float) -> DataFrame:
    """(tokens, n, n_bad) of the item combinations that Spark's FP-growth finds in a class, three items or more.

    Each class is mined by itself, in the share `support` of its own URLs but in MIN_ROWS at least; then the
    combinations are counted in both, found under their rarest item.
    """
    found = []
    for bad in (0, 1):
        of_class = sets.filter(F.col("bad") == bad)
        size = of_class.count()
        if size >= MIN_ROWS:
            # Half a row less, as Spark rounds the share of rows up.
            share = min(1.0, max(support, (MIN_ROWS - 0.5) / size))
            found.append(FPGrowth(itemsCol="have", minSupport=share).fit(of_class).freqItemsets)
    if not found:
        return sets.select(F.col("have").alias("tokens"), F.col("row").alias("n"), F.col("bad").alias("n_bad")).limit(0)
    every = reduce(DataFrame.unionByName, found).filter(F.size("items") > 2)
    every = settle(every.select(F.sort_array("items").alias("tokens")).distinct())
    by_item = every.select("tokens", F.explode("tokens").alias("token")).join(
        items.select(F.col("item").alias("token"), "n"), "token"
    )
    rarest = by_item.groupBy("tokens").agg(F.min(F.struct("n", "token")).alias("least"))
    index = settle(rarest.select("least.token", "least.n", F.col("tokens").alias("entry")))
    held = _meet(sets.select("have", "bad", F.explode("have").alias("token")), index)
    held = held.filter(F.size(F.array_except("entry", "have")) == 0)
    return held.groupBy(F.col("entry").alias("tokens")).agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("n_bad"))


def _unbeaten(rules: DataFrame) -> DataFrame:
    """The rules that no rule on part of their items, with the same verdict, equals in confidence."""
    exploded = settle(
        rules.select(F.col("tokens").alias("whole"), "verdict", F.col("confidence").alias("reached"), F.explode("tokens").alias("token"))
    )
    counts = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    listed = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token")).join(counts, "token")
    least = listed.groupBy("tokens", "verdict", "confidence").agg(F.min(F.struct("n", "token")).alias("least"))
    entry = F.struct("tokens", F.col("verdict").alias("says"), "confidence").alias("entry")
    met = _meet(exploded, settle(least.select("least.token", "least.n", entry)))
    beaten = met.filter(
        (F.col("entry.says") == F.col("verdict"))
        & (F.size("entry.tokens") < F.size("whole"))
        & (F.col("entry.confidence") >= F.col("reached"))
        & (F.size(F.array_except("entry.tokens", "whole")) == 0)
    )
    beaten = beaten.select(F.col("whole").alias("tokens"), "verdict").distinct()
    return rules.join(beaten, ["tokens", "verdict"], "left_anti")


def mine(
    transactions: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT
) -> DataFrame:
    """Settled rules: tokens (sorted), members, verdict, confidence, lift and support.

    A URL meets a rule if it holds, for each of the tokens, that token or another of its `members`: those that
    stood in the same labelled URLs. Rules need MIN_ROWS URLs. Those on one item or two are counted,
    however large the table; longer combinations are found by Spark's FP-growth, in the share `support`
    of the blocked or of the allowed URLs. Rules must reach the confidence and lift and, in less than the
    share `support` of all URLs, stand DEVIATIONS off from what chance would give. No rule on part of the
    same items with the same verdict may be as confident.
    """
    empty = (
        "tokens array<string>, members array<array<string>>, verdict string, confidence double, lift double, support double"
    )
    rows, n_bad = transactions.agg(F.count(F.lit(1)), F.sum(F.array_contains("items", BLOCK).cast("bigint"))).first()
    if rows < MIN_ROWS:
        return transactions.sparkSession.createDataFrame([], empty)
    sets, items = _itemised(transactions, rows)
    pairs = F.flatten(
        F.transform("have", lambda a, k: F.transform(F.slice("have", k + 2, F.size("have")), lambda b: F.array(a, b)))
    )
    counts = F.count(F.lit(1)).alias("n"), F.sum("bad").alias("n_bad")
    double = sets.select("bad", F.explode(pairs).alias("tokens")).groupBy("tokens").agg(*counts)
    found = items.select(F.array("item").alias("tokens"), "n", "n_bad").unionByName(double)
    found = found.unionByName(_longer(sets, items, support))
    good = F.col("n") - F.col("n_bad")
    sides = [("block", F.col("n_bad"), n_bad / rows), ("allow", good, 1 - n_bad / rows)]
    verdicts = F.array(
        *[F.struct(F.lit(v).alias("verdict"), hits.alias("hits"), F.lit(part).alias("share")) for v, hits, part in sides]
    )
    rules = found.select("tokens", "n", F.inline(verdicts)).filter(F.col("hits") >= MIN_ROWS)
    rules = rules.select("tokens", "verdict", "n", "hits", "share", (F.col("hits") / F.col("n")).alias("confidence"))
    chance = F.sqrt(F.col("n") * F.col("share") * (1 - F.col("share")))
    beyond = F.col("hits") - F.col("n") * F.col("share") >= DEVIATIONS * chance
    rules = rules.filter(
        (F.col("confidence") >= confidence)
        & (F.col("confidence") >= lift * F.col("share"))
        & ((F.col("hits") >= support * rows) | beyond)
    )
    rules = settle(
        rules.select(
            "tokens", "verdict", "confidence", (F.col("confidence") / F.col("share")).alias("lift"),
            (F.col("hits") / rows).alias("support"),
        )
    )
    kept = settle(_unbeaten(rules))
    # Members stand in the order of the tokens.
    by_item = kept.select("tokens", "verdict", F.explode("tokens").alias("item")).join(items.select("item", "members"), "item")
    listed = by_item.groupBy("tokens", "verdict").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("item", "members"))), lambda x: x["members"]).alias("members")
    )
    return settle(
        kept.join(listed, ["tokens", "verdict"]).select("tokens", "members", "verdict", "confidence", "lift", "support")
    )


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url and the verdict of its best rule, for each distinct url of `urls` that meets a rule.

    Inverted index: each rule is found under the members of its rarest item. Of several rules met the most
    confident decides, then the better supported, then block before allow.
    """
    if rules.isEmpty():
        return urls.sparkSession.createDataFrame([], "url string, mined string, confidence double")
    distinct = settle(urls.select("url").distinct())
    spread = _spread(distinct, distinct.count(), "url").withColumn("have", tokens_of(F.col("url")))
    exploded = settle(spread.withColumn("token", F.explode("have")))
    # The URLs that hold a member of an item decide which list a rule stands in.
    counts = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rule = F.struct("tokens", "members", "verdict", "confidence", "support").alias("rule")
    by_item = rules.select(rule, F.explode(F.arrays_zip("tokens", "members")).alias("item"))
    listed = by_item.select("rule", "item.tokens", F.explode("item.members").alias("token")).join(counts, "token")
    per_item = listed.groupBy("rule", "tokens").agg(
        F.sum("n").alias("sum"), F.collect_list(F.struct("token", "n")).alias("held")
    )
    rarest = per_item.groupBy("rule").agg(
        F.min_by("held", F.struct("sum", "tokens")).alias("held"), F.count(F.lit(1)).alias("present")
    )
    rarest = rarest.filter(F.col("present") == F.size("rule.tokens"))
    index = settle(rarest.select(F.inline("held"), F.col("rule").alias("entry")))
    hits = _meet(exploded, index).withColumnRenamed("entry", "rule")
    met = hits.filter(F.forall("rule.members", lambda m: F.arrays_overlap(m, "have")))
    rank = F.struct(F.col("rule.confidence"), F.col("rule.support"), F.col("rule.verdict"), F.col("rule.tokens"))
    best = met.groupBy("url").agg(F.max(rank).alias("best"))
    return best.select("url", F.col("best.verdict").alias("mined"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], support: float = SUPPORT) -> DataFrame:
    """`pages` (page_id, url) with host, path, rule, verdict and confidence, one row per row of `pages`.

    The longest fitting fixed rule decides; without one, the best mined rule; without that, allow.
    A NULL url, or one without ://, has an empty host and path and is allowed unless a mined rule says
    otherwise. Repeated rows stay. Empty pages give an empty result; without labels nothing is mined.
    Further columns are ignored.
    """
    keyed = pages.select("page_id", "url")
    mined = match(keyed.filter("url IS NOT NULL"), mine(label_transactions(pages, labels), support))
    counted = keyed.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    known = settle(counted.join(mined, "url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    return (
        join_by_key(keyed, known, "url", "n")
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": rule, "verdict": F.coalesce(verdict, "mined", F.lit("allow"))})
        .select("page_id", "host", "path", "rule", "verdict", "confidence")
    )
