"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, the posterior decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import let, words_of
from wardflow.session import settle

#: Characters that count as symbols; fixed values.
SYMBOLS = "#*$%&|<>"
#: Words in a window for repeated passages, and the base limits: fixed values.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

GOOD, BAD, ABSTAIN = 1, 0, 2
#: Weight of what is assumed beforehand, against the votes.
PRIOR = 0.25


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that the text holds twice or more.

    Window hashes are compared; those seen twice are found by sorting (hash, place), so the cost
    stays n log n for very long texts. Texts without any repeated window stop before the sort.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(WINDOW)]),
    )

    def repeated(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: (x["h"] == F.coalesce(F.get(s, k - 1)["h"], F.bitwise_not(x["h"])))
                        | (x["h"] == F.coalesce(F.get(s, k + 1)["h"], F.bitwise_not(x["h"]))),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return let(
            starts,
            lambda a: F.aggregate(
                F.transform(a, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(a, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda n, x: n + x,
            ),
        )

    found = let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h))
    )
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(found)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the measures that the rules look at, all taken from the whole text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, __lines, __upper, __exclaim and
    __stops. A NULL text counts as empty. Columns of these names in `docs` are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumn("__words", words_of(F.col(text))).withColumn(
        "__list", F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    return split.withColumns(
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.length(F.concat_ws("", "__words")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")).cast("bigint"),
            "n_dup_lines": (F.size("__list") - F.size(F.array_distinct("__list"))).cast("bigint"),
            "n_repeat_words": _repeat_words(F.col("__words")).cast("bigint"),
            "__lines": F.size("__list").cast("bigint"),
            "__upper": F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).cast("bigint"),
            "__exclaim": F.length(F.regexp_replace(whole, "[^!]+", "")).cast("bigint"),
            "__stops": F.length(F.regexp_replace(whole, "[^.?]+", "")).cast("bigint"),
        }
    ).drop("__words", "__list")


def votes() -> dict[str, Column]:
    """What each rule says of a row of `features`: BAD or GOOD where its condition holds, else ABSTAIN.

    Every rule names one class only; a missing fault is no vote for a text.
    """
    n, chars = F.col("n_words"), F.col("word_chars")
    marks = F.col("n_symbols") + F.col("__exclaim")
    bad = {
        "v_symbols": F.col("n_symbols") * 10 > n,
        "v_many_symbols": F.col("n_symbols") * 4 > n,
        "v_marks": marks * 5 > n,
        "v_upper": F.col("__upper") * 3 > chars,
        "v_exclaim": F.col("__exclaim") * 10 > n,
        "v_word_length": (chars < 2 * n) | (chars > 12 * n),
        "v_no_stops": F.col("__stops") * 100 < n,
        "v_dup_lines": F.col("n_dup_lines") * 3 > F.col("__lines"),
        "v_repeats": F.col("n_repeat_words") * 5 > n,
    }
    good = {
        "v_prose": (marks * 50 <= n)
        & (F.col("__upper") > 0)
        & (F.col("__upper") * 10 <= chars)
        & (F.col("__stops") * 50 >= n)
        & chars.between(3 * n, 9 * n),
        "v_fresh": (marks * 50 <= n)
        & (F.col("n_repeat_words") * 10 <= n)
        & (F.col("n_dup_lines") * 5 <= F.col("__lines")),
    }
    says = {**{k: (c, BAD) for k, c in bad.items()}, **{k: (c, GOOD) for k, c in good.items()}}
    return {k: F.when(c, v).otherwise(ABSTAIN).cast("tinyint") for k, (c, v) in says.items()}


def fit(counts: dict[tuple[int, ...], int], rounds: int = 60) -> tuple[float, list[float]]:
    """Share of good texts and the accuracy of each rule, by expectation-maximisation.

    `counts` holds how many texts show each vote pattern, at most 2 to the number of rules. Four texts in
    five are taken to be good and rules to be right four times in five; this counts PRIOR times as much
    as the votes, and five votes more, so that rules cannot drift off together. Accuracies stay between
    0.55 and 0.99, the share between 0.1 and 0.9: neither rules nor classes may come out as certain.
    """
    rules = len(next(iter(counts), ()))
    share, accuracy = 0.8, [0.8] * rules
    said = [sum(n for p, n in counts.items() if p[r] != ABSTAIN) * PRIOR + 5 for r in range(rules)]
    texts = sum(counts.values()) * PRIOR + 5
    for _ in range(rounds):
        good, total = 0.8 * texts, texts
        right, cast = [0.8 * n for n in said], list(said)
        for pattern, n in counts.items():
            p = posterior(pattern, share, accuracy)
            good, total = good + p * n, total + n
            for r, vote in enumerate(pattern):
                if vote != ABSTAIN:
                    cast[r] += n
                    right[r] += n * (p if vote == GOOD else 1 - p)
        share = min(0.9, max(0.1, good / total))
        accuracy = [min(0.99, max(0.55, a / b)) for a, b in zip(right, cast, strict=True)]
    return share, accuracy


def posterior(pattern: tuple[int, ...], share: float, accuracy: list[float]) -> float:
    """Probability that a text with these votes is good."""
    odds = math.log(share / (1 - share))
    for vote, a in zip(pattern, accuracy, strict=True):
        if vote != ABSTAIN:
            odds += math.log(a / (1 - a)) * (1 if vote == GOOD else -1)
    return 1 / (1 + math.exp(-odds))


def posteriors(measured: DataFrame) -> DataFrame:
    """quality, the posterior, of each vote pattern that `measured` (of `features`) shows.

    Patterns are counted over all rows; only these counts, at most 2 to the number of rules, come to the
    driver, and the result has as many rows.
    """
    said = votes()
    names = list(said)
    counted = measured.select(*[c.alias(n) for n, c in said.items()]).groupBy(*names).count()
    counts = {tuple(r[c] for c in names): r["count"] for r in counted.collect()}
    share, accuracy = fit(counts)
    schema = ", ".join(f"{c} tinyint" for c in names) + ", quality double"
    return measured.sparkSession.createDataFrame([(*p, posterior(p, share, accuracy)) for p in counts], schema)


def judge(measured: DataFrame, verdicts: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """`measured` (of `features`) with base_failed, quality and kept, by `verdicts` (of `posteriors`)."""
    said = votes()
    names = list(said)
    voted = measured.withColumns(said)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        voted.drop("quality", "base_failed", "kept")
        .join(F.broadcast(verdicts), names, "left")
        .withColumn("base_failed", failed)
        # One expression over both sides, so that a filter on it cannot make the measures be taken twice.
        .withColumn("kept", F.when(F.col("base_failed"), F.lit(-1.0)).otherwise(F.col("quality")) >= keep_from)
        .drop(*names, "__lines", "__upper", "__exclaim", "__stops")
    )


def score(docs: DataFrame, text: str = "text", keep_from: float = 0.5) -> DataFrame:
    """`docs` with measures, posterior quality and the verdict `kept`, one row per row of `docs`.

    Rules vote on whole texts. NULL and empty texts have no words and fail the base rule. Repeated rows
    are judged alike, each for itself. An empty table gives an empty result. Columns of `docs` stay,
    but for those named like a result column, which are replaced.
    """
    measured = settle(features(docs, text))
    return judge(measured, posteriors(measured), keep_from)


def keep_good(docs: DataFrame, text: str = "text", keep_from: float = 0.5) -> DataFrame:
    """The rows of `docs` whose text is kept, with the columns of `docs` as they were.

    Texts are written once with their measures, which are then read to count the votes and to filter:
    measuring takes far longer than writing. Nothing is shuffled.
    """
    rest = [c for c in docs.columns if c != text]
    held = docs.select(F.struct(*rest).alias("__row"), F.col(text).alias("__text"))
    measured = settle(features(held, "__text"))
    kept = judge(measured, posteriors(measured), keep_from).filter("kept")
    return kept.select(*[F.col("__text").alias(c) if c == text else F.col(f"__row.{c}") for c in docs.columns])
