"""Personal data: fixed patterns give seeds, their contexts give lexical patterns, these give further identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import join_by_key, let
from wardflow.session import settle

#: Base patterns by kind, in the order of results. Possessive and anchored so that matching takes time and
#: stack in proportion to the text; they match what the plain forms match, leftmost and non-overlapping.
_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to match at all, cheaper to look for.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_VALUE = rf"^{_PART}(?:\.{_PART}){{3}}$"

#: A run of words with digits or an at sign, one blank apart.
_GAP = r"\x20\x09-\x0D"
_WORD = rf"[^{_GAP}0-9@]*+[0-9@][^{_GAP}]*+"
CANDIDATE = rf"(?<![^{_GAP}]){_WORD}(?:\x20{_WORD})*+"

#: Distinct seeds a pattern needs, share of its occurrences that are identifiers, and the score for acceptance.
MIN_SEEDS = 5
MIN_PRECISION = 0.5
ACCEPT = 0.9
ROUNDS = 3
#: Patterns that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
_BLOCK = 128

SPAN = "array<struct<kind:string,start:int,end:int>>"


def _running(lengths: Column) -> Column:
    """Sums of the lengths up to and with each place; in blocks, so that long lists take little more than linear time."""

    def sums(values: Column) -> Column:
        empty = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(
            values,
            empty,
            lambda a, x: F.struct((a["n"] + x).alias("n"), F.array_append(a["all"], a["n"] + x).alias("all")),
            lambda a: a["all"],
        )

    def blocks(values: Column) -> Column:
        count = F.ceil(F.size(values) / _BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda b: sums(F.slice(values, b * _BLOCK + 1, _BLOCK))
        )

    def whole(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.coalesce(F.get(p, F.size(p) - 1), F.lit(0)))
        return let(
            sums(totals),
            lambda ends: F.flatten(
                F.transform(parts, lambda p, k: F.transform(p, lambda x: x + F.coalesce(F.get(ends, k - 1), F.lit(0))))
            ),
        )

    return let(lengths, lambda values: let(blocks(values), whole))


def matches(text: Column, pattern: str, needs: str) -> Column:
    """array of (value, start, end, before, after): what the pattern matches, its place in code points, and the
    text between it and the neighbouring matches. Texts without a match of `needs` have none."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("values"), F.split(text, pattern, -1).alias("gaps")
    )

    def placed(m: Column) -> Column:
        steps = F.zip_with(
            F.slice(m["gaps"], F.lit(1), F.size(m["values"])), m["values"], lambda gap, v: F.length(gap) + F.length(v)
        )
        return let(
            _running(steps),
            lambda ends: F.transform(
                m["values"],
                lambda v, k: F.struct(
                    v.alias("value"),
                    (F.get(ends, k) - F.length(v)).alias("start"),
                    F.get(ends, k).alias("end"),
                    F.get(m["gaps"], k).alias("before"),
                    F.get(m["gaps"], k + 1).alias("after"),
                ),
            ),
        )

    none = F.array().cast("array<struct<value:string,start:int,end:int,before:string,after:string>>")
    some = let(found, lambda m: F.when(F.size(m["values"]) == 0, none).otherwise(placed(m)))
    return F.when(text.rlike(needs), some).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check sum: from the right, every second one counts double, less 9 above 9."""

    def worth(d: Column, k: Column) -> Column:
        twice = d.cast("int") * (1 + k % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    places = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.when(d != "", worth(d, k)).otherwise(F.lit(0)))
    return F.aggregate(places, F.lit(0), lambda n, x: n + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_VALUE)
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """(kind, start, end) of every base match, by kind as listed, then start."""
    def of_kind(kind: str) -> Column:
        valid = F.filter(matches(text, KINDS[kind], NEEDS[kind]), lambda m: _valid(kind, m["value"]))
        return F.transform(valid, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"], m["end"]))

    return F.concat(*[of_kind(kind) for kind in KINDS]).cast(SPAN)


def _plain(word: Column) -> Column:
    """Lower case without punctuation; what is only punctuation stays."""
    bare = F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]+", "")
    return F.when(bare == "", word).otherwise(bare)


def _kind_of(value: Column) -> Column:
    """The base kind that the value holds, if any."""
    def holds(kind: str) -> Column:
        return F.exists(F.regexp_extract_all(value, F.lit(KINDS[kind]), 0), lambda v: _valid(kind, v))

    return F.coalesce(*[F.when(holds(kind), F.lit(kind)) for kind in KINDS])


def _shaped(kind: Column, value: Column) -> Column:
    """Whether an identifier of the kind could look like this."""
    n = F.length(_digits(value))
    return (
        F.when(kind == "email", value.rlike(r"^[^\x20@]+@[^\x20@]+$"))
        .when(kind == "ip", value.rlike(r"^[0-9]+(?:[.:][0-9]+){3,7}$"))
        .when(kind == "card", n.between(12, 19) & value.rlike(r"^[0-9][0-9\x20-]*$"))
        .when(kind == "phone", n.between(7, 15) & value.rlike(r"^[0-9+(][0-9\x20().+-]*$"))
        .otherwise(False)
    )


def candidates(text: Column) -> Column:
    """array of (value, start, end, and the plain words left1, left2, right1 beside it).

    A candidate has five digits at least, or an at sign. Punctuation that clings to its ends is cut off.
    """
    found = F.filter(
        matches(text, CANDIDATE, "[0-9@]"), lambda m: (F.length(_digits(m["value"])) >= 5) | F.contains(m["value"], F.lit("@"))
    )

    def described(m: Column) -> Column:
        lead = F.length(F.regexp_extract(m["value"], r"^[^\p{L}\p{N}+(@]*+", 0))
        value = F.regexp_replace(F.substr(m["value"], lead + 1), r"[^\p{L}\p{N}]+$", "")
        # Whole words beside the candidate, however long or far off they are.
        before, after = (F.trim(F.regexp_replace(m[side], f"[{_GAP}]+", " ")) for side in ("before", "after"))
        two, word = F.substring_index(before, " ", -2), F.substring_index(before, " ", -1)
        ahead = F.when(F.contains(two, F.lit(" ")), F.substring_index(two, " ", 1))
        return F.struct(
            value.alias("value"),
            (m["start"] + lead).alias("start"),
            (m["start"] + lead + F.length(value)).alias("end"),
            _plain(word).alias("left1"),
            F.concat_ws(" ", _plain(ahead), _plain(word)).alias("left2"),
            _plain(F.substring_index(after, " ", 1)).alias("right1"),
        )

    return F.filter(F.transform(found, described), lambda c: F.length(c["value"]) > 0)


def _occurrences(measured: DataFrame) -> DataFrame:
    """One row per candidate, and the base kind it holds."""
    rows = measured.select("doc_id", "version", F.explode("candidates").alias("c")).select("doc_id", "version", "c.*")
    return settle(rows.withColumn("kind", _kind_of(F.col("value"))))


def _patterns(occurrences: DataFrame) -> DataFrame:
    """(pattern, value, kind) for each context of each candidate."""
    contexts = F.array(
        F.concat(F.lit("L1 "), "left1"), F.concat(F.lit("L2 "), "left2"), F.concat(F.lit("R1 "), "right1")
    )
    return occurrences.select(F.explode(contexts).alias("pattern"), "value", "kind").filter(
        F.length("pattern") > 3
    ).distinct()


def _corpus_counts(texts: Column, docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often the context of each pattern stands anywhere in the corpus."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(texts, F.lit("")), f"[{_GAP}]+", " ")), " ")

    def contexts(w: Column) -> Column:
        plain = F.transform(w, _plain)
        return let(
            plain,
            lambda p: F.concat(
                F.transform(p, lambda x: F.concat(F.lit("L1 "), x)),
                F.transform(p, lambda x: F.concat(F.lit("R1 "), x)),
                F.transform(p, lambda x, k: F.concat(F.lit("L2 "), F.concat_ws(" ", F.get(p, k - 1), x))),
            ),
        )

    every = docs.select(F.explode_outer(let(words, contexts)).alias("pattern"))
    few = patterns.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if few:
        return every.join(F.broadcast(patterns), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("all"))
    return every.groupBy("pattern").agg(F.count("*").alias("all")).join(patterns, "pattern", "left_semi")


def _noisy_or(scores: Column) -> Column:
    """Probability that at least one of the sources is right."""
    return 1 - F.exp(F.sum(F.log(1 - F.least(scores, F.lit(0.999)))))


def discover(occurrences: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, version, kind, start and end of the identifiers that trusted patterns find beyond the base.

    Seeds are candidates with a base match. A pattern (the word before, the two words before, or the word
    after) counts if at least MIN_SEEDS distinct seeds of a kind stand in it and at least MIN_PRECISION
    of all its occurrences in the corpus are identifiers. On the graph of patterns and instances a
    pattern's score for a kind is the mean of its instances' scores, and an unknown instance's score the
    noisy-or of its patterns' scores, for ROUNDS rounds. Unknown instances of the right shape that reach
    ACCEPT are found.
    """
    edges = settle(_patterns(occurrences))
    seeded = settle(
        edges.filter("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
        .filter(F.col("seeds") >= MIN_SEEDS)
    )
    nothing = occurrences.select("doc_id", "version", "kind", "start", "end").limit(0)
    if seeded.isEmpty():
        return nothing
    names = seeded.select("pattern").distinct()
    everywhere = _corpus_counts(F.col(text), docs, names)
    standing = (
        occurrences.select(
            F.explode(
                F.array(
                    F.concat(F.lit("L1 "), "left1"), F.concat(F.lit("L2 "), "left2"), F.concat(F.lit("R1 "), "right1")
                )
            ).alias("pattern")
        )
        .groupBy("pattern")
        .agg(F.count("*").alias("hits"))
    )
    precise = everywhere.join(standing, "pattern").filter(F.col("hits") >= MIN_PRECISION * F.col("all"))
    members = settle(edges.groupBy("pattern").agg(F.count("*").alias("n")).join(precise, "pattern").select("pattern", "n"))
    if members.isEmpty():
        return nothing
    flagged = members.withColumn("trusted", F.lit(True))
    graph = settle(join_by_key(edges, flagged, "pattern", "n").filter("trusted").drop("trusted"))
    kinds = F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("as_kind")
    nodes = graph.select("pattern", "value", "kind", kinds).withColumn(
        "known", F.when(F.col("kind").isNotNull(), (F.col("kind") == F.col("as_kind")).cast("double"))
    )
    scored = settle(nodes.withColumn("score", F.coalesce("known", F.lit(0.0))))
    for _ in range(ROUNDS):
        trust = settle(
            scored.groupBy("pattern", "as_kind")
            # Unknown instances count in full against a pattern until it has shown what they are.
            .agg(F.avg("score").alias("mean"), F.avg("known").alias("share"), F.count("known").alias("seeds"),
                 F.count("*").alias("rows"))
            .filter(F.col("seeds") >= MIN_SEEDS)
            .select(F.concat_ws("\x01", "pattern", "as_kind").alias("node"), "rows",
                    (F.greatest("mean", "share") * F.col("seeds") / (F.col("seeds") + 1)).alias("trust"))
        )
        edge = scored.withColumn("node", F.concat_ws("\x01", "pattern", "as_kind"))
        carried = join_by_key(edge, trust, "node", "rows").filter("known IS NULL AND trust IS NOT NULL")
        found = carried.groupBy("value", "as_kind").agg(_noisy_or(F.col("trust")).alias("reached"))
        # Unknown values have at most a few patterns each; the join is on the value and kind.
        scored = settle(
            scored.drop("score").join(found, ["value", "as_kind"], "left").withColumn(
                "score", F.coalesce("known", "reached", F.lit(0.0))
            ).drop("reached")
        )
    good = scored.filter((F.col("score") >= ACCEPT) & F.col("known").isNull()).select("value", "as_kind", "score")
    good = good.distinct().filter(_shaped(F.col("as_kind"), F.col("value")))
    best = settle(
        good.groupBy("value").agg(F.max(F.struct("score", "as_kind"))["as_kind"].alias("found"))
        .join(occurrences.filter("kind IS NULL").groupBy("value").agg(F.count("*").alias("n")), "value")
    )
    unknown = occurrences.filter("kind IS NULL").drop("kind")
    return join_by_key(unknown, best, "value", "n").filter("found IS NOT NULL").select(
        "doc_id", "version", F.col("found").alias("kind"), "start", "end"
    )


def _spelled(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _order(kind: Column) -> Column:
    return reduce(lambda rest, k: F.when(kind == k[1], k[0]).otherwise(rest), list(enumerate(KINDS)), F.lit(len(KINDS)))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, counts of base matches by kind, base (the base spans) and spans (all), per row of `docs`.

    `docs` needs doc_id and text; whole texts are searched, NULL as empty. Spans are (kind, start, end) in
    code points, the end exclusive, by kind as listed and then start. Repeated rows stay, each with the
    same spans; equal ids with different texts are told apart. An empty table gives an empty result;
    further columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(whole).alias("version"), whole.alias("text"))
    measured = settle(
        rows.select(
            "doc_id", "version", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("candidates")
        )
    )
    occurrences = _occurrences(measured)
    extra = discover(occurrences, rows)
    per_doc = (
        extra.distinct()
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("kind", "start", "end")).cast(SPAN).alias("more"))
        .select(F.col("doc_id").alias("d"), F.col("version").alias("v"), "more")
    )
    same = measured["doc_id"].eqNullSafe(per_doc["d"]) & (measured["version"] == per_doc["v"])
    joined = measured.select("doc_id", "version", "base").join(per_doc, same, "left")
    keyed = F.transform(
        F.concat("base", F.coalesce("more", F.array().cast(SPAN))),
        lambda s: F.struct(_order(s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    every = F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return joined.select("doc_id", *[count(kind) for kind in KINDS], "base", every.alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """`find`, with the base spans as a SHA-256 and all spans spelled out as kind:start:end."""
    return find(docs).select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(_spelled(F.col("base")), 256).alias("base_sha256"),
        _spelled(F.col("spans")).alias("spans"),
    )
