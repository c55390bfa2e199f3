"""Weakly supervised quality rules and line dedup against brute force."""

import random
import re
import time
from collections import Counter

import pytest

from tests.llm.helpers import awkward, documents
from wardflow.llm import common, line_dedup, weak_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    repeated = {k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_measures_of_whole_texts(spark):
    texts = ["a b c d e f a b c d e g", "x " * 9, "# * | <", "é€😀 word\nline\n\nline\n \nline", "\x0b\x0c a\rb"]
    docs = documents(spark, list(enumerate(texts)))
    rows = {r["doc_id"]: r for r in weak_quality.score(docs).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == measures(text)


def test_junk_goes_and_prose_stays(spark):
    prose = [f"The {a} house of the {b} stands near a river. It was built long ago by people of {a}." for a in "abcdef" for b in "ghij"]
    junk = [" ".join(f"w{i}{k}%%%" for i in range(30)) for k in range(6)] + [
        " ".join(f"WORD{i}{k}!!" for i in range(30)) for k in range(6)
    ]
    docs = documents(spark, list(enumerate(prose + junk)))
    kept = {r["doc_id"]: r["kept"] for r in weak_quality.score(docs).collect()}
    assert [kept[i] for i in range(len(prose))] == [True] * len(prose)
    assert [kept[len(prose) + i] for i in range(len(junk))] == [False] * len(junk)


def test_fit_finds_the_better_rule():
    good, bad, abstain = weak_quality.GOOD, weak_quality.BAD, weak_quality.ABSTAIN
    counts = {
        (good, abstain, abstain, abstain): 900,
        (abstain, bad, bad, bad): 90,
        (good, abstain, bad, abstain): 45,  # the third rule alone against a good vote
        (abstain, bad, abstain, bad): 9,
    }
    share, accuracy = weak_quality.fit(counts)
    assert share > 0.7 and accuracy[1] > accuracy[2] and accuracy[3] > accuracy[2]
    assert weak_quality.posterior((abstain, bad, bad, bad), share, accuracy) < 0.5
    assert weak_quality.posterior((good, abstain, bad, abstain), share, accuracy) > 0.5
    assert weak_quality.fit({})[1] == []


def slow_quality(votes):
    """Probability of being good for each text of `votes`, texts one by one: what is assumed counts as 0.25 of all and 5."""
    rules = len(votes[0])
    cast = [sum(v[r] != weak_quality.ABSTAIN for v in votes) for r in range(rules)]
    share, accuracy = 0.8, [0.8] * rules

    def chance(vote):
        good, bad = share, 1 - share
        for r, said in enumerate(vote):
            if said == weak_quality.GOOD:
                good, bad = good * accuracy[r], bad * (1 - accuracy[r])
            elif said == weak_quality.BAD:
                good, bad = good * (1 - accuracy[r]), bad * accuracy[r]
        return good / (good + bad)

    for _ in range(60):
        p = [chance(v) for v in votes]
        before = 0.25 * len(votes) + 5
        new = []
        for r in range(rules):
            right = sum(x if v[r] == weak_quality.GOOD else 1 - x for x, v in zip(p, votes, strict=True) if v[r] != weak_quality.ABSTAIN)
            held = 0.25 * cast[r] + 5
            new.append(min(0.99, max(0.55, (right + 0.8 * held) / (cast[r] + held))))
        share, accuracy = min(0.9, max(0.1, (sum(p) + 0.8 * before) / (len(votes) + before))), new
    return [chance(v) for v in votes]


def test_expectation_maximisation_is_brute_force():
    rng = random.Random(9)
    votes = []
    for _ in range(400):
        truth = rng.random() < 0.7
        votes.append(tuple(
            weak_quality.ABSTAIN if rng.random() < 0.4
            else weak_quality.GOOD if (rng.random() < right) == truth else weak_quality.BAD
            for right in (0.95, 0.9, 0.8, 0.6, 0.55)
        ))
    share, accuracy = weak_quality.fit(Counter(votes))
    want = slow_quality(votes)
    assert max(abs(weak_quality.posterior(v, share, accuracy) - w) for v, w in zip(votes, want, strict=True)) < 1e-9


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark, extra=("kept", "n_words"))
    rows = weak_quality.score(docs).collect()
    assert len(rows) == docs.count()
    assert all(not r["kept"] and r["base_failed"] for r in rows if not (r["text"] or "").strip())
    assert weak_quality.keep_good(docs).columns == docs.columns
    assert weak_quality.score(docs.limit(0)).count() == 0


def line_brute_force(rows, similarity=0.8, size=5):
    """Texts without later matches, comparing each line with all earlier ones."""
    seen, out = [], {}
    for key in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        kept = []
        for line in key[1].split("\n"):
            words = WORD.findall(line)
            if words:
                new = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
                hit = any(len(new & old) >= similarity * len(new | old) - 1e-9 for old in seen)
                seen.append(new)
                if hit:
                    continue
            kept.append(line)
        out[key] = "\n".join(kept)
    return out


@pytest.fixture(scope="module")
def near_lines():
    base = [" ".join(f"w{k}n{i}" for i in range(40)) for k in range(8)]
    rows = []
    for i in range(60):
        words = base[i % 8].split()
        if i % 3:
            words[i % 40] = f"changed{i}"
        if i % 7 == 0:
            words = words[: 40 - i % 11]
        rows.append((i, "\n".join([" ".join(words), "short line", f"own {i}", ""])))
    return rows


def test_line_dedup_is_brute_force(spark, near_lines):
    got = {(r["doc_id"]): r["text"] for r in line_dedup.dedup_lines(documents(spark, near_lines)).collect()}
    assert got == {k[0]: v for k, v in line_brute_force(near_lines).items()}


def test_line_dedup_in_small_units(spark, near_lines, monkeypatch):
    monkeypatch.setattr(line_dedup, "UNIT_ROWS", 3)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 5)
    got = {(r["doc_id"]): r["text"] for r in line_dedup.dedup_lines(documents(spark, near_lines)).collect()}
    assert got == {k[0]: v for k, v in line_brute_force(near_lines).items()}


def test_line_dedup_of_awkward_rows(spark):
    docs = awkward(spark, extra=("n_lines", "n_removed"))
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == docs.count()
    same = [r for r in rows if r["doc_id"] == 1 and r["text"].startswith("One")]
    assert len(same) == 2 and all(r["n_removed"] == 0 for r in same)
    assert all(r["text"] is not None for r in rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_odd_white_space(spark):
    words = "a b\u00a0c d\u2028e \U0001f600\U0001f600 f \x01 \x1c g.* h\\i \u0085 j k l m n o p q r s t".split(" ")
    seps = [" ", "  ", "\t", " \x0b", "\x0c\r ", "\r"]
    rows = [(i, f"{'  '[: i % 3]}{sep.join(words[: 4 + n])}{sep * (i % 2)}") for i, (n, sep) in enumerate((n, sep) for n in (0, 1, 3, 14) for sep in seps)]
    rows += [(90, "\n".join(" ".join(words[k : k + n]) for k in range(9) for n in (1, 4, 5, 6, 11))), (91, " \n\t\n\r\n"), (92, "z " * 3000 + "y")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {k[0]: v for k, v in line_brute_force(rows).items()}


def test_tokens_are_the_distinct_shingles(spark):
    lines = ["", " \t", "a", " a  b ", "a b c d", "a b c d e", "a b c d e f", "x x x x x x x", "\ta b c d e\ra b c d e f \x0c", "é 😀 ü \u2028 \x85 v w"]
    sets = line_dedup.line_sets(documents(spark, list(enumerate(lines)))).collect()
    for r in sets:
        words = WORD.findall(lines[r["doc_id"]])
        want = {tuple(words[i : i + 5]) for i in range(max(min(len(words), 1), len(words) - 4))}
        assert len(r["tokens"]) == len(set(r["tokens"])) == len(want)
    assert len({(r["h1"], r["h2"]) for r in sets}) == len({" ".join(WORD.findall(x)) for x in lines})


def test_sets_are_grouped_by_their_prefixes_alone(spark, near_lines):
    lines = line_dedup.line_sets(documents(spark, near_lines))
    plan = line_dedup.distinct_sets(lines, 0.8)._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(x for x in plan.splitlines() if "Aggregate" in x)
    assert "first(prefix#" in grouped and "sort_array" not in grouped


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(k).getName() for k in range(found.size())) if n.startswith("shuffle_")}


def test_line_dedup_leaves_no_shuffled_files(spark, near_lines):
    before, own = shuffle_files(spark), spark.conf.get(common.SHUFFLE_CLEANUP, None)
    result = line_dedup.dedup_lines(documents(spark, near_lines))
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)  # executors remove them on their own time
    assert not left
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == own
    assert result.count() == result.count() == len(near_lines)
    with pytest.raises(ValueError), common.brief_shuffles(spark):
        raise ValueError
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == own


def test_tokens_of_two_sets_that_cannot_match_go(spark):
    large = line_dedup.LARGEST
    sets = [
        (1, 10, 0, 7), (1, 100, 0, 7),  # sizes
        (2, 10, 0, 7), (2, 10, 1, 7),
        (3, 10, 0, 0), (3, 10, 0, 0x7FFFFFF0),  # bitmaps
        (4, 100, 19, 7), (4, 100, 0, 7),  # places
        (5, 10, 0, 7), (5, 100, 0, 7), (5, 1000, 0, 7),  # three sets
        (6, 10, 0, -1), (6, 10, 0, -4),
        (7, large + 5, 2000, 0), (7, 3 * large, 5000, -1),  # too large to tell
        (8, 10, 0, 7),
        (9, 20_000, 1500, 7), (9, 20_000, 1500, 7),
    ]
    places = spark.createDataFrame(sets, "token int, m int, i int, bits bigint")
    got = {r["token"]: r["n"] for r in line_dedup.shared_tokens(places, 0.8).collect()}
    assert got == {2: 2, 5: 3, 6: 2, 7: 2, 9: 2}


def test_lines_are_looked_up_by_place(spark):
    rows = [(None if d == 0 else d, d % 3, p) for d in range(300) for p in range(10)]
    lines = spark.createDataFrame(rows, "doc_id bigint, version bigint, pos int")
    wanted = {(None, 0, 4), (7, 1, 0), (7, 1, 9), (299, 2, 5)}
    got = [tuple(r) for r in line_dedup._maybe_at(lines, lines.limit(0).union(spark.createDataFrame(list(wanted), lines.schema))).collect()]
    assert wanted <= set(got) and len(got) < 20
    assert line_dedup._maybe_at(lines, lines.limit(0)).count() == 0


def test_line_dedup_of_long_lines(spark):
    rng = random.Random(3)
    rows, earlier = [], []
    for i in range(80):
        words = list(rng.choice(earlier)) if i % 3 == 2 else [f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(120, 400))]
        for _ in range(rng.randrange(9) if i % 3 == 2 else 0):
            words[rng.randrange(len(words))] = f"new{i}"
        start = rng.randrange(len(words) - 10)
        words[start : start + 6] = "common shingles of many long lines".split()
        earlier.append(words)
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    want = {k[0]: v for k, v in line_brute_force(rows).items()}
    assert got == want and 5 < sum(not t for t in got.values()) < 26
