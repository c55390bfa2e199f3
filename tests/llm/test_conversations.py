"""Conversation repair against brute force over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from wardflow.llm import conversation_repair as repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def slow_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "" if words and words[-1] in ".!?" else "truncated"
        if (role, text) in seen:
            fault = "duplicate"
        if not words:
            fault = "blank"
        seen.add((role, text))
        faults.append(fault)
    return faults


def all_edits(rows, faults, inserts):
    """(cost, audit, repaired rows) of every legal edit with at most `inserts` insertions between rows."""
    gaps = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]][: 1 + 2 * inserts]
    each = []
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        ways = [("D", 3, [])]
        if fault not in ("blank", "duplicate"):
            more = 1 if fault == "truncated" else 0
            ways += [("K", more, [(role, text)]), ("R", 2 + more, [("user", text)]), ("R", 2 + more, [("assistant", text)])]
        each += [gaps, ways]
    for choice in itertools.product(*each, gaps):
        cost, audit, made = 0, "", []
        for k, x in enumerate(choice):
            if k % 2 == 0:
                cost, audit = cost + 2 * len(x), audit + "I" * len(x)
                made = made + [({"u": "user", "a": "assistant"}[r], "") for r in x]
            else:
                cost, audit, made = cost + x[1], audit + x[0], made + x[2]
        if GOOD.match("".join(r[:1] or "?" for r, _ in made)):
            yield cost, audit, made


def numbers(rows, faults):
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))


def digest(made):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()


def best_edit(rows, faults):
    """(cost, audit, repaired rows): the least pair of cost and whole audit string, from the last row to the first."""
    step = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    after = {"": (0, "", ()), "s": (4, "II", (("user", ""), (("assistant", ""), ()))), "u": (2, "I", (("assistant", ""), ())), "a": (0, "", ())}

    def put(cost, letter, made, rest):
        return (cost + rest[0], letter + rest[1], (made, rest[2]) if made else rest[2])

    for (_, _, role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        now = {}
        for last, (to, name) in step.items():
            ways = [put(3, "D", None, after[last])]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                ways.append(put(2 + more, "R", (name, text), after[to]))
                if role[:1] == to or (role[:1] == "s" and last == ""):
                    ways.append(put(more, "K", (role, text), after[role[:1]]))
            now[last] = min(ways, key=lambda w: w[:2])
        for _ in range(3):
            now = {s: min(w, put(2, "I", (step[s][1], ""), now[step[s][0]]), key=lambda w: w[:2]) for s, w in now.items()}
        after = now
    cost, audit, rest = after[""]
    made = []
    while rest:
        row, rest = rest
        made.append(row)
    return cost, audit, made


def expected(rows, find=best_edit):
    out = {}
    for conv in {r[0] for r in rows}:
        own = in_order([r for r in slow_damage(rows) if r[0] == conv])
        faults = slow_faults(own)
        cost, audit, made = find(own, faults)
        out[conv] = (*numbers(own, faults), cost, audit, digest(made))
    return out


def found(spark, rows, **columns):
    df = spark.createDataFrame(rows, SCHEMA)
    result = repair.repair(repair.damaged(df)).collect()
    assert len({r["conv_id"] for r in result}) == len(result)
    return {r["conv_id"]: tuple(r)[1:] for r in result}


def made_up(rng, conversations, longest):
    texts = ["Yes.", "No!", "What?", "cut off", "end. ", "a\tb.\n", "", " \t", " ", "Yes.", "\x0b\x0c", None, "ü?"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uncle", "User"]
    return [
        (c, t if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts))
        for c in conversations
        for t in range(rng.randrange(longest + 1))
        if rng.random() < 0.95
    ]


def test_edits_over_everything(spark):
    """All edits of short conversations, listed one by one."""
    rng = random.Random(4)
    rows = made_up(rng, range(60), 3)

    def listed(own, faults):
        return min(all_edits(own, faults, 2))

    want = expected(rows, listed)
    assert found(spark, rows) == want == expected(rows)


def test_long_and_odd(spark):
    rng = random.Random(7)
    rows = made_up(rng, [None, *range(200)], 14)
    rows += rows[:40]  # repeated rows
    rows += [(900, 5, "user", "One."), (900, 5, "assistant", "Two."), (900, 5, "assistant", "Two.")]
    assert found(spark, rows) == expected(rows)


def test_records_and_batches(spark, monkeypatch):
    """A conversation over many records and batches has the same result as one in a single record."""
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"T{t}.", f"t{t}", "Same."])) for c in range(3) for t in range(900)]
    rows += [(7, 1, "user", "Same.")] * 200
    whole = found(spark, rows)
    monkeypatch.setattr(repair, "CHUNK", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spark, rows) == whole == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_all_rows_dropped(spark):
    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(conv, 0, "user", "Gone.")]) == {conv: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert found(spark, []) == {}


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_columns(spark, kind):
    """Clashing columns are ignored, ids keep their type, a very long text passes."""
    text = "word " * 200_000 + "."
    df = spark.createDataFrame([(1, 0, "user", text, "x"), (1, 1, "assistant", "Yes.", "y")], f"{SCHEMA}, audit string")
    df = df.withColumn("conv_id", df["conv_id"].cast(kind)).withColumn("cost", df["turn"])
    result = repair.repair(repair.damaged(df))
    assert dict(result.dtypes)["conv_id"] == kind and result.columns == ["conv_id", *repair.NUMBERS, "audit", "repaired_sha256"]
    (row,) = result.collect()
    assert tuple(row)[1:] == expected([(1, 0, "user", text), (1, 1, "assistant", "Yes.")])[1]
