"""Conversation structure repair: cheapest edits by dynamic programming over streams sorted by turn."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import settle

#: Costs of the edits; an undeleted truncated row adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Faults of a row; blank rows and duplicates must go.
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Initials that an edit may keep, by code; code 3 stands for all others.
INITIALS = "sua"
#: What the repaired roles spell so far: nothing, `s`, an open `u`, a closed `a`. Nothing and a closed `a` may end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The initial that may follow by Rerole or Insert, and the state that it leads to.
WANTED = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ROLE = {"u": "user", "a": "assistant"}
#: Edits in ASCII order, so that the least code is the least letter.
EDITS = "DIKR"
#: What remains to be inserted when no row is left, by state.
LAST = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: Rows whose edits make one spilled record.
CHUNK = 1 << 16

SPACE = " \t\n\x0b\x0c\r"


def after_keep(state: int, initial: int) -> int | None:
    """The state after a row kept with that initial; None where the order forbids it."""
    if initial == 0:
        return SYSTEM if state == NOTHING else None
    wanted, then = WANTED[state]
    return then if initial < 3 and INITIALS[initial] == wanted else None


class Decisions:
    """Costs to go, from the last row to the first, and the edit to choose at each row in each state.

    The costs of the four states, less their minimum, take few values; each step from one such vector
    by one kind of row is worked out once and then looked up.
    """

    def __init__(self) -> None:
        self.steps: dict[tuple, tuple] = {}

    @staticmethod
    def end() -> tuple[int, ...]:
        """Costs with no row left."""
        return tuple(INSERT * len(LAST[s]) for s in range(4))

    def step(self, costs: tuple[int, ...], initial: int, fault: int) -> tuple[tuple[int, ...], int, int]:
        """Costs before the row less their minimum, that minimum, and the edits of the four states in two bits each."""
        key = costs, initial, fault
        found = self.steps.get(key)
        if found is None:
            found = self.steps[key] = self._step(costs, initial, fault)
        return found

    @staticmethod
    def _step(costs: tuple[int, ...], initial: int, fault: int) -> tuple[tuple[int, ...], int, int]:
        extra = TRUNCATED if fault == CUT else 0
        options: list[dict[str, int]] = []
        for state in range(4):
            ways = {"D": DELETE + costs[state]}
            if fault not in (BLANK, DUPLICATE):
                kept = after_keep(state, initial)
                if kept is not None:
                    ways["K"] = extra + costs[kept]
                ways["R"] = REROLE + extra + costs[WANTED[state][1]]
            options.append(ways)
        best = [min(ways.values()) for ways in options]
        # Rows inserted before this one; a chain of them never returns to a state.
        for _ in range(3):
            best = [min(b, INSERT + best[WANTED[s][1]]) for s, b in enumerate(best)]
        edits = 0
        for state, ways in enumerate(options):
            ways["I"] = INSERT + best[WANTED[state][1]]
            least = min(letter for letter, cost in ways.items() if cost == best[state])
            edits |= EDITS.index(least) << 2 * state
        low = min(best)
        return tuple(b - low for b in best), low, edits


class Walk:
    """Follows the decisions from the first row on; keeps the edits and the digest of the repaired rows."""

    def __init__(self) -> None:
        self.state = NOTHING
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.first = True

    def _emit(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _insert(self) -> None:
        initial, self.state = WANTED[self.state]
        self.audit.append("I")
        self._emit(ROLE[initial], "")

    def row(self, edits: int, role: str, initial: int, text: str) -> None:
        """One row with the edits of its four states."""
        while (edit := EDITS[edits >> 2 * self.state & 3]) == "I":
            self._insert()
        self.audit.append(edit)
        if edit == "K":
            self.state = after_keep(self.state, initial)
            self._emit(role, text)
        elif edit == "R":
            wanted, self.state = WANTED[self.state]
            self._emit(ROLE[wanted], text)

    def finish(self) -> tuple[str, str]:
        """The audit and the digest."""
        for _ in LAST[self.state]:
            self._insert()
        return "".join(self.audit), self.digest.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of the digest query: conv_id, turn, role, text and gone, damaged by crc32 of `conv_id:turn`.

    NULLs become one blank. A dropped row stays as a mark (gone) of its conversation.
    """

    def held(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(held("conv_id"), F.lit(":"), held("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", held("role").alias("role"), held("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), copies.alias("copy")).drop("copy")


RECORD = ["conv", "turn", "turn_null", "role", "mark", "seq", "edits", "stats"]
SPILLED = "conv string, turn bigint, turn_null boolean, role string, mark binary, seq bigint, edits binary, stats array<bigint>"
NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _rows(rows: DataFrame) -> DataFrame:
    """The rows with the keys they are sorted by; `mark` names their text by 128 bits."""
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.col("turn").isNull().alias("turn_null"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        "gone",
    ).withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))


ORDER = [("turn_null", False), ("turn", True), ("role", True), ("mark", True)]


def _sorted(backwards: bool) -> list[Column]:
    return [F.col(c).asc() if up != backwards else F.col(c).desc() for c, up in ORDER]


class Backwards:
    """One conversation whose rows arrive from the last to the first: costs to go, counters, edits not yet recorded."""

    def __init__(self, conv: str, decisions: Decisions) -> None:
        self.conv, self.decisions = conv, decisions
        self.costs, self.total = Decisions.end(), 0
        self.edits, self.seq = bytearray(), 0
        self.key = (True, 0, "", b"")  # before all rows
        self.faults = [0] * 4
        self.illegal = self.turns = 0
        self.high = self.low = self.following = None

    def row(self, turn_null: bool, turn: int, role: str, mark: bytes, initial: int, fault: int) -> tuple | None:
        """Takes one row; gives a record when CHUNK rows are decided."""
        self.costs, lower, byte = self.decisions.step(self.costs, initial, fault)
        self.total += lower
        self.edits.append(byte)
        self.key = turn_null, turn, role, mark
        self.faults[fault] += 1
        if self.following is not None and (initial, self.following) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.following = initial
        if not turn_null:
            if self.high is None:
                self.high = turn
            self.turns += turn != self.low
            self.low = turn
        return self.record(None) if len(self.edits) == CHUNK else None

    def record(self, numbers: list[int] | None) -> tuple:
        """The edits since the last record, in the order of rows, under the key of the first of them."""
        turn_null, turn, role, mark = self.key
        made = self.conv, turn, turn_null, role, mark, -self.seq, bytes(reversed(self.edits)), numbers
        self.edits.clear()
        self.key = (True, 0, "", b"")
        self.seq += 1
        return made

    def last_record(self) -> tuple:
        """The record of the first rows, with the numbers of the conversation."""
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        counts = [gaps, *self.faults[1:], self.illegal, self.total + self.costs[NOTHING]]
        return self.record(counts)


def _decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of conversations that arrive backwards, in records of at most CHUNK rows."""
    decisions = Decisions()
    now: Backwards | None = None
    columns = ["conv", "turn_null", "turn", "role", "mark", "initial", "fault", "gone"]
    for batch in batches:
        out: list[tuple] = []
        for conv, *key, initial, fault, gone in zip(*(batch[c].tolist() for c in columns), strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    out.append(now.last_record())
                now = Backwards(conv, decisions)
            if not gone and (full := now.row(*key, initial, fault)):
                out.append(full)
        if out:
            yield pd.DataFrame(out, columns=RECORD)
    if now is not None:
        yield pd.DataFrame([now.last_record()], columns=RECORD)


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and digest of conversations that arrive in order, each stretch of rows behind the record of its edits."""
    now, walk, stats, out = None, Walk(), None, []
    waiting: deque[bytes] = deque()
    place = 0
    columns = ["conv", "role", "initial", "text", "edits", "stats"]

    def frame() -> pd.DataFrame:
        return pd.DataFrame(out, columns=["conv", *NUMBERS, "audit", "repaired_sha256"])

    for batch in batches:
        for conv, role, initial, text, edits, numbers in zip(*(batch[c].tolist() for c in columns), strict=True):
            if conv != now:
                if now is not None:
                    out.append((now, *stats, *walk.finish()))
                now, walk, place = conv, Walk(), 0
                waiting.clear()
            if edits is not None:
                if numbers is not None:
                    stats = [int(x) for x in numbers]
                if edits:
                    waiting.append(edits)
                continue
            walk.row(waiting[0][place], role, initial, text)
            place += 1
            if place == len(waiting[0]):
                waiting.popleft()
                place = 0
        if out:
            yield frame()
            out = []
    if now is not None:
        out.append((now, *stats, *walk.finish()))
        yield frame()


def repair(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation of `rows` (conv_id, turn, role, text, gone).

    Rows stand by turn, NULLs first, equal turns by role, then by a digest of the text; equal rows
    are neighbours. A row's first fault counts: blank, duplicate (role and text seen earlier in the
    conversation), truncated (it does not end in `.`, `!` or `?`). Edits make the roles' initials spell
    `(s?(ua)+)?`: Keep, Rerole to user or assistant, Delete, Insert an empty user or assistant row.
    Result: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (of the cheapest edits the
    ASCII-least) and repaired_sha256, one row per conversation, those with nothing but gone rows included:
    zeros, no edits, the digest of nothing. `gone` marks rows that are not there and name their conversation.

    Conversations are repartitioned and sorted twice. First without texts and backwards: the
    cost-to-go is carried over the batches, and one byte of decisions per row is written out in
    records. Then in order with texts: the decisions are followed behind their records. A
    conversation of any length needs the memory of one batch and one record, but for its own audit and
    for rows that repeat turn, role and text over several records. NULL conversations are one
    conversation. NULL role or text is one blank. Further columns are ignored; an empty table gives an
    empty result.
    """
    own = _rows(rows)
    bare = F.rtrim("text", F.lit(SPACE))
    repeated = Window.partitionBy("conv", "role", "mark", "gone").orderBy(*_sorted(False))
    place = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    initial = F.when((F.col("role") != "") & (place > 0), place - 1).otherwise(len(INITIALS)).cast("int").alias("initial")
    narrow = own.select(
        "conv", "turn_null", "turn", "role", "mark", "gone", initial,
        (bare == "").alias("is_blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ends"),
    )
    fault = F.when(F.col("is_blank"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(~F.col("ends"), CUT).otherwise(SOUND)
    # The window asks for rows by conversation and more: the partitioning by conversation serves it, and the sort below.
    judged = (
        narrow.repartition("conv")
        .withColumn("nth", F.row_number().over(repeated))
        .withColumn("fault", fault)
        .sortWithinPartitions("conv", *_sorted(True), F.desc("nth"))
        .select("conv", "turn_null", "turn", "role", "mark", "initial", "fault", "gone")
    )
    decided = settle(judged.mapInPandas(_decide, SPILLED))
    texts = own.filter(~F.col("gone")).select(
        "conv", "turn_null", "turn", "role", "mark", F.lit(None).cast("bigint").alias("seq"),
        F.lit(None).cast("binary").alias("edits"), F.lit(None).cast("array<bigint>").alias("stats"), initial, "text",
    )
    records = decided.withColumns({"initial": F.lit(0), "text": F.lit("")})
    # A record sorts before the rows it is for, and records of equal rows by their number.
    ordered = (
        texts.unionByName(records)
        .repartition("conv")
        .sortWithinPartitions("conv", *_sorted(False), F.col("seq").asc_nulls_last())
        .select("conv", "role", "initial", "text", "edits", "stats")
    )
    schema = f"conv string, {', '.join(f'{n} bigint' for n in NUMBERS)}, audit string, repaired_sha256 string"
    followed = ordered.mapInPandas(_follow, schema)
    name = F.when(F.col("conv") != "", F.expr("substring(conv, 2)").cast(rows.schema["conv_id"].dataType))
    return followed.select(name.alias("conv_id"), *NUMBERS, "audit", "repaired_sha256")
