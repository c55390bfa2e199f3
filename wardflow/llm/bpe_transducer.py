"""Byte-level BPE as a lazily determinised transducer, and streaming decoding."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardflow.llm.pieces import BYTE_LEVEL, PieceEncoder

#: Determinised states that one worker keeps; past that it starts over.
MAX_STATES = 200_000
#: Bytes read before tokens of a long piece are output.
LOOKAHEAD = 4096
#: Tokens decoded at once.
DECODE_TOKENS = 1 << 16


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids out of a rank file: one base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Byte-pair merges compiled into a transducer from bytes to token ids.

    Nondeterministic form: read bytes down a trie of the tokens; where a token ends, it may be output if
    the merges leave it standing beside the token before it. Every prefix has exactly one such reading,
    so the machine is unambiguous. Deterministic form, built step by step as input asks for it: a state
    is the list of live walks (trie node, token before), oldest first, and each step names the one token
    that can end there. A walk dies at the latest at the length of the longest token, so what all live
    walks build upon is output after a bounded lookahead.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.length = [len(t) for t in self.bytes_of]
        self.standing: dict[tuple[int, int], bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, rank in ranks.items():
            at = 0
            for b in token:
                if b not in self.next[at]:
                    self.next[at][b] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
                    self.depth.append(self.depth[at] + 1)
                at = self.next[at][b]
            self.token[at] = rank
        self._forget()

    def _forget(self) -> None:
        start = ((0, -1),)
        self.state_of = {start: 0}
        self.walks = [start]
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes `token`; None for a byte, or a token that merging never makes."""
        if token not in self.split:
            parts = self._merge(self.bytes_of[token], below=token)
            self.split[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.split[token]

    def _merge(self, data: bytes, below: int) -> list[int]:
        """Plain merging of `data` with merges of a lower rank than `below`; used on single tokens only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _reachable(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self._halves(token) is not None

    def _stands(self, before: int, token: int) -> bool:
        """Whether merging the bytes of both leaves the border between them.

        A merge across the border joins a token x that ends `before` for a while and a token y that
        begins `token` for a while. It happens if it ranks before x's next merge, and before or with
        y's (of equal merges the left one goes first).
        """
        key = (before, token)
        known = self.standing.get(key)
        if known is None:
            known = self.standing[key] = self._reachable(token) and not any(
                rank < x_until and rank <= y_until
                for x, x_until in self._edge(before, 1)
                for y, y_until in self._edge(token, 0)
                if (rank := self.ranks.get(self.bytes_of[x] + self.bytes_of[y])) is not None
            )
            if len(self.standing) > 20 * MAX_STATES:
                self.standing.clear()
        return known

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """Tokens at the left (0) or right (1) edge of `token` while it is merged, each with the rank that ends it."""
        until = len(self.ranks) + 1
        while True:
            yield token, until
            halves = self._halves(token)
            if halves is None:
                return
            until, token = token, halves[side]

    def _move(self, state: int, b: int) -> tuple[int, int]:
        """Determinises one step: the state after byte `b`, and the token that ends there."""
        after: list[tuple[int, int]] = []
        ended = -1
        for node, before in self.walks[state]:
            to = self.next[node].get(b)
            if to is None:
                continue
            token = self.token[to]
            if ended < 0 and token >= 0 and (self._stands(before, token) if before >= 0 else self._reachable(token)):
                ended = token
            if self.next[to]:
                after.append((to, before))
        if ended < 0:
            raise ValueError("the vocabulary lacks a byte")
        walks = (*after, (0, ended))
        to = self.state_of.get(walks)
        if to is None:
            to = self.state_of[walks] = len(self.walks)
            self.walks.append(walks)
            self.moves.append({})
        self.moves[state][b] = (to, ended)
        return to, ended

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece, as byte-pair merging gives them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.walks) > MAX_STATES:
            self._forget()
        ids: list[int] = []
        state, moves = 0, self.moves
        ends: list[int] = []
        for at in range(0, len(piece), LOOKAHEAD):
            if at:
                ends = self._settle(state, ends, ids)
            for b in piece[at : at + LOOKAHEAD]:
                step = moves[state].get(b)
                state, token = step if step is not None else self._move(state, b)
                ends.append(token)
        return ids + self._back(ends, len(ends))

    def _back(self, ends: list[int], at: int) -> list[int]:
        """The tokens that lead to place `at`, by the token that ends at each place."""
        ids = []
        while at > 0:
            token = ends[at - 1]
            ids.append(token)
            at -= self.length[token]
        return ids[::-1]

    def _settle(self, state: int, ends: list[int], ids: list[int]) -> list[int]:
        """Outputs to `ids` what all live walks build upon; returns the rest of `ends`."""
        shared: set[int] | None = None
        for node, _ in self.walks[state]:
            at = len(ends) - self.depth[node]
            places = {at}
            while at > 0:
                at -= self.length[ends[at - 1]]
                places.add(at)
            shared = places if shared is None else shared & places
        cut = max(shared or {0})
        ids += self._back(ends, cut)
        return ends[cut:]


class Encoder:
    """Ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, machine: Transducer, split: str) -> None:
        self.machine = machine
        self.pieces = PieceEncoder(split, lambda found: [self._piece(piece) for piece in found])

    def _piece(self, piece: str) -> bytes:
        ids = self.machine.encode(piece.encode("utf-8"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str | None) -> bytes:
        """All ids of a text; none for NULL."""
        return self.pieces.ids(text or "")


class Utf8Stream:
    """Incremental UTF-8: gives out completed characters and holds back an unfinished one.

    States are 0 to 3 bytes held. Bytes that no character can begin or continue become U+FFFD.
    """

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        """Characters that `data` completes."""
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b >= 0xC0:
                need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                if back < need:
                    cut -= back
                break
            if b < 0x80:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        """What the unfinished character becomes."""
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode(ids: Sequence[int], bytes_of: list[bytes]) -> Iterator[str]:
    """The text of token ids, in parts, as it becomes complete."""
    stream = Utf8Stream()
    for at in range(0, len(ids), DECODE_TOKENS):
        yield stream.feed(b"".join(map(bytes_of.__getitem__, ids[at : at + DECODE_TOKENS])))
    yield stream.end()


@lru_cache(maxsize=2)
def _worker(vocabulary: bytes, split: str) -> tuple[Transducer, Encoder]:
    machine = Transducer(read_ranks(vocabulary))
    return machine, Encoder(machine, split)


def _mapped(docs: DataFrame, text: str, vocabulary: bytes, split: str, add: list[T.StructField], work) -> DataFrame:
    """`docs` without its text and with the columns that `work` makes of the text, batch by batch."""
    added = {f.name for f in add}
    rest = [c for c in docs.columns if c != text and c not in added]
    schema = T.StructType([*[docs.schema[c] for c in rest], *add])
    # A vocabulary file has a fixed size of a few megabytes, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, encoder = _worker(shared.value, split)
        for batch in batches:
            made = [work(t.as_py(), machine, encoder) for t in batch.column(text)]
            columns = [batch.column(c) for c in rest]
            new = [pa.array([m[i] for m in made], type=t) for i, t in enumerate(_ARROW[f.dataType] for f in add)]
            yield pa.RecordBatch.from_arrays([*columns, *new], [*rest, *[f.name for f in add]])

    return docs.select(*rest, text).mapInArrow(run, schema)


_ARROW = {
    T.LongType(): pa.int64(),
    T.StringType(): pa.string(),
    T.ArrayType(T.IntegerType()): pa.list_(pa.int32()),
}


def encoded(docs: DataFrame, vocabulary: bytes, split: str, text: str = "text") -> DataFrame:
    """`docs` with the column `ids`, the token ids of the whole text, in place of the text.

    `vocabulary` is a rank file, `split` the pattern whose matches are encoded separately. A NULL or
    empty text has no ids. Repeated rows stay. An empty table gives an empty result. Further columns
    stay; one named ids is replaced.
    """

    def work(value, machine, encoder):
        return (np.frombuffer(encoder.ids(value), dtype="<u4").astype(np.int32),)

    return _mapped(docs, text, vocabulary, split, [T.StructField("ids", T.ArrayType(T.IntegerType()))], work)


def _decoded_sha256(ids: bytes, machine: Transducer) -> str:
    """Digest of the text that encoded ids give back, without the whole text in memory."""
    back = hashlib.sha256()
    for part in decode(np.frombuffer(ids, dtype="<u4").tolist(), machine.bytes_of):
        back.update(part.encode("utf-8"))
    return back.hexdigest()


def encoded_and_decoded(docs: DataFrame, vocabulary: bytes, split: str, text: str = "text") -> DataFrame:
    """As `encoded`, with the digest decoded_sha256 of the text that the ids give back beside them."""
    add = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded_sha256", T.StringType())]

    def work(value, machine, encoder):
        ids = encoder.ids(value)
        return np.frombuffer(ids, dtype="<u4").astype(np.int32), _decoded_sha256(ids, machine)

    return _mapped(docs, text, vocabulary, split, add, work)


def decoded(tokens: DataFrame, vocabulary: bytes, ids: str = "ids") -> DataFrame:
    """`tokens` with the column `text` in place of the ids. NULL ids give an empty text."""

    def work(value, machine, encoder):
        return ("".join(decode(value or [], machine.bytes_of)),)

    return _mapped(tokens, ids, vocabulary, BYTE_LEVEL, [T.StructField("text", T.StringType())], work)


def digests(docs: DataFrame, vocabulary: bytes, split: str, text: str = "text") -> DataFrame:
    """Encodes and decodes every whole text; n_tokens, ids_sha256 and decoded_sha256 in place of it.

    Rows and NULLs as in `encoded`; the texts and ids themselves never leave the task.
    """
    add = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def work(value, machine, encoder):
        ids = encoder.ids(value)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), _decoded_sha256(ids, machine)

    return _mapped(docs, text, vocabulary, split, add, work)
