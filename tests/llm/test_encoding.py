"""Byte-level BPE and token files against the public libraries and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import tokenizers

from tests.llm.helpers import awkward, documents
from wardflow.llm import bpe_transducer, pieces, zstd_tokens
from wardflow.llm.queries import vocabulary

MULTI = "byte_bpe_multi_50k.tiktoken"
ALPHABET = ["a", "b", " ", " ", " ", "\n", "\t", "\r", "'s", "'", "é", "1", "漢", "😀", ".", "　", "\xa0", "\x1c", "\x85", "ab", "the"]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 16))) for _ in range(n)]


@pytest.fixture(scope="module")
def machine():
    return bpe_transducer.Transducer(bpe_transducer.read_ranks(vocabulary(MULTI)))


@pytest.fixture(scope="module")
def library(machine):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=machine.ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert pieces.BYTE_LEVEL == public_tokenizers.PATTERN


def test_transducer_equals_the_library(machine, library):
    encoder = bpe_transducer.Encoder(machine, public_tokenizers.PATTERN)
    rng, tokens = random.Random(2), list(machine.ranks)
    texts = fuzz(4000) + [
        b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))).decode("utf-8", "ignore") for _ in range(4000)
    ]
    for text in [*texts, "a" * 20_000 + "ab" * 9_000, "x" * 9_999 + " ", ""]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode_ordinary(text), repr(text)


def test_states_can_be_forgotten(machine, library, monkeypatch):
    monkeypatch.setattr(bpe_transducer, "MAX_STATES", 5)
    monkeypatch.setattr(bpe_transducer, "LOOKAHEAD", 40)
    for text in [*fuzz(300, 5), "banana" * 50, "thereforewhereas" * 30]:
        words = [i for p in bpe_transducer.PieceEncoder(pieces.BYTE_LEVEL, None).split.findall(text) for i in machine.encode(p.encode())]
        assert words == library.encode_ordinary(text)


def test_memory_of_two_generations(machine, library):
    encoder = bpe_transducer.Encoder(machine, public_tokenizers.PATTERN)
    encoder.pieces.size = 3
    for text in fuzz(500, 7):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode_ordinary(text)


def test_streaming_utf8():
    for text in ["aé漢😀" * 9, "", "😀"]:
        data = text.encode()
        for step in (1, 2, 3, 5):
            stream = bpe_transducer.Utf8Stream()
            out = "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.end()
            assert out == text
    stream = bpe_transducer.Utf8Stream()
    assert stream.feed(b"a\xe6\xbc") == "a" and stream.end() == "�"


def test_round_trip_in_spark(spark):
    docs = awkward(spark, extra=("ids",))
    data = vocabulary(MULTI)
    ids = bpe_transducer.encoded(docs, data, public_tokenizers.PATTERN)
    back = bpe_transducer.decoded(ids.drop("text"), data)
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in back.collect())
    assert texts == sorted((r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    assert bpe_transducer.digests(docs.limit(0), data, public_tokenizers.PATTERN).count() == 0


def test_encoder_equals_tokenizers():
    definition = vocabulary("byte_bpe_50k.json").decode()
    own, theirs = zstd_tokens.Encoder(definition), tokenizers.Tokenizer.from_str(definition)
    for text in [*fuzz(4000, 9), "end<|endoftext|> of text", "a  b   c \n \n d"]:
        assert np.frombuffer(own.ids(text), "<u2").tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def test_both_splits_are_the_pattern():
    plain = regex.compile(pieces.BYTE_LEVEL)
    for code in [*range(0x3000), *range(0xFB00, 0x10000), 0x1D7CE, 0x1F600, 0x20000]:
        c = chr(code)
        text = f"a{c}b {c} {c}1{c} {c}{c}'s\n{c}_{c}  {c}'re \t{c}"
        assert pieces.split_byte_level(text) == plain.findall(text), hex(code)
    assert pieces._OTHER.search("½ and so on") and not pieces._OTHER.search("“naïve” – d’où…")
    for text in fuzz(3000, 12):
        assert pieces.split_byte_level(text) == plain.findall(text)


def test_quick_split_looks_characters_up_in_sets():
    """No class of the quick split asks for a category of a character, which takes `re` half as long again."""
    assert not regex.search(r"\\[wWdDsS]", pieces._QUICK.pattern)
    plain, rng = regex.compile(pieces.BYTE_LEVEL), random.Random(3)
    letters = [c for c in map(chr, [*range(0x250), *range(0x2010, 0x205F)]) if not pieces._OTHER.search(c)]
    for _ in range(300):
        text = "".join(rng.choice([*letters, *" '_1a\n" * 40]) for _ in range(200))
        assert pieces._QUICK.findall(text) == plain.findall(text)


def test_pieces_are_encoded_one_by_one():
    definition = vocabulary("byte_bpe_50k.json").decode()
    own, theirs = zstd_tokens.Encoder(definition), tokenizers.Tokenizer.from_str(definition)
    assert own.by_piece and len(set(zstd_tokens.byte_characters().values())) == 256
    own.pieces.size = 3
    every = "".join(map(chr, [*range(0x20, 0x250), 0x2028, 0x3000, 0x1F600, 0xFFFD]))
    for text in [*fuzz(1500, 10), every, "x" * 20_000, " " * 5000 + "end", "'s 't're's\u00a0\x1c\x85d"]:
        assert np.frombuffer(own.ids(text), "<u2").tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def test_file_of_frames():
    file = zstd_tokens.FileWriter(2)
    documents_in = [(3, [1, 2, 3]), (None, []), (-7, list(range(5000)))]
    for doc_id, ids in documents_in:
        file.add(doc_id, np.array(ids, "<u2").tobytes())
    data = file.close() + b"\n"
    reader = zstd_tokens.FileReader(data)
    assert reader.doc_ids == [3, None, -7]
    assert [reader.ids(k).tolist() for k in range(3)] == [ids for _, ids in documents_in]
    broken = bytearray(data)
    broken[-12] ^= 1  # the checksum of the last frame
    with pytest.raises(ValueError, match="checksum"):
        zstd_tokens.FileReader(bytes(broken)).ids(2)
    with pytest.raises(ValueError, match="seek table"):
        zstd_tokens.FileReader(data[:-1])


@pytest.mark.parametrize("file_bytes", [1, 1 << 20])
def test_files_hold_all_documents_in_order(spark, tmp_path, file_bytes):
    docs = awkward(spark, extra=("ids", "start"))
    path = str(tmp_path / "tokens")
    definition = vocabulary("byte_bpe_50k.json")
    zstd_tokens.write_tokens(docs, path, definition, end_id=2, file_bytes=file_bytes)
    rows = sorted(zstd_tokens.summarise(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] is None for r in rows] == [True, True] + [False] * 8
    assert [r["doc_id"] for r in rows[2:]] == [1, 1, 1, 2, 3, 4, 5, 6]
    theirs, begin = tokenizers.Tokenizer.from_str(definition.decode()), 0
    want = {}
    for r in docs.collect():
        ids = theirs.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = {}
    for r in rows:
        assert r["start"] == begin
        begin += r["n_tokens"]
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    some = zstd_tokens.read_tokens(spark, path, [2, 5]).collect()
    assert sorted((r["doc_id"], len(r["ids"])) for r in some) == [(2, 1), (5, got[5][0][0])]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    zstd_tokens.write_tokens(documents(spark, []), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    assert zstd_tokens.summarise(spark, path).count() == 0
