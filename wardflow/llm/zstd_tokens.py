"""Token ids in files of independent zstandard frames with a trailing seek table.

One file, in this order:
- per document one zstandard frame with its token ids, little-endian, 2 or 4 bytes each;
- a skippable frame with what the documents are: a byte for the width of an id, then per document a
  signed 64-bit doc_id and a byte that is 1 where the doc_id is NULL;
- the seek table of the zstandard seekable format, as a skippable frame: per frame its compressed size,
  its size and the low 32 bits of the XXH64 of its ids, then frame count, flags and magic number;
- one line feed, which Spark's text writer ends each file with.

Readers find the table from the end of a file and decompress only the frames of the documents asked for.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.pieces import SinglePieceEncoder, split_byte_level
from wardflow.session import settle

#: Numbers of the zstandard formats; fixed values.
SKIPPABLE_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

LEVEL = 3
#: A file is closed once its frames reach this size.
FILE_BYTES = 16 << 20


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level BPE: itself if it is visible, else the next from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: byte for byte in visible} | {byte: 256 + place for place, byte in enumerate(hidden)}


class Encoder:
    """Ids of whole texts by the tokenizers library.

    Byte-level BPE encodes each match of its split pattern by itself. For such tokenizers matches go to the
    library's BPE model once, spelled in the characters that stand for bytes, and are remembered, which gives
    the library's ids in less time. Any other tokenizer, and any text with the string of a special token,
    goes to the library whole.
    """

    def __init__(self, definition: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        split = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not parts.get("normalizer")
            and parts["model"]["type"] == "BPE"
            and not parts["model"].get("dropout")
            and not parts.get("truncation")
            and not parts.get("padding")
        )
        self.special = [t["content"] for t in parts.get("added_tokens", [])]
        self.pieces = SinglePieceEncoder(split_byte_level, self._piece)
        self.model, self.spelling = self.library.model, byte_characters()
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'HI'[self.width // 4]}", *ids)

    def _whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        spelled = piece.encode("utf-8").decode("latin-1").translate(self.spelling)
        return self._packed([token.id for token in self.model.tokenize(spelled)])

    def ids(self, text: str) -> bytes:
        """Packed ids of a text."""
        if not self.by_piece or any(s in text for s in self.special):
            return self._whole(text)
        return self.pieces.ids(text)


@lru_cache(maxsize=2)
def _encoder(definition: bytes) -> Encoder:
    return Encoder(definition.decode("utf-8"))


class FileWriter:
    """Frames, and the tables that end a file."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)
        self.frames: list[bytes] = []
        self.index: list[bytes] = []
        self.table: list[bytes] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document."""
        frame = self.press.compress(ids)
        self.frames.append(frame)
        self.index.append(struct.pack("<qB", doc_id or 0, doc_id is None))
        self.table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.size += len(frame)

    def close(self) -> bytes:
        """The whole file but for its last line feed."""
        index = bytes([self.width]) + b"".join(self.index)
        table = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        return b"".join(
            [
                *self.frames,
                struct.pack("<II", SKIPPABLE_INDEX, len(index)),
                index,
                struct.pack("<II", SKIPPABLE_TABLE, len(table)),
                table,
            ]
        )


class FileReader:
    """Documents of one file, each decompressed only when asked for."""

    def __init__(self, data: bytes | memoryview) -> None:
        data = memoryview(data)
        count, flags, magic = struct.unpack("<IBI", data[-10:-1])
        if magic != SEEKABLE or not flags & CHECKSUMS or data[-1] != 10:
            raise ValueError("no seek table at the end of the file")
        at = len(data) - 10 - 12 * count
        table = np.frombuffer(data[at : at + 12 * count], dtype="<u4").reshape(-1, 3)
        begin = at - 8 - (9 * count + 1)
        self.data, self.width = data, data[begin]
        entries = np.frombuffer(data[begin + 1 : begin + 1 + 9 * count], dtype=[("doc", "<i8"), ("null", "u1")])
        self.doc_ids = [None if x["null"] else int(x["doc"]) for x in entries]
        self.sizes, self.sums = table[:, 1], table[:, 2]
        self.ends = np.cumsum(table[:, 0], dtype=np.int64)
        self.starts = self.ends - table[:, 0]
        self.unpress = zstandard.ZstdDecompressor()

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at `place`; raises if its checksum does not match."""
        frame = self.data[self.starts[place] : self.ends[place]]
        raw = self.unpress.decompress(frame, max_output_size=int(self.sizes[place]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[place]:
            raise ValueError(f"frame {place} does not match its checksum")
        return np.frombuffer(raw, dtype=f"<u{self.width}")


def write_tokens(
    docs: DataFrame, path: str, definition: bytes, end_id: int, text: str = "text", file_bytes: int = FILE_BYTES
) -> None:
    """Encodes whole texts and writes the files below `path`, in ascending order of doc_id.

    `definition` is a tokenizer file (JSON); `end_id` is appended to every document. Files are written
    by Spark's own writer, so a lost task leaves none behind and any file system Spark reaches will do.
    NULL texts count as empty, NULL ids come first, repeated ids are ordered by text and repeated rows
    all stay. An empty table writes no file with documents. Further columns are not written.
    """
    # A tokenizer file has a fixed size of a few megabytes, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("row")]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        end = int(end_id).to_bytes(encoder.width, "little")
        file = FileWriter(encoder.width)
        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                file.add(doc_id.as_py(), encoder.ids(value.as_py()) + end)
                if file.size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([file.close()], pa.binary())], ["file"])
                    file = FileWriter(encoder.width)
        if file.frames:
            yield pa.RecordBatch.from_arrays([pa.array([file.close()], pa.binary())], ["file"])

    files = dealt.sortWithinPartitions(*order).mapInArrow(run, "file binary")
    # One row is one file; the writer passes the bytes of a string through as they are.
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """File contents and their order: writers number the parts, and the files within a part."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    name = F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", 1), F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", 2)
    return found.select(name[0].cast("bigint").alias("part"), name[1].cast("bigint").alias("number"), "content")


def _read(spark: SparkSession, path: str, schema: str, work: Callable[[FileReader], Iterator[pa.RecordBatch]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, content in zip(*batch.columns, strict=True):
                for out in work(FileReader(content.as_buffer())):
                    same = [pa.array([v.as_py()] * out.num_rows, pa.int64()) for v in (part, number)]
                    yield pa.RecordBatch.from_arrays([*same, *out.columns], ["part", "number", *out.schema.names])

    return _files(spark, path).mapInArrow(run, f"part bigint, number bigint, {schema}")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id and ids (with the end id) out of the files; with `doc_ids` only their frames are decompressed."""
    wanted = None if doc_ids is None else set(doc_ids)

    def work(file: FileReader) -> Iterator[pa.RecordBatch]:
        for place, doc_id in enumerate(file.doc_ids):
            if wanted is None or doc_id in wanted:
                ids = pa.array([file.ids(place).astype(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), ids], ["doc_id", "ids"])

    return _read(spark, path, "doc_id bigint, ids array<bigint>", work).select("doc_id", "ids")


def summarise(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32.

    `start` counts the ids of all documents before it: those in its file, and the totals of the files
    before. Only one row per file goes through the ordered window that adds these up.
    """

    def work(file: FileReader) -> Iterator[pa.RecordBatch]:
        lengths = file.sizes.astype(np.int64) // file.width
        sums = [zlib.crc32(file.ids(i).astype("<u4").tobytes()) for i in range(len(lengths))]
        names = ["doc_id", "begin", "n_tokens", "ids_crc32"]
        columns = [file.doc_ids, np.cumsum(lengths) - lengths, lengths, sums]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    rows = settle(_read(spark, path, "doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint", work))
    totals = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("all").over(before), F.lit(0))).drop("all")
    return rows.join(offsets, ["part", "number"]).select(
        "doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
