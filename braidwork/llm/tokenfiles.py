"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents. Ids stand in blocks of 128: a block keeps its minimum, the differences
in a bit width that fits 90 percent of them, and the others (position and whole difference) in an exception list. An
index gives each block's place in the packed bytes and in the exception list, so one block can be read alone. Packed
values stand in four lanes: value 4 i + l of a block is the i-th of lane l, and a lane fills 32-bit words from the
lowest bit up; that way all blocks of a width are packed by the same few shifts.

Layout, little-endian: magic ``PFB1``; u32 number of ids, of blocks, of exceptions, of packed bytes; then per block
u32 minimum, u8 width, u32 start in the packed bytes, u32 start in the exceptions; then exceptions' u8 positions,
their u32 differences, and the packed bytes.

Files are rows of a Parquet table in the shared folder (part, seq, n_ids, doc_ids, lengths, file): Spark's own writer
commits them, whichever store the cluster uses. ``part`` is the range of ids, ``seq`` the file's place in it.

Defined cases: a null or empty text is its end id alone; null ids come first; repeated ids stand side by side ordered
by their text's checksum; further columns are ignored; an empty table gives no files and an empty result. A file ends
after the document that brings it to ``FILE_IDS`` ids, so a very long text makes one longer file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, shuffle_parts, stored
from .tokens import encoder

BLOCK = 128
PERCENTILE = 90
FILE_IDS = 1 << 18
FILES = "part int, seq int, n_ids long, doc_ids array<long>, lengths array<long>, file binary"
#: Blocks that are packed or unpacked at once.
_AT_ONCE = 8192
_LANES = 4


def _pack(values: np.ndarray, w: int) -> np.ndarray:
    """(blocks, BLOCK) values of w bits -> (blocks, 16 w) bytes."""
    lanes = values.reshape(len(values), BLOCK // _LANES, _LANES)
    out = np.zeros((len(values), w, _LANES), dtype="<u4")
    for i in range(BLOCK // _LANES):
        word, shift = divmod(i * w, 32)
        out[:, word] |= lanes[:, i] << np.uint32(shift)
        if shift + w > 32:
            out[:, word + 1] |= lanes[:, i] >> np.uint32(32 - shift)
    return out.reshape(len(values), -1).view(np.uint8)


def _unpack(data: np.ndarray, w: int) -> np.ndarray:
    """(blocks, 16 w) bytes -> (blocks, BLOCK) values of w bits."""
    words = data.view("<u4").reshape(len(data), w, _LANES)
    out = np.empty((len(data), BLOCK // _LANES, _LANES), dtype=np.uint32)
    mask = np.uint32((1 << w) - 1)
    for i in range(BLOCK // _LANES):
        word, shift = divmod(i * w, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + w > 32:
            value |= words[:, word + 1] << np.uint32(32 - shift)
        out[:, i] = value & mask
    return out.reshape(len(data), BLOCK)


def encode_file(ids: np.ndarray) -> bytes:
    n = len(ids)
    blocks = -(-n // BLOCK)
    x = np.empty(blocks * BLOCK, dtype=np.uint32)
    x[:n] = ids
    if n:
        x[n:] = ids[-1]
    x = x.reshape(blocks, BLOCK)
    low = x.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = x - low[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    chosen = np.partition(rest, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.uint32)
    width = np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)
    outlier = rest > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    row, position = np.nonzero(outlier)
    starts = np.concatenate(([0], np.cumsum(BLOCK // 8 * width)))
    packed = np.zeros(starts[-1], dtype=np.uint8)
    for w in np.unique(width).tolist():
        if not w:
            continue
        own = np.flatnonzero(width == w)
        for at in range(0, len(own), _AT_ONCE):
            some = own[at : at + _AT_ONCE]
            packed[starts[some][:, None] + np.arange(BLOCK // 8 * w)] = _pack(rest[some] & np.uint32((1 << w) - 1), w)
    first = np.searchsorted(row, np.arange(blocks))
    head = b"PFB1" + np.array([n, blocks, len(row), len(packed)], "<u4").tobytes()
    index = low.astype("<u4").tobytes() + width.astype(np.uint8).tobytes() + starts[:-1].astype("<u4").tobytes() + first.astype("<u4").tobytes()
    return head + index + position.astype(np.uint8).tobytes() + rest[row, position].astype("<u4").tobytes() + packed.tobytes()


class TokenFile:
    """Reads the ids of a file, all of them or one block."""

    def __init__(self, data: bytes):
        if data[:4] != b"PFB1":
            raise ValueError("not a token file")
        self.n, self.blocks, exceptions, size = np.frombuffer(data, "<u4", 4, 4).astype(int).tolist()
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += got.nbytes
            return got

        self.low, self.width = take("<u4", self.blocks), take("u1", self.blocks)
        self.start, self.first = take("<u4", self.blocks), take("<u4", self.blocks)
        self.position, self.difference = take("u1", exceptions), take("<u4", exceptions)
        self.packed = take("u1", size)

    def _rows(self, own: np.ndarray) -> np.ndarray:
        out = np.zeros((len(own), BLOCK), dtype=np.uint32)
        for w in np.unique(self.width[own]).tolist():
            if not w:
                continue
            here = np.flatnonzero(self.width[own] == w)
            for at in range(0, len(here), _AT_ONCE):
                some = here[at : at + _AT_ONCE]
                data = self.packed[self.start[own[some]].astype(np.int64)[:, None] + np.arange(BLOCK // 8 * w)]
                out[some] = _unpack(data, w)
        return out

    def block(self, i: int) -> np.ndarray:
        out = self._rows(np.array([i]))[0]
        lo, hi = int(self.first[i]), int(self.first[i + 1]) if i + 1 < self.blocks else len(self.position)
        out[self.position[lo:hi]] = self.difference[lo:hi]
        return (out + self.low[i])[: self.n - i * BLOCK if i == self.blocks - 1 else BLOCK]

    def ids(self) -> np.ndarray:
        out = self._rows(np.arange(self.blocks))
        counts = np.diff(np.concatenate((self.first.astype(np.int64), [len(self.position)])))
        out[np.repeat(np.arange(self.blocks), counts), self.position] = self.difference
        return (out + self.low[:, None]).ravel()[: self.n]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode (doc_id, text) in the order of doc_id into files; the returned table is what was written."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer).encode
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def file() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in parts]
            data = encode_file(np.frombuffer(b"".join(parts), "<u4"))
            columns = [[part], [seq], [sum(lengths)], [doc_ids], [lengths], [data]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "seq", "n_ids", "doc_ids", "lengths", "file"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts.append(ids_of(text.as_py()) + end)
                doc_ids.append(doc_id)
                held += len(parts[-1]) // 4
                if held >= file_ids:
                    yield file()
                    doc_ids, parts, held, seq = [], [], 0, seq + 1
        if parts:
            yield file()

    # the number splits what has one id, and one text too, over several ranges
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), F.monotonically_increasing_id().alias("n"))
    order = ["doc_id", F.crc32("text"), "n"]
    ordered = own.repartitionByRange(shuffle_parts(docs.sparkSession), *order).sortWithinPartitions(*order).drop("n")
    return stored(ordered.mapInArrow(encode, FILES), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files' bytes; start counts all ids before it."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, doc_ids, lengths, file in zip(*[batch.column(i) for i in range(5)], strict=True):
                data = TokenFile(file.as_py()).ids().astype("<u4").tobytes()
                lengths = np.array(lengths.as_py(), dtype=np.int64)
                starts = np.cumsum(lengths) - lengths
                crcs = [zlib.crc32(data[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
                columns = [np.full(len(lengths), part.as_py(), np.int32), np.full(len(lengths), seq.as_py(), np.int32), pa.array(doc_ids.as_py(), pa.int64()), starts, lengths, np.array(crcs, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"])

    decoded = files.select("part", "seq", "doc_ids", "lengths", "file").mapInArrow(decode, "part int, seq int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    # ids before a part: over one row a part; ids before a file: within its part
    of_part = files.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    of_part = of_part.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before_part"))
    of_file = files.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("before_file"))
    before = of_file.join(of_part, "part").select("part", "seq", (F.col("before_part") + F.col("before_file")).alias("before"))
    return decoded.join(before, ["part", "seq"]).select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
