"""Best-fit packing by sums of squares.

Texts become token ids, longer ones are cut into pieces of the capacity. Pieces are dealt evenly over shards of a
bounded number of pieces; a shard places its pieces, longest first, each into the open sequence whose choice makes
the sum over gaps of (number of open sequences with that gap) squared smallest, and opens a sequence when none has
room. Only gap counts decide, so a placement costs one look at an array of the capacity's length.

Defined cases: a null or empty text is the end id alone; repeated rows are packed one by one; null ids pass through;
further columns of ``pieces`` are kept by ``pack``, ones called sequence_id or offset are replaced; an empty table gives an empty result. A text's ids are made one
text at a time and leave the worker in batches of about 4 MB.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, give_back, stored, unused
from .tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids binary"
#: Pieces that one shard packs; 8,192 waste less than a thousandth of the sequences.
SHARD_PIECES = 8192
#: Words in a generation of the encoder: packing is often the last stage of a long job, beside whatever else is held.
REMEMBERED = 150_000


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, text) -> PIECES; ids are little-endian unsigned 32-bit integers, the first piece is the short one."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, generation=remembered).encode
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    length = (n % capacity or capacity) if at == 0 else capacity
                    rows.append((doc_id, piece, at, length, ids[4 * at : 4 * (at + length)]))
                    at, piece = at + length, piece + 1
                held += len(ids)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        give_back()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(cut, PIECES)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces in their order of placement: each one's sequence (from 0) and offset in it."""
    open_with = np.zeros(capacity + 1, dtype=np.int64)
    waiting: dict[int, list[int]] = defaultdict(list)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    never, opened = np.int64(1) << np.int64(60), 0
    for i, size in enumerate(lengths.tolist()):
        gap = capacity
        if size < capacity:
            # moving a sequence from gap h to h - size changes the sum of squares by 2 (n[h - size] - n[h]) + 2;
            # one that becomes full leaves the sum
            change = 2 * (open_with[: capacity - size] - open_with[size:capacity]) + 2
            change[0] = 1 - 2 * open_with[size]
            change[open_with[size:capacity] == 0] = never
            best = int(change.argmin())
            if change[best] < never:
                gap = best + size
        if gap == capacity:
            own, opened = opened, opened + 1
        else:
            own = waiting[gap].pop()
            open_with[gap] -= 1
        sequence[i], offset[i] = own, capacity - gap
        if gap > size:
            waiting[gap - size].append(own)
            open_with[gap - size] += 1
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with doc_id, piece, start, length; best a stored table) plus sequence_id and offset."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    pieces, dealt_to = pieces.drop("sequence_id", "offset"), unused("__shard", pieces)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.drop_columns([dealt_to])
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")]
        table = table.take(pa.compute.sort_indices(table, order))
        sequence, offset = place(table["length"].to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 32))).append_column("offset", pa.array(offset))

    # the row numbers of a stored table are the same in every rerun, and they deal even one document's copies evenly
    dealt = pieces.withColumn(dealt_to, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return dealt.groupBy(dealt_to).applyInArrow(shard, schema)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for the tokens of ``docs``."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, remembered)
    narrow = stored(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, capacity)
