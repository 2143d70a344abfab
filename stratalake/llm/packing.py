"""Best-fit packing planned on a histogram of lengths.

Documents become token ids; longer ones than a sequence are cut from the end, so
that only the first piece is short. The number of pieces of each length, at most
as many numbers as a sequence has tokens, is all that the plan needs: lengths are
taken from the longest, and each goes to the open sequences where it leaves the
least room, many at a time. The plan says which ranks of a length go to which
sequences and offsets, and pieces find their slots by their rank within their
length.

Tasks number their pieces of each length as they make them, and the counts of the tasks give where the numbers of each
begin: so ranks need no window over pieces, and no length or copy, however frequent, is ranked by one task. Pieces
are written once with their ids, go to their sequences in one shuffle, and are joined up there: ``packed_sequences`` returns
the token sequences. ``pack_documents`` reads them back: each piece with its ids as they stand in its sequence. Null texts
are empty and have the end token only; an empty table has no pieces; repeated rows are packed as often as they occur.
Ids take two bytes each on the way where the vocabulary allows it, and four in sequences.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import in_slices, read, written

CAPACITY = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"
# The faster library's pattern overflows its stack on some 1,000,000 whitespace characters in a row.
LONGEST_GAP = 100_000
PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
        ("part", pa.int32()),
        ("nth", pa.int64()),
    ]
)
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"


@dataclass(frozen=True)
class Slots:
    """Ranks of a length that go ``per_sequence`` at a time into consecutive sequences."""

    length: int
    first_rank: int
    n: int
    per_sequence: int
    first_sequence: int
    offset: int


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Slots for every piece; sequences with equal room are handled together."""
    open_by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, how many)
    rooms: list[int] = []
    slots, used = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if not open_by_room[room]:
                insort(rooms, room)
            open_by_room[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms.pop(at)
            else:
                room, first, n = capacity, used, math.ceil(left / (capacity // length))
                used += n
            each = room // length
            full = min(n, left // each)
            if full:
                slots.append(Slots(length, rank, full * each, each, first, capacity - room))
                put(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if left and n:
                slots.append(Slots(length, rank, left, left, first, capacity - room))
                put(room - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            put(room, first, n)
    return slots


def _encoders(tokenizer: str):
    """The tokenizer, and a faster library with the same vocabulary for texts without special strings and long gaps."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    lines = open(tokenizer.removesuffix(".json") + ".tiktoken", "rb")
    with lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(tokenizer), fast


def _long_gap(text: str) -> bool:
    """Whether more than ``LONGEST_GAP`` whitespace characters are in a row; reads the text once."""
    return len(text) > LONGEST_GAP and any(m.end() - m.start() > LONGEST_GAP for m in re.finditer(r"\s+", text))


def token_ids(text: str | None, encoders: tuple) -> np.ndarray:
    """Ids as tokenizers gives them without special tokens, and the end token."""
    exact, fast = encoders
    text = text or ""
    slow = SPECIAL in text or _long_gap(text)
    ids = exact.encode(text, add_special_tokens=False).ids if slow else fast.encode_ordinary(text)
    return np.array([*ids, END_ID], dtype="<u4")


def public_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _id_type(encoders: tuple) -> str:
    return "<u2" if encoders[0].get_vocab_size() <= 1 << 16 else "<u4"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 and the ids, little-endian.

    ``part`` and ``nth`` number the pieces of each length: the task, and how many it had before.
    """
    tokenizer = tokenizer or public_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(tokenizer)
        id_type = _id_type(encoders)
        part, before = TaskContext.get().partitionId(), defaultdict(int)
        for batch in in_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = token_ids(text, encoders)
                ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity)
                for piece, end in enumerate(ends):
                    start = max(0, end - capacity)
                    some, length = ids[start:end], end - start
                    rows.append((doc_id, piece, start, length, zlib.crc32(some.tobytes()), some.astype(id_type).tobytes(), part, before[length]))
                    before[length] += 1
            columns = list(zip(*rows)) or [()] * len(PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PIECE.types)], schema=PIECE)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE_SCHEMA)


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (length, part, nth and others) with sequence_id and offset."""
    spark = rows.sparkSession
    sizes = rows.groupBy("length", "part").agg((F.max("nth") + 1).alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each task and length; pieces with all their ids are joined with it as its size allows.
    begins = written(sizes.withColumn("_begin", F.coalesce(F.sum("_n").over(before), F.lit(0))), "begins")
    counts = {r["length"]: r["n"] for r in begins.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.createDataFrame(
        [(s.length, s.first_rank, s.n, s.per_sequence, s.first_sequence, s.offset) for s in best_fit(counts, capacity)],
        "_length long, _first long, _each_n long, _each long, _sequence long, _offset long",
    )
    ranked = rows.join(begins.drop("_n"), ["length", "part"]).withColumn("_rank", F.col("_begin") + F.col("nth"))
    last = F.col("_first") + F.col("_each_n") - 1
    here = (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), last)
    nth = F.col("_rank") - F.col("_first")
    # The plan has at most a row for each pair of lengths: a constant bound.
    return ranked.join(F.broadcast(slots), here).select(
        *[c for c in rows.columns if c not in ("part", "nth")],
        (F.col("_sequence") + F.expr("(_rank - _first) div _each")).alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).alias("offset"),
    )


PLACED = ["doc_id", "piece", "start", "length", "offset"]
SEQUENCE = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("ids", pa.binary()),
        ("pieces", pa.list_(pa.struct([(c, pa.int32() if c == "piece" else pa.int64()) for c in PLACED]))),
    ]
)
SEQUENCE_SCHEMA = (
    "sequence_id long, ids binary, pieces array<struct<doc_id: long, piece: int, start: long, length: long, offset: long>>"
)


def sequences(packed_rows: DataFrame) -> DataFrame:
    """The token sequences of packed pieces with ids: ids of four bytes, and the pieces in their order."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, open_id, ids, placed = [], None, [], []
        for batch in in_slices(batches):
            for row in batch.to_pylist():
                if placed and row["sequence_id"] != open_id:
                    done.append((open_id, b"".join(ids), placed))
                    ids, placed = [], []
                open_id = row["sequence_id"]
                width = len(row["ids"]) // row["length"]
                ids.append(np.frombuffer(row["ids"], dtype=f"<u{width}").astype("<u4").tobytes())
                placed.append({c: row[c] for c in PLACED})
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), SEQUENCE.types)], schema=SEQUENCE)
                done = []
        if placed:
            last = [(open_id, b"".join(ids), placed)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*last), SEQUENCE.types)], schema=SEQUENCE)

    in_order = packed_rows.select("sequence_id", *PLACED, "ids").repartition("sequence_id")
    return in_order.sortWithinPartitions("sequence_id", "offset").mapInArrow(join, SEQUENCE_SCHEMA)


def packed_sequences(docs: DataFrame) -> DataFrame:
    """All documents as token sequences: sequence_id, ids, and the pieces that they are made of."""
    return sequences(packed(written(pieces(docs).drop("ids_crc32"), "pieces", compression="zstd")))


def pack_documents(docs: DataFrame) -> DataFrame:
    """The pieces of all documents as they stand in the token sequences, with their ids."""
    placed = packed_sequences(docs).select("sequence_id", F.col("ids").alias("_ids"), F.explode("pieces").alias("_p"))
    ids = F.substring(F.col("_ids"), (F.col("_p.offset") * 4 + 1).cast("int"), (F.col("_p.length") * 4).cast("int"))
    piece = placed.select("_p.doc_id", "_p.piece", "_p.start", "_p.length", "sequence_id", "_p.offset", ids.alias("ids"))
    return piece.withColumn("ids_crc32", F.crc32("ids"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens: digests of what the sequences hold."""
    return pack_documents(read(spark, sf_dir, "documents")).drop("ids")
