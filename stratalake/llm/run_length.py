"""Removal of repeated passages with run-length indexes.

A string of ``LENGTH`` bytes is removed where it also starts earlier: in a document with a smaller id, or
further up in the same one. Strings are compared in buckets, so that no task needs the corpus:

1. Each string of ``LENGTH`` bytes holds an anchor, the leftmost of its ``GRAM``-byte grams with the least hash. The choice
   depends on the string alone, so equal strings have equal anchors. Strings that begin side by side and have one anchor
   make up a piece of text. Of equal pieces all but the first are repeats; tasks
   settle that for their own documents first, so that frequent passages are a row per task.
2. Anchors with several different pieces are looked at again, by a key that takes in more bytes. The pieces whose key is
   not theirs alone go into buckets of whole keys. For the text of a bucket a suffix array is sorted and its Burrows-Wheeler transform cut into runs. At the start of each run the neighbour of the suffix and
   the number of bytes they share are sampled. Those samples are enough: going through the text, the longest match of each place
   is that of the place before less one byte, unless it is sampled itself. Places that match over ``LENGTH`` bytes are linked
   to their neighbours; in each class of linked places all but the earliest are repeats.
3. Marked strings are merged per document and cut out.

Keys take in more bytes by division: strings that begin further left from the anchor share more bytes before it, others
more bytes after it. All pieces are divided once, those of a key with more than ``LARGEST_GROUP`` of them again and again.
Divided to the end, all strings of a key are equal, and their first is found by an aggregation.

Documents count in the order of their ids, rows with one id in the order of a hash of their texts, rows without an
id last; copies of one row are repeats of the first. Null texts are empty; texts shorter than ``LENGTH`` stay as
they are. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read. Texts are read whole. What is kept is
binary, because a cut may fall inside a character. Grams and pieces are compared by hashes of 64 bits each, 128 in
all; matches in buckets by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import in_slices, read, written

LENGTH = 100
GRAM = 20
# An anchor is in a string of LENGTH bytes that begins at most this far before it.
REACH = LENGTH - GRAM
CHUNK = 1 << 20
BUCKET_BYTES = 1 << 20
LARGEST_GROUP = 10_000
SEED = 42
BETWEEN, AFTER = 0xFF, 0xFE  # in no UTF-8 text
INDEX_BITS = 21  # places of a chunk and its overlap
FACTOR = np.uint64(0x9E3779B97F4A7C15)
NAMES = ["key", "content", "no_id", "doc_id", "tie", "start", "end", "anchor"]
ROW = "key long, content long, no_id boolean, doc_id long, tie long, start long, end long, anchor int"
NO_ANCHOR = -1
PLACE = ["no_id", "doc_id", "tie"]


def byte_values() -> np.ndarray:
    """A random number for each byte, from a fixed seed."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hashes of all grams of ``GRAM`` bytes: doubled lengths, and their sum for what is left."""
    by_size = {1: values[data]}
    size, factor = 1, FACTOR
    factors = {1: factor}
    with np.errstate(over="ignore"):
        while size * 2 <= GRAM:
            h = by_size[size]
            by_size[size * 2] = h[:-size] * factors[size] + h[size:]
            factors[size * 2] = factors[size] * factors[size]
            size *= 2
        h, done = by_size[size], size
        while done < GRAM:
            size = 1 << ((GRAM - done).bit_length() - 1)
            n = len(data) - done - size + 1
            h = h[:n] * factors[size] + by_size[size][done : done + n]
            done += size
        h = (h ^ (h >> np.uint64(32))) * FACTOR
        return h ^ (h >> np.uint64(29))


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of the least one, the leftmost of equal ones."""
    low = np.uint64((1 << INDEX_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    return (least & low).astype(np.int64)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint spans that cover the same; spans that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(starts), dtype=bool)
    first[1:] = starts[1:] > reach[:-1]
    begins = np.flatnonzero(first)
    return starts[begins], reach[np.append(begins[1:], len(starts)) - 1]


class Chunk:
    """Documents whose anchors are found together."""

    def __init__(self) -> None:
        self.values = byte_values()
        self.parts: list[tuple[tuple[bool, int, int], int, bytes]] = []
        self.size = 0

    def add(self, place: tuple[bool, int, int], data: bytes) -> Iterator[pa.RecordBatch]:
        """A long document is read in parts: the strings that begin in ``CHUNK`` bytes."""
        for at in range(0, len(data) - LENGTH + 1, CHUNK):
            part = data[at : at + CHUNK + LENGTH - 1]
            self.parts.append((place, at, part))
            self.size += len(part)
            if self.size >= CHUNK // 2:
                yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Pieces (key, content, place, start, end, anchor) and spans that are repeats, of the documents held."""
        parts, self.parts, self.size = self.parts, [], 0
        if not parts:
            return
        # Documents in order: of equal pieces the first counts. A row that is repeated is no repeat of itself.
        parts = list({part[:2]: part for part in sorted(parts, key=lambda part: part[:2])}.values())
        joined = b"".join(part[2] for part in parts)
        hashes = gram_hashes(np.frombuffer(joined, dtype=np.uint8), self.values)
        least = least_places(hashes, REACH + 1)
        lengths = np.array([len(part[2]) for part in parts])
        begins = np.cumsum(lengths) - lengths
        inside = np.ones(len(joined), dtype=bool)
        for begin, length in zip(begins.tolist(), lengths.tolist()):
            inside[begin + length - LENGTH + 1 : begin + length] = False
        strings = np.flatnonzero(inside)
        places = least[strings]
        first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        places, low = places[first], strings[first]
        high = strings[np.append(first[1:], len(strings)) - 1] + LENGTH
        owner = np.searchsorted(begins, low, side="right") - 1
        one = xxhash.xxh3_64_intdigest
        content = np.array([one(joined[a:b]) for a, b in zip(low.tolist(), high.tolist())], dtype=np.uint64).view(np.int64)
        keys = hashes[places].view(np.int64)
        order = np.lexsort((low, content, keys))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (content[order][1:] != content[order][:-1])
        shift = np.array([part[1] for part in parts]) - begins
        keep, again = np.sort(order[new]), np.sort(order[~new])
        move = shift[owner[keep]]
        anchors = (places - low)[keep]
        yield self._batch(parts, keys[keep], content[keep], owner[keep], low[keep] + move, high[keep] + move, anchors)
        if len(again):
            # Spans of one part that overlap are one; those of different parts are kept apart.
            apart = np.arange(len(parts))
            starts, ends = merged(low[again] + apart[owner[again]], high[again] + apart[owner[again]])
            of = np.searchsorted(begins + apart, starts, side="right") - 1
            move = shift[of] - apart[of]
            # The key spreads spans over the partitions.
            yield self._batch(parts, starts * 31 + of, of, of, starts + move, ends + move, np.full(len(of), NO_ANCHOR))

    @staticmethod
    def _batch(parts, keys, content, owner, starts, ends, anchors) -> pa.RecordBatch:
        columns = [pa.array(c) for c in (keys, content, *zip(*[parts[o][0] for o in owner.tolist()]), starts, ends)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(anchors, pa.int32())], NAMES)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = Chunk()
    for batch in in_slices(batches):
        *place, texts = [batch.column(c).to_pylist() for c in (*PLACE, "text")]
        for where, text in zip(zip(*place), texts):
            yield from chunk.add(where, text.encode())
    yield from chunk.rows()


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key, content and place: spans that are repeats, and the places of pieces that are to be indexed.

    The first of equal pieces is held back until the next shows whether its key has others.
    """
    held, held_is_first = None, False
    for batch in batches:
        has_anchor = (batch["anchor"] != NO_ANCHOR).to_numpy()
        if not has_anchor.all():
            yield batch[~has_anchor][FOUND]
        rows = batch[has_anchor]
        if not len(rows):
            continue
        if held is not None:
            rows = pd.concat([held, rows], ignore_index=True)
        key, content = rows["key"].to_numpy(), rows["content"].to_numpy()
        new_key = np.ones(len(rows), dtype=bool)
        new_key[1:] = key[1:] != key[:-1]
        new = new_key.copy()
        new[1:] |= content[1:] != content[:-1]
        if held is not None:
            new_key[0] = held_is_first
        firsts, again = np.flatnonzero(new), np.flatnonzero(~new)
        if len(again):
            before = firsts[np.searchsorted(firsts, again, side="right") - 1]
            same_row = np.logical_and.reduce([rows[c].to_numpy()[again] == rows[c].to_numpy()[before] for c in (*PLACE, "start")])
            yield rows.iloc[again[~same_row]].assign(anchor=np.int32(NO_ANCHOR))[FOUND]
        others = ~new_key[firsts]
        asked = others.copy()
        asked[:-1] |= others[1:]
        chosen = firsts[:-1][asked[:-1]]
        if len(chosen):
            yield rows.iloc[chosen][FOUND]
        held, held_is_first = rows.iloc[[firsts[-1]]], bool(new_key[firsts[-1]])
    if held is not None and not held_is_first:
        yield held[FOUND]


FOUND = ["key", *PLACE, "start", "end", "anchor"]
FOUND_SCHEMA = "key long, no_id boolean, doc_id long, tie long, start long, end long, anchor int"


def placed(docs: DataFrame) -> DataFrame:
    """Texts with the three columns that say which document comes first."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text")
    )


def _packed_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as rows for ``beside``, compressed: they pass through a shuffle."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in in_slices(batches):
        packed = pa.array([packer.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        nothing = pa.array(np.zeros(batch.num_rows, dtype=np.int64))
        others = [nothing, nothing, nothing.cast(pa.int32()), nothing, packed]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in PLACE], *others], BESIDE)


BESIDE = [*PLACE, "start", "end", "anchor", "key", "packed"]
BESIDE_SCHEMA = "no_id boolean, doc_id long, tie long, start long, end long, anchor int, key long, packed binary"


def beside(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows (start, end, anchor, key) and the texts they are in, one after the other in a partition; rows come first."""
    packed = texts.mapInArrow(_packed_text, BESIDE_SCHEMA)
    listed = rows.select(*BESIDE[:-1], F.lit(None).cast("binary").alias("packed"))
    dealt = packed.unionByName(listed).repartition(*PLACE)
    return dealt.sortWithinPartitions(*PLACE, F.col("packed").isNotNull())


def _texts_with_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes, list[tuple[int, int, int, int]], bool]]:
    """Each text with its rows (start, end, anchor, key), and whether it is a copy of the row before."""
    unpacker = zstandard.ZstdDecompressor()
    rows, of, last = [], None, None
    for batch in in_slices(batches, 4096):
        columns = [batch.column(c).to_pylist() for c in BESIDE[:-1]]
        packed = batch.column("packed")
        for i, (no_id, doc_id, tie, *row) in enumerate(zip(*columns)):
            place = (no_id, doc_id, tie)
            if place != of:
                rows, of = [], place
            if packed[i].is_valid:
                yield place, unpacker.decompress(packed[i].as_buffer()), rows, place == last
                last = place
            else:
                rows.append(tuple(row))


PIECES = ["key", *PLACE, "start", "anchor", "from_left", "to_left", "piece"]
PIECES_SCHEMA = (
    "key long, no_id boolean, doc_id long, tie long, start long, anchor int, from_left int, to_left int, piece binary"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their bytes; their strings begin from ``from_left`` to ``to_left`` bytes before the anchor."""
    out = []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=PIECES), schema=PIECES_ARROW, preserve_index=False)

    for place, data, asked, is_copy in _texts_with_rows(batches):
        if is_copy:
            continue
        out += [(key, *place, start, anchor, 0, REACH, data[start:end]) for start, end, anchor, key in asked]
        if len(out) > 5_000:
            yield rows()
            out = []
    if out:
        yield rows()


PIECES_ARROW = pa.schema(
    [
        ("key", pa.int64()),
        ("no_id", pa.bool_()),
        ("doc_id", pa.int64()),
        ("tie", pa.int64()),
        ("start", pa.int64()),
        ("anchor", pa.int32()),
        ("from_left", pa.int32()),
        ("to_left", pa.int32()),
        ("piece", pa.binary()),
    ]
)


def divided(pieces: DataFrame) -> DataFrame:
    """Pieces cut in two: the strings that begin near the anchor and those that begin far from it.

    Strings that begin ``from_left`` to ``to_left`` bytes before the anchor share what lies between the last
    beginning and the first end; that becomes the key.
    """
    middle = F.expr("(from_left + to_left) div 2").cast("int")
    near = F.struct(F.col("from_left").alias("f"), middle.alias("t"))
    far = F.struct((middle + 1).alias("f"), F.col("to_left").alias("t"))
    halves = pieces.withColumn("_h", F.explode(F.array(near, far))).withColumns({"from_left": F.col("_h.f"), "to_left": F.col("_h.t")})
    # Not every piece has strings of both kinds.
    first = F.greatest(F.col("anchor") - F.col("to_left"), F.lit(0))
    last = F.least(F.col("anchor") - F.col("from_left") + LENGTH, F.length("piece"))
    cut = halves.withColumns({"_first": first, "_last": last}).filter(F.col("_last") - F.col("_first") >= LENGTH)
    shared = F.substring(
        F.col("piece"), F.col("anchor") - F.col("from_left") + 1, F.lit(LENGTH) - (F.col("to_left") - F.col("from_left"))
    )
    return cut.select(
        F.xxhash64("key", "from_left", "to_left", shared).alias("key"),
        *PLACE,
        (F.col("start") + F.col("_first")).alias("start"),
        (F.col("anchor") - F.col("_first")).cast("int").alias("anchor"),
        "from_left",
        "to_left",
        F.substring(F.col("piece"), F.col("_first") + 1, F.col("_last") - F.col("_first")).alias("piece"),
    )


def indexed_spans(pieces: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """Spans (no_id, doc_id, tie, start, end) of strings that are repeats, from pieces that meet under a key."""
    spans = None
    pieces = divided(pieces)
    while True:
        pieces = written(pieces, "pieces")
        sizes = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
        hot = written(sizes.filter(F.col("_n") > largest).select(F.col("key").alias("_key")), "hot-anchors")
        none_hot = hot.isEmpty()
        cold = pieces if none_hot else pieces.join(hot, F.col("key") == F.col("_key"), "left_anti")
        in_runs = cold.repartition("key").sortWithinPartitions("key", "piece", *PLACE, "start")
        found = in_runs.mapInArrow(_bucket_spans, "no_id boolean, doc_id long, tie long, start long, end long")
        spans = found if spans is None else spans.unionByName(found)
        if none_hot:
            return spans
        pieces = pieces.join(hot, F.col("key") == F.col("_key"), "left_semi")
        whole = pieces.filter("from_left = to_left")
        # All strings of a key are equal now.
        place = F.struct(*PLACE, "start")
        first = written(whole.groupBy(F.col("piece").alias("_piece")).agg(F.min(place).alias("_first")), "first-strings")
        later = whole.join(first, F.col("piece") == F.col("_piece")).filter(place != F.col("_first"))
        spans = spans.unionByName(later.select(*PLACE, "start", (F.col("start") + LENGTH).alias("end")))
        pieces = divided(pieces.filter("from_left < to_left"))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that they are sorted by; it starts with eight bytes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    rank = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        rank = (rank << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(rank)
    size = 8
    in_order = rank[order]
    while True:
        new = np.ones(n, dtype=np.int64)
        new[1:] = in_order[1:] != in_order[:-1]
        by_order = np.cumsum(new)
        rank = np.empty(n, dtype=np.int64)
        rank[order] = by_order
        if by_order[-1] == n:
            return order
        second = np.zeros(n, dtype=np.int64)
        second[: n - size] = rank[size:]
        both = rank * np.int64(n + 1) + second
        order = np.argsort(both)
        in_order = both[order]
        size *= 2


def shared_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the texts from different places ``a`` and ``b`` have in common."""
    padded = np.append(text, np.uint8(AFTER))
    shared = np.zeros(len(a), dtype=np.int64)
    going, n = np.arange(len(a)), 0
    while len(going):
        going = going[padded[a[going] + n] == padded[b[going] + n]]
        shared[going] += 1
        n += 1
    return shared


class RunLengthIndex:
    """What the run-compressed Burrows-Wheeler transform of a text keeps: a sample for each run.

    A run starts where a suffix is not preceded by the byte that precedes its neighbour. There the neighbour and
    the bytes they share are kept. Within a run, both suffixes and their neighbours are one byte further to the left of
    suffixes that are neighbours, too; so the match of any place follows from the sample before it.
    """

    def __init__(self, text: np.ndarray) -> None:
        order = suffix_array(text)
        transformed = text[order - 1]  # the text is read as a ring
        starts = np.ones(len(order), dtype=bool)
        starts[1:] = transformed[1:] != transformed[:-1]
        # The ring closes at the first place, which has no byte before it.
        starts |= order == 0
        starts[1:] |= order[:-1] == 0
        runs = np.flatnonzero(starts)
        places, neighbours = order[runs], order[runs - 1]
        shared = np.append(0, shared_bytes(text, places[1:], neighbours[1:]))  # the first suffix has no neighbour
        by_place = np.argsort(places)
        self.n = len(text)
        self.places, self.neighbours, self.shared = places[by_place], neighbours[by_place], shared[by_place]

    def matches(self) -> tuple[np.ndarray, np.ndarray]:
        """For all places, in their order: the neighbour in the order of suffixes, and how many bytes it shares."""
        steps = np.diff(np.append(self.places, self.n))
        on = np.arange(self.n) - np.repeat(self.places, steps)
        return np.repeat(self.neighbours, steps) + on, np.maximum(np.repeat(self.shared, steps) - on, 0)


def repeated_places(text: np.ndarray, room: np.ndarray, when: np.ndarray) -> np.ndarray:
    """Places whose next ``LENGTH`` bytes are also at an earlier one.

    ``room`` is how many bytes there are up to the end of the place's piece, and ``when`` puts places in the order of the corpus.
    """
    neighbour, shared = RunLengthIndex(text).matches()
    places = np.arange(len(text))
    # Chains of linked places end in one place for each class of equal strings.
    head = np.where(shared >= LENGTH, neighbour, places)
    while True:
        onward = head[head]
        if np.array_equal(onward, head):
            break
        head = onward
    whole = room >= LENGTH
    first = np.full(len(text), np.iinfo(np.int64).max)
    np.minimum.at(first, head[whole], when[whole])
    return whole & (first[head] < when)


def _spans_of(rows: list[tuple]) -> list[tuple]:
    """Marked spans of the pieces (no_id, doc_id, tie, start, piece) of a bucket."""
    rows.sort(key=lambda row: row[:4])
    data = bytes([BETWEEN]).join([row[4] for row in rows] + [b""])
    text = np.frombuffer(data, dtype=np.uint8)
    lengths = np.array([len(row[4]) + 1 for row in rows])
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(rows)), lengths)
    on = np.arange(len(text)) - begins[owner]
    doc = np.cumsum([i > 0 and rows[i][:3] != rows[i - 1][:3] for i in range(len(rows))])
    when = (doc[owner] << 40) + np.array([row[3] for row in rows])[owner] + on
    repeated = np.flatnonzero(repeated_places(text, lengths[owner] - 1 - on, when))
    # A separator keeps the spans of two pieces apart.
    starts, ends = merged(repeated, repeated + LENGTH)
    of = owner[starts]
    first = np.array([row[3] for row in rows])[of]
    return [(*rows[o][:3], a, b) for o, a, b in zip(of.tolist(), (first + on[starts]).tolist(), (first + ends - begins[of]).tolist())]


def _bucket_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key and content: of equal ones all but the first are repeats; a bucket holds whole keys."""
    names = [*PLACE, "start", "end"]
    types = [pa.bool_(), *[pa.int64()] * 4]
    held, of_key, size, key = [], [], 0, None

    def close() -> Iterator[pa.RecordBatch]:
        if held and (spans := _spans_of(held)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*spans), types)], names)

    for batch in in_slices(batches, 4096):
        again = []
        for row_key, *row in zip(*[batch.column(c).to_pylist() for c in ("key", *PLACE, "start", "piece")]):
            if row_key != key:
                if len(of_key) > 1:
                    held += of_key
                    size += sum(len(r[-1]) + 1 for r in of_key)
                    if size >= BUCKET_BYTES:
                        yield from close()
                        held, size = [], 0
                key, of_key = row_key, []
            if of_key and of_key[-1][-1] == row[-1]:
                again.append((*row[:-1], row[-2] + len(row[-1])))
            else:
                of_key.append(tuple(row))
        if again:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*again), types)], names)
    if len(of_key) > 1:
        held += of_key
    yield from close()


KEPT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)
KEPT_SCHEMA = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), KEPT_ARROW.types)], schema=KEPT_ARROW)

    for (no_id, doc_id, _), data, marks, is_copy in _texts_with_rows(batches):
        marks = [(0, len(data))] if is_copy and len(data) >= LENGTH else marks
        starts, ends = merged(*np.array([m[:2] for m in marks], dtype=np.int64).reshape(-1, 2).T)
        ends = np.minimum(ends, len(data))
        spans = list(zip(starts.tolist(), ends.tolist()))
        kept = b"".join(data[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(data)]))
        out.append((None if no_id else doc_id, len(data), [{"start": a, "end": b} for a, b in spans], kept))
        size += len(kept)
        if len(out) >= 256 or size > 1 << 22:
            yield rows()
            out, size = [], 0
    if out:
        yield rows()


def repeated_spans(texts: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """Spans (no_id, doc_id, tie, start, end) that cover all repeated strings of ``placed`` texts; they may overlap."""
    anchors = texts.mapInArrow(_anchor_rows, ROW)
    in_runs = anchors.repartition("key").sortWithinPartitions("key", "content", *PLACE, "start")
    found = written(in_runs.mapInPandas(_compare, FOUND_SCHEMA), "anchors")
    pieces = beside(texts, found.filter(F.col("anchor") != NO_ANCHOR)).mapInArrow(_pieces, PIECES_SCHEMA)
    return found.filter(F.col("anchor") == NO_ANCHOR).select(*PLACE, "start", "end").unionByName(indexed_spans(pieces, largest))


def without_repeats(docs: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """For each row of documents: doc_id, n_bytes, the removed ``spans``, and the bytes ``kept``."""
    texts = placed(docs)
    spans = written(repeated_spans(texts, largest), "spans")
    marks = spans.withColumns({"anchor": F.lit(NO_ANCHOR), "key": F.lit(0).cast("long")})
    return beside(texts, marks).mapInArrow(_kept, KEPT_SCHEMA)


def op12_run_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 100 bytes that are also earlier."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP12_SQL = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
),
strings AS (
    SELECT doc_id, start, md5(substr(digits, 2 * start + 1, 200)) AS string
    FROM (SELECT doc_id, digits, unnest(range(length(digits) // 2 - 99)) AS start FROM texts WHERE length(digits) >= 200)
),
repeats AS (
    SELECT doc_id, start FROM strings
    QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, start) > 1
),
spans AS (
    SELECT doc_id, min(start) AS first, max(start) + 100 AS last
    FROM (
        SELECT doc_id, start, sum(is_new) OVER (PARTITION BY doc_id ORDER BY start) AS span
        FROM (SELECT doc_id, start, (start > coalesce(lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 100, -1))::INT AS is_new
              FROM repeats)
    )
    GROUP BY doc_id, span
),
kept AS (
    SELECT doc_id, string_agg(substr(digits, 2 * begins + 1, 2 * (ends - begins)), '' ORDER BY begins) AS digits
    FROM (
        SELECT s.doc_id, t.digits, s.last AS begins,
            coalesce(lead(s.first) OVER (PARTITION BY s.doc_id ORDER BY s.first), length(t.digits) // 2) AS ends
        FROM (SELECT doc_id, first, last FROM spans UNION ALL SELECT doc_id, -1, 0 FROM texts) s JOIN texts t USING (doc_id)
    )
    GROUP BY doc_id
),
counts AS (SELECT doc_id, sum(last - first)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, length(texts.digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(kept.digits)) AS kept_sha256
FROM texts JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
