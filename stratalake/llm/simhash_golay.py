"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each a word of the perfect (23,12)
Golay code with leading zeros. Decoding gives the index of the nearest codeword. A
word at distance three from its codeword has five more codewords at distance four;
those are the indices that a word can decode to when one of its bits is changed. So
of two words that differ in one bit, each one's own index is among the other's.

Three differing bits fall on three segments. Either a segment is free of them, and
another has at most one: the key is the free segment and the index of the other. Or
each segment has one: the key is the indices of two segments and the half of the
third that is free. Every fingerprint stores the keys of its own indices. Where
segments differ in one bit, one has an even number of ones and the other an odd
one; only the even one asks with its other indices too. Keys have 32 bits and more, so
that rows that meet by chance stay few.

Equal fingerprints are one row from the start. The rows of a key are compared in a
task; links that a spanning forest does not need are left out, so what comes out is
linear in the rows. Should more than ``LARGE_KEY`` different fingerprints share a
key, they are linked another way: each stands at all points within two bits, and
whoever stands at a point within one bit is linked to all others there.

Connected fingerprints get the smallest id. Texts without words have fingerprint
zero, null texts too. Rows without an id belong to the group of their fingerprint;
a group without any id has none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stratalake.llm.common import in_slices, read, written

SHINGLE_WORDS = 3
MOST_BITS = 3
SEED = 42
# Segments: first bit and number of bits.
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
# Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
LARGE_KEY = 50_000
SCHEMA = "key long, fp long"


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    last = max(1, len(words) - size + 1)
    n = min(size, len(words)) - 1
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[starts[i] : ends[i + n]], SEED) for i in range(last)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, last, 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint ``fp`` in the place of ``text``."""
    others = [c for c in docs.columns if c not in ("text", "fp")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            made = [fingerprint(t, size) for t in batch.column("text").to_pylist()]
            columns = [*[batch.column(c) for c in others], pa.array(made, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "fp"])

    schema = StructType([*[docs.schema[c] for c in others], StructField("fp", LongType())])
    return docs.select(*[F.col(f"`{c}`") for c in others], "text").mapInArrow(rows, schema)


def _remainder(words: np.ndarray) -> np.ndarray:
    """The syndrome: the remainder of 23-bit words by the generator."""
    left = words.copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


def error_table() -> np.ndarray:
    """The only error of at most three bits for each of the 2,048 syndromes."""
    errors = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)]
    errors = np.array(errors, dtype=np.int64)
    table = np.zeros(2048, dtype=np.int64)
    table[_remainder(errors)] = errors
    return table


def decode(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Indices of the nearest codewords."""
    return (words ^ table[_remainder(words)]) >> 11


def segments(fps: np.ndarray) -> list[np.ndarray]:
    unsigned = fps.astype(np.int64).view(np.uint64)
    return [((unsigned >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


def nearby(words: np.ndarray, bits: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All indices with one bit changed or none, without repeats: row numbers and indices."""
    changed = np.concatenate([words[:, None], words[:, None] ^ (1 << np.arange(bits))[None, :]], axis=1)
    found = np.sort(decode(changed.ravel(), table).reshape(changed.shape), axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(first)[0], found[first]


def keys_of(fps: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of fingerprints; two fingerprints within three bits share a key."""
    parts = segments(fps)
    own = [decode(p, table) for p in parts]
    near = [nearby(p, n, table) for p, (_, n) in zip(parts, SEGMENTS)]
    odd = [np.bitwise_count(p) & 1 for p in parts]
    everyone = np.arange(len(fps))
    rows, keys = [], []

    def add(kind: int, row: np.ndarray, key: np.ndarray) -> None:
        rows.append(row)
        keys.append((kind << 40) | key)

    kind = 0
    for free in range(3):
        for other in range(3):
            if free != other:
                add(kind, everyone, parts[free] << 12 | own[other])
                row, index = near[other]
                asks = (odd[other][row] == 0) & (index != own[other][row])
                add(kind, row[asks], parts[free][row[asks]] << 12 | index[asks])
                kind += 1
    halves = [parts[2] & 0x7FF, parts[2] >> 11]
    (row_a, index_a), (row_b, index_b) = near[0], near[1]
    begin = np.searchsorted(row_b, everyone)
    n_b = np.searchsorted(row_b, everyone, side="right") - begin
    even = odd[0][row_a] == 0
    row_a, index_a = row_a[even], index_a[even]
    repeats = n_b[row_a]
    row = np.repeat(row_a, repeats)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
    both = np.repeat(index_a, repeats) << 12 | index_b[begin[row] + nth]
    asks = both != (own[0][row] << 12 | own[1][row])
    for half in halves:
        add(kind, everyone, half << 24 | own[0] << 12 | own[1])
        add(kind, row[asks], half[row[asks]] << 24 | both[asks])
        kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def _key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    table = error_table()
    for batch in batches:
        fps = batch["fp"].to_numpy()
        for at in range(0, len(fps), 5000):
            some = fps[at : at + 5000]
            row, key = keys_of(some, table)
            yield pd.DataFrame({"key": key, "fp": some[row]})


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; numpy counts those of the absolute value of signed numbers."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fps: np.ndarray, most_bits: int = MOST_BITS) -> list[tuple[int, int]]:
    """Links that connect what is connected by links of at most ``most_bits`` bits."""
    left = np.unique(fps)
    found = []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            here = reached.pop()
            near = distance(left, np.int64(here)) <= most_bits
            reached += left[near].tolist()
            found += [(int(here), int(x)) for x in left[near]]
            left = left[~near]
    return found


def _links(most_bits: int, large: int):
    """Links among the rows of equal keys, which follow each other; (fp, null) where a key is large."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, kept, over = None, [], False

        def close() -> list:
            return [] if over or len(kept) < 2 else forest(np.array(kept, dtype=np.int64), most_bits)

        for batch in batches:
            keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy()
            starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1])
            ends = np.concatenate([starts[1:], [len(keys)]])
            out: list[tuple[int, int | None]] = []
            # Keys of this batch with one row or two, but for the first and the last, are done at once.
            inner = np.zeros(len(starts), dtype=bool)
            inner[1:-1] = True
            pairs = starts[inner & (ends - starts == 2)]
            close_by = pairs[distance(fps[pairs], fps[pairs + 1]) <= most_bits]
            different = close_by[fps[close_by] != fps[close_by + 1]]
            out += zip(fps[different].tolist(), fps[different + 1].tolist())
            for n in np.nonzero(~inner | (ends - starts > 2))[0]:
                group = fps[starts[n] : ends[n]].tolist()
                if keys[starts[n]] != key:
                    out += close()
                    key, kept, over = keys[starts[n]], [], False
                kept += group
                if len(kept) > large:
                    kept, was_over = list(set(kept)), over
                    if len(kept) > large or was_over:
                        out += [(fp, None) for fp in kept]
                        kept, over = [], True
                elif over:
                    out += [(fp, None) for fp in kept]
                    kept = []
            if out:
                yield pd.DataFrame({"a": [a for a, _ in out], "b": pd.array([b for _, b in out], dtype="Int64")})
        if out := close():
            yield pd.DataFrame({"a": [a for a, _ in out], "b": pd.array([b for _, b in out], dtype="Int64")})

    return run


def ball_links(fps: DataFrame) -> DataFrame:
    """Links among fingerprints within three bits: one is within one bit of a point, the other within two."""
    one = [0, *[1 << i for i in range(64)]]
    two = [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]
    signed = lambda masks: F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])
    point = lambda masks: fps.select("fp", F.explode(signed(masks)).alias("_m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("_m")).alias("point")
    )
    close = point(one)
    hubs = close.groupBy("point").agg(F.min("fp").alias("a"))
    return close.unionByName(point(two)).join(hubs, "point").filter("a <> fp").select("a", F.col("fp").alias("b"))


def links(fps: DataFrame, most_bits: int = MOST_BITS, large: int = LARGE_KEY) -> DataFrame:
    """Links (a, b) among different fingerprints ``fp`` that connect all within ``most_bits`` bits.

    At most three bits: the keys are made for that.
    """
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"most_bits must be 0 to {MOST_BITS}")
    keyed = fps.select("fp").mapInPandas(_key_rows, SCHEMA)
    in_runs = keyed.repartition("key").sortWithinPartitions("key")
    found = written(in_runs.mapInPandas(_links(most_bits, large), "a long, b long"), "links")
    pairs = found.filter("b IS NOT NULL")
    crowded = found.filter("b IS NULL")
    if not crowded.isEmpty():
        if most_bits < MOST_BITS:
            raise ValueError("large keys are linked at three bits only")
        pairs = pairs.unionByName(ball_links(crowded.select(F.col("a").alias("fp")).distinct()))
    return pairs.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for all nodes of ``edges`` (a, b).

    Large and small stars in turn: every node hands its neighbours to the smallest,
    until nothing changes. Each round is a written table.
    """

    def stars(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        directed = both if larger else edges
        least = written(directed.groupBy("a").agg(F.min("b").alias("m")), "least")
        least = least.select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
        # Both sides are tables, so that adaptive execution can split a hot node.
        joined = directed.join(least, F.col("a") == F.col("_a"))
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if larger:
            moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.unionByName(least.select(F.col("_a").alias("a"), F.col("m").alias("b")))
        return moved.filter("a <> b").distinct()

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    current = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last = mark(current)
    while last[0]:
        current = written(stars(written(stars(current, True), "stars"), False), "stars")
        if (now := mark(current)) == last:
            break
        last = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """All columns but the text, with fp, component_id and ``root``, a fingerprint of the component; these are replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("fp", "component_id", "root")])
    rows = written(fingerprints(docs, size), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    roots = components(links(classes, most_bits))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "roots")
    smallest = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = written(rooted.select("fp", "root").join(smallest, "root"), "components")
    return rows.join(named, "fp")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
