"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of positions. Each shard owns many of them (virtual
nodes); a key stands at the position of its hash and belongs to the next owner
clockwise. A shard takes at most its bound: what does not fit walks on clockwise
to the next shard with room. With no headroom the bounds are such that counts
differ by one at most.

Only the counts per position, whose number is fixed, reach the driver. They say
which ranks of each position go to which shard, and every row finds its shard and
slot by its rank within its position. Copies of a row are counted before they are
ranked. A position with many different rows, such as that of a hot or null key, is
split by the rows' hashes into parts: a rank is the count of the parts before and
the rank within the part.

Rows with a null key stand at one position. An empty table gives an empty result.
Repeated rows are kept, each with a slot of its own. Columns may have any names but
``shard`` and ``slot``, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import numbered, read, utf8_bytes, written

POSITIONS = 16_384
VIRTUAL_NODES = 128
ROWS_PER_PART = 100_000
CHUNK = 65_536


@dataclass(frozen=True)
class Span:
    """Ranks of a position that go to consecutive slots of a shard."""

    position: int
    shard: int
    first_rank: int
    n_rows: int
    first_slot: int


def owners(n_shards: int, virtual_nodes: int = VIRTUAL_NODES, positions: int = POSITIONS) -> dict[int, int]:
    """The shard of each owned position. A further shard leaves the earlier ones where they are."""
    owned: dict[int, int] = {}
    for shard in range(n_shards):
        for node in range(virtual_nodes):
            digest = hashlib.blake2b(f"{shard}:{node}".encode(), digest_size=8).digest()
            place = int.from_bytes(digest, "big") % positions
            while place in owned:
                place = (place + 1) % positions
            owned[place] = shard
    return owned


def clockwise(owned: Mapping[int, int], positions: int = POSITIONS) -> list[list[int]]:
    """For each position, the shards in the order in which they are met clockwise."""
    met: list[int] = []
    orders: list[list[int]] = [[]] * positions
    for step in range(2 * positions - 1, -1, -1):
        place = step % positions
        if place in owned:
            met = [owned[place], *[s for s in met if s != owned[place]]]
        orders[place] = met
    return orders


def bounds(n_rows: int, n_shards: int, headroom: float) -> list[int]:
    """The most rows each shard may take; without headroom they add up to the number of rows."""
    if headroom > 0:
        return [-int(-(1 + headroom) * n_rows // n_shards)] * n_shards
    return [n_rows // n_shards + (shard < n_rows % n_shards) for shard in range(n_shards)]


def plan(counts: Mapping[int, int], n_shards: int, headroom: float = 0.0) -> list[Span]:
    """Where the rows of each position go; shards first take their own keys, then those passed on."""
    orders = clockwise(owners(n_shards))
    room = bounds(sum(counts.values()), n_shards, headroom)
    used, done, spans = [0] * n_shards, dict.fromkeys(counts, 0), []
    for distance in range(n_shards):
        for place in sorted(counts):
            shard = orders[place][distance]
            n = min(counts[place] - done[place], room[shard] - used[shard])
            if n > 0:
                spans.append(Span(place, shard, done[place], n, used[shard]))
                done[place] += n
                used[shard] += n
    return spans


def position_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(POSITIONS)).cast("int")


def _ranked(copies: DataFrame, columns: list[str], key: str, rows_per_part: int) -> DataFrame:
    """``copies`` (columns, position, copies) with ``rank``, the number of rows before at the position."""
    at = copies.groupBy("position").agg(F.expr(f"(count(1) - 1) div {rows_per_part} + 1").alias("n_parts"))
    # A row per position: a constant bound.
    parted = copies.join(F.broadcast(at), "position").withColumn("part", F.pmod(F.xxhash64(*columns), "n_parts"))
    sizes = parted.groupBy("position", "part").agg(F.sum("copies").alias("size"))
    parts_before = Window.partitionBy("position").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("position", "part", F.coalesce(F.sum("size").over(parts_before), F.lit(0)).alias("begin"))
    order = [F.xxhash64(key), *columns]
    rows_before = Window.partitionBy("position", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = parted.withColumn("inside", F.coalesce(F.sum("copies").over(rows_before), F.lit(0)))
    return inside.join(begins, ["position", "part"]).withColumn("rank", F.col("begin") + F.col("inside"))


def assign(rows: DataFrame, key: str, n_shards: int, headroom: float = 0.0, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; slots of a shard count from 0 without gaps.

    The rows should be narrow: keys and what else identifies them.
    """
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("shard", "slot")])
    named, names = numbered(rows)
    columns = named.columns
    counted = named.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    copies = written(counted.withColumn("position", position_of(F.col(names[key]))), "ring")
    counts = {r["position"]: r["n"] for r in copies.groupBy("position").agg(F.sum("copies").alias("n")).collect()}
    spans = rows.sparkSession.createDataFrame(
        [(s.position, s.shard, s.first_rank, s.n_rows, s.first_slot) for s in plan(counts, n_shards, headroom)],
        "at int, shard int, first long, n long, first_slot long",
    )
    ranked = _ranked(copies, columns, names[key], rows_per_part)
    # Copies of one row have ranks one after the other; they are written out in chunks.
    chunks = ranked.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK})")))
    ranks = F.expr(f"sequence(rank + chunk * {CHUNK}, rank + least(copies, (chunk + 1) * {CHUNK}) - 1)")
    every = chunks.select(*columns, "position", F.explode(ranks).alias("rank"))
    inside = (F.col("position") == F.col("at")) & F.col("rank").between(F.col("first"), F.col("first") + F.col("n") - 1)
    # At most one span per position and shard: a constant bound.
    slot = (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot")
    return every.join(F.broadcast(spans), inside).select(*columns, "shard", slot).toDF(*rows.columns, "shard", "slot")


def op1_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards whose row counts differ by one at most."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    return assign(docs, "doc_id", 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
