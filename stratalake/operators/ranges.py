"""Value ranges of a column for table layouts, with about equally many rows in each.

The ends of ranges are quantiles of the column's own values: for numbers, dates and times from mergeable
quantile sketches, which tasks fill and the shuffle adds up; for all other types from the ranks of sampled values. More
than ``MOST_ENDS`` are found in two levels, ``coarse`` ranges and the ``fine`` ones in each, so that no sketch, list or
literal holds more of them, whatever the size of the table.

The rows of a value that is an end, or several ends at once, are dealt to the ranges that it parts, so that a frequent
value spans as many as it fills. NULL is the smallest value, NaN the largest, as in Spark's order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from stratalake.session import scratch_path

MOST_ENDS = 256
# Ranks are exact to some 0.03 %, a tenth of the smallest range.
SKETCH_SIZE = 8192
SAMPLED_PER_RANGE = 200
# Ends of texts need no more characters than tell values apart; rows are compared whole.
END_CHARACTERS = 256
LONGEST_DECIMAL = 18
SMALLEST = -(2**63)


@dataclass(frozen=True)
class Sortable:
    """How values of a type are compared: as ``bigint`` or ``double`` by a sketch, or as they are by a sample."""

    column: Column
    sketch: str | None

    @classmethod
    def of(cls, name: str, data_type: DataType) -> Sortable:
        value = F.col(f"`{name}`")
        if isinstance(data_type, (IntegralType, BooleanType)):
            number = value.cast("bigint")
        elif isinstance(data_type, DateType):
            number = F.unix_date(value).cast("bigint")
        elif isinstance(data_type, TimestampType):
            number = F.unix_micros(value)
        elif isinstance(data_type, TimestampNTZType):
            number = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{name}`)")
        elif isinstance(data_type, DecimalType) and data_type.precision <= LONGEST_DECIMAL:
            number = (value.cast("decimal(38,18)") * F.lit(10**data_type.scale).cast("decimal(19,0)")).cast("bigint")
        elif isinstance(data_type, FractionalType) and not isinstance(data_type, DecimalType):
            double = value.cast("double")
            double = F.when(F.isnan(double), F.lit(math.inf)).otherwise(double)
            return cls(F.coalesce(double, F.lit(-math.inf)), "double")
        else:
            smallest = {StringType: "", BinaryType: b""}.get(type(data_type))
            if isinstance(data_type, DecimalType):
                smallest = Decimal(-(10**data_type.precision) + 1).scaleb(-data_type.scale)
            return cls(value if smallest is None else F.coalesce(value, F.lit(smallest).cast(data_type)), None)
        return cls(F.coalesce(number, F.lit(SMALLEST)), "bigint")


def _ends(rows: DataFrame, sortable: Sortable, data_type: DataType, by: list[str], ranges: int) -> DataFrame:
    """``_ends`` for each group: ``ranges`` - 1 values in order, or none for a group without any.

    Where there is no sketch for the type, ``rows`` are a sample."""
    if sortable.sketch:
        sketch = getattr(F, f"kll_sketch_agg_{sortable.sketch}")("_value", F.lit(SKETCH_SIZE))
        ranks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        quantiles = getattr(F, f"kll_sketch_get_quantile_{sortable.sketch}")("_sketch", ranks)
        filled = getattr(F, f"kll_sketch_get_n_{sortable.sketch}")("_sketch") > 0
        return rows.groupBy(*by).agg(sketch.alias("_sketch")).select(*by, F.when(filled, quantiles).alias("_ends"))
    long = isinstance(data_type, (StringType, BinaryType))
    kept = F.substring("_value", 1, END_CHARACTERS) if long else F.col("_value")
    sampled = rows.filter("_value IS NOT NULL").select(*by, kept.alias("_value"))
    listed = sampled.groupBy(*by).agg(F.sort_array(F.collect_list("_value")).alias("_list"))
    nth = F.expr(f"transform(sequence(1, {ranges - 1}), i -> get(_list, cast(i * size(_list) div {ranges} as int)))")
    return listed.select(*by, F.when(F.size("_list") > 0, nth).alias("_ends"))


def _lasts(ends: list) -> list[int]:
    """For each end, how many ends are no greater."""
    found = [len(ends)] * len(ends)
    for i in range(len(ends) - 2, -1, -1):
        found[i] = found[i + 1] if ends[i] == ends[i + 1] else i + 1
    return found


def _placed(df: DataFrame, into: str, value: str, ends: Column, lasts: Column, n_ends: int, salt: Column) -> DataFrame:
    """``df`` with the number of each value's range: how many ends are smaller, and for a value that is an end or several,
    by ``salt`` one of the ranges that these part.

    Each step of the halving is a projection, so that all of them are compiled; a loop over an array would be interpreted.
    """
    place = F.col(into)
    df = df.withColumn(into, F.lit(0))
    for size in (1 << i for i in range(n_ends.bit_length() - 1, -1, -1)):
        df = df.withColumn(into, F.when(F.get(ends, place + (size - 1)) < F.col(value), place + size).otherwise(place))
    upto = F.when(F.get(ends, place) == F.col(value), F.get(lasts, place)).otherwise(place)
    return df.withColumn(into, (place + F.pmod(salt, upto - place + 1)).cast("int"))


def _placed_first(df: DataFrame, into: str, value: str, ends: list, salt: Column) -> DataFrame:
    literals, lasts = (F.array(*[F.lit(x) for x in listed]) for listed in (ends, _lasts(ends)))
    return _placed(df, into, value, literals, lasts, len(ends), salt) if ends else df.withColumn(into, F.lit(0))


@dataclass(frozen=True)
class ValueRanges:
    """The ends of ``coarse`` times ``fine`` ranges of a column; ranges are numbered in the order of values."""

    column: str
    coarse: int
    fine: int
    first_ends: list
    # A row for each coarse range, where these are parted again.
    ends: DataFrame | None

    @property
    def n(self) -> int:
        return self.coarse * self.fine

    def assign(self, df: DataFrame, into: str) -> DataFrame:
        """``df`` with the number of each row's range. Rows of frequent values are dealt by the rest of the row and its task."""
        # No column begins with so many underscores.
        free = "_" * (1 + max(len(c) - len(c.lstrip("_")) for c in df.columns))
        value, dealt, place, of, ends, lasts = (f"{free}{n}" for n in ("value", "salt", "place", "of", "ends", "lasts"))
        columns = [F.col(f"`{c}`") for c in df.columns]
        salt = F.xxhash64(F.spark_partition_id(), *columns)
        sortable = Sortable.of(self.column, df.schema[self.column].dataType)
        marked = df.select(*columns, sortable.column.alias(value), salt.alias(dealt))
        marked = _placed_first(marked, place, value, self.first_ends, F.col(dealt))
        if self.ends is None:
            return marked.select(*columns, F.col(place).alias(into))
        # At most MOST_ENDS rows of as many ends.
        not_greater = F.transform("_ends", lambda e: F.size(F.filter("_ends", lambda x: x <= e)))
        listed = self.ends.select(F.col("_coarse").alias(of), F.col("_ends").alias(ends), not_greater.alias(lasts))
        joined = marked.join(F.broadcast(listed), F.col(place) == F.col(of), "left").withColumnRenamed(place, of + "_place")
        again = F.shiftright(dealt, 16)
        joined = _placed(joined, place, value, F.col(ends), F.col(lasts), self.fine - 1, again)
        return joined.select(*columns, (F.col(of + "_place") * self.fine + F.col(place)).alias(into))


def value_ranges(df: DataFrame, column: str, ranges: int) -> ValueRanges:
    """At least ``ranges`` ranges, at most ``MOST_ENDS`` squared, of about equally many rows.

    The column alone is read before the actual work begins: once, or twice for more than ``MOST_ENDS`` ranges.
    """
    wanted = min(max(1, ranges), MOST_ENDS**2)
    coarse = math.ceil(math.sqrt(wanted))
    fine = math.ceil(wanted / coarse)
    if coarse * fine <= MOST_ENDS:
        coarse, fine = coarse * fine, 1
    data_type = df.schema[column].dataType
    sortable = Sortable.of(column, data_type)
    values = df.select(sortable.column.alias("_value"), F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()).alias("_salt"))
    rows = 1 if sortable.sketch else max(1, df.count())
    share = lambda n: min(1.0, n * SAMPLED_PER_RANGE / rows)
    sampled = lambda n: values if sortable.sketch else values.sample(share(n), seed=17)
    found = _ends(sampled(coarse), sortable, data_type, [], coarse).first() if coarse > 1 else None
    first_ends = list(found["_ends"] or []) if found else []
    if fine == 1:
        return ValueRanges(column, coarse, fine, first_ends, None)
    placed = _placed_first(sampled(coarse * fine), "_coarse", "_value", first_ends, F.col("_salt"))
    ends = _ends(placed, sortable, data_type, ["_coarse"], fine)
    path = scratch_path(df.sparkSession, "range-ends")
    ends.write.parquet(path)
    return ValueRanges(column, coarse, fine, first_ends, df.sparkSession.read.schema(ends.schema).parquet(path))
