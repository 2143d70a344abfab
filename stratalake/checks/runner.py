"""Running many checks and reporting their outcome as a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.checks import compare, groups, rows, schema
from stratalake.functions.numbers import as_column

SEVERITIES = ("warn", "error")


@dataclass(frozen=True, eq=False)
class Key:
    """What a key check counts: repeated values of a column, or rows whose value ``parent`` lacks."""

    column: str
    parent: DataFrame | None = None
    field: str = ""
    from_condition: Column | str = "true"
    to_condition: Column | str = "true"

    @property
    def failures(self) -> str:
        return "count(*)" if self.parent is None else compare.ORPHAN_FAILURES


@dataclass(frozen=True, eq=False)
class Check:
    """One check of one table.

    A check is either a ``violation`` predicate or a ``query`` from the table to
    its violating rows. ``failures`` turns those rows into a number, and
    ``warn_if`` and ``error_if`` are conditions on that number. ``key`` says what
    the query does, where checks of keys can share a scan.
    """

    name: str
    violation: Column | str | None = None
    query: Callable[[DataFrame], DataFrame] | None = None
    where: Column | str | None = None
    failures: str = "count(*)"
    severity: str = "warn"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    owner: str | None = None
    store_as: str | None = None
    key: Key | None = None

    def __post_init__(self):
        if (self.violation is None) == (self.query is None):
            raise ValueError(f"check {self.name!r} needs either a violation or a query")
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}, got {self.severity!r}")

    def configured(self, **options) -> Check:
        if "query" in options:
            options = {"key": None, **options}
        return replace(self, **options)

    def violations(self, df: DataFrame) -> DataFrame:
        table = df if self.where is None else df.filter(self.where)
        return table.filter(self.violation) if self.query is None else self.query(table)

    @property
    def fits_one_pass(self) -> bool:
        if self.store_as or (self.query is not None and self.key is None):
            return False
        return self.failures == ("count(*)" if self.key is None else self.key.failures)


def not_null(column: str, **options) -> Check:
    return Check(f"not_null_{column}", violation=F.col(column).isNull(), **options)


def unique(column: str, **options) -> Check:
    return Check(f"unique_{column}", query=lambda df: groups.unique(df, column), key=Key(column), **options)


def accepted_range(column: str, min_value=None, max_value=None, inclusive: bool = True, **options) -> Check:
    predicate = rows.outside_range(column, min_value, max_value, inclusive)
    return Check(f"accepted_range_{column}", violation=predicate, **options)


def expression_is_true(name: str, expression: Column | str, **options) -> Check:
    return Check(name, violation=rows.expression_false(expression), **options)


def from_function(name: str, function: Callable[..., DataFrame], *args, options=None, **kwargs) -> Check:
    """Any check function with its arguments, such as ``groups.recency, "ts", "day", 1``."""
    return Check(name, query=lambda df: function(df, *args, **kwargs), **(options or {}))


def custom_query(name: str, query: str, relations=None, days_behind=None, as_of=None, **options) -> Check:
    """A query whose rows are violations; the checked table is ``{model}`` in it."""

    def run(df: DataFrame) -> DataFrame:
        named = {**(relations or {}), "model": df}
        return schema.custom_query(df.sparkSession, query, named, days_behind, as_of)

    return Check(name, query=run, **options)


def equality(name: str, other: DataFrame, compare_columns=None, **options) -> Check:
    return Check(
        name,
        query=lambda df: compare.equality(df, other, compare_columns),
        failures=compare.EQUALITY_FAILURES,
        **options,
    )


def equal_rowcount(name: str, other: DataFrame, group_by=(), **options) -> Check:
    return Check(
        name,
        query=lambda df: compare.equal_rowcount(df, other, group_by),
        failures=compare.EQUAL_ROWCOUNT_FAILURES,
        **options,
    )


def fewer_rows_than(name: str, other: DataFrame, group_by=(), **options) -> Check:
    return Check(
        name,
        query=lambda df: compare.fewer_rows_than(df, other, group_by),
        failures=compare.FEWER_ROWS_FAILURES,
        **options,
    )


def relationships(
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: Column | str = "true",
    to_condition: Column | str = "true",
    **options,
) -> Check:
    """Failures are child rows; they are summed from one counted row per orphan key."""
    return Check(
        f"relationships_{column}",
        query=lambda df: compare.orphan_counts(df, column, parent, field, from_condition, to_condition),
        failures=compare.ORPHAN_FAILURES,
        key=Key(column, parent, field, from_condition, to_condition),
        **options,
    )


def primary_key(column: str, **options) -> list[Check]:
    return [not_null(column, **options), unique(column, **options)]


def _status(check: Check) -> Column:
    warns, errors = (F.expr(f"failures {rule}") for rule in (check.warn_if, check.error_if))
    outcome = F.when(warns, F.lit("warn")).otherwise(F.lit("pass"))
    if check.severity == "error":
        outcome = F.when(errors, F.lit("fail")).otherwise(outcome)
    return outcome


def _report_row(counted: DataFrame, check: Check, failures: Column) -> DataFrame:
    return counted.select(
        F.lit(check.name).alias("check_name"),
        F.lit(check.owner).cast("string").alias("owner"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(failures.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
    ).withColumn("status", _status(check))


def _all_of(*conditions: Column | str | None) -> Column:
    return reduce(lambda a, b: a & b, [as_column(c) for c in conditions if c is not None])


def _failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row: the failures ``_i`` of each predicate check, from a single aggregation."""
    return df.agg(*[F.count_if(_all_of(c.where, c.violation)).alias(f"_{i}") for i, c in enumerate(checks)])


def _keyed_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row: the failures ``_i`` of predicate and key checks, from one scan of the table and one of each parent.

    A row of the table is a row for each key column, and one without a key for all predicates.
    Those are stacked with the keys of the parents, and one aggregation counts each
    value of each column, in the input tasks first.
    """
    columns = list(dict.fromkeys(c.key.column for c in checks if c.key))
    types = [df.select(F.col(c)).schema[0].dataType for c in columns]
    keys = [f"_k{n}" for n in range(len(columns))]
    set_of = {i: columns.index(c.key.column) if c.key else -1 for i, c in enumerate(checks)}
    orphans = [i for i, c in enumerate(checks) if c.key and c.key.parent is not None]
    counted = [_all_of(c.where, c.key.from_condition if c.key else c.violation) for c in checks]
    none = F.lit(0).cast("bigint")
    flagged = df.select(
        *[F.col(c).alias(k) for c, k in zip(columns, keys)],
        *[F.when(flag, F.lit(1).cast("bigint")).otherwise(none).alias(f"_c{i}") for i, flag in enumerate(counted)],
    )

    def entry(of: int) -> Column:
        return F.struct(
            F.lit(of).alias("_set"),
            *[(F.col(k) if n == of else F.lit(None).cast(types[n])).alias(k) for n, k in enumerate(keys)],
            *[(F.col(f"_c{i}") if set_of[i] == of else none).alias(f"_c{i}") for i in set_of],
        )

    entries = F.array(*[entry(of) for of in sorted(set(set_of.values()))])
    rows_of = flagged.select(F.explode(entries).alias("_e")).select("_e.*")
    stacked = rows_of.filter(reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys], F.col("_set") < 0))
    for i in orphans:
        key, name = checks[i].key, keys[set_of[i]]
        parents = key.parent.filter(key.to_condition).filter(F.col(key.field).isNotNull())
        tagged = parents.select(F.lit(set_of[i]).alias("_set"), F.col(key.field).alias(name), F.lit(1).cast("bigint").alias(f"_p{i}"))
        stacked = stacked.unionByName(tagged, allowMissingColumns=True)
    marks = [*[f"_c{i}" for i in set_of], *[f"_p{i}" for i in orphans]]
    values = stacked.groupBy("_set", *keys).agg(*[F.coalesce(F.sum(m), none).alias(m) for m in marks])

    def failures(i: int, check: Check) -> Column:
        here, n = F.col("_set") == set_of[i], F.col(f"_c{i}")
        if check.key and check.key.parent is None:
            return F.count_if(here & (n > 1))
        return F.sum(F.when(here & (F.col(f"_p{i}") == 0) if check.key else here, n))

    return values.agg(*[failures(i, c).alias(f"_{i}") for i, c in enumerate(checks)])


def _one_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All predicate and key checks of a table from one scan of it, one report row each."""
    counts = (_keyed_failures if any(c.key for c in checks) else _failures)(df, checks)
    entries = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(check.owner).cast("string").alias("owner"),
            F.lit(check.severity).alias("severity"),
            F.coalesce(F.col(f"_{i}"), F.lit(0).cast("bigint")).alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    report = counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    by_name = [(F.col("check_name") == check.name, _status(check)) for check in checks]
    status = reduce(lambda chosen, rule: chosen.when(*rule), by_name[1:], F.when(*by_name[0]))
    return report.withColumn("status", status)


def run_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per check: name, owner, severity, failures and status (pass, warn or fail).

    Violations of checks with ``store_as`` are written there as Parquet first,
    and counted from the written table.
    """
    checks = list(checks)
    if len({c.name for c in checks}) != len(checks):
        raise ValueError("check names must differ")
    fused = [c for c in checks if c.fits_one_pass]
    reports = [_one_pass(df, fused)] if fused else []
    for check in checks:
        if check in fused:
            continue
        found = check.violations(df)
        if check.store_as:
            found.write.mode("overwrite").parquet(check.store_as)
            found = df.sparkSession.read.schema(found.schema).parquet(check.store_as)
        reports.append(_report_row(found.agg(F.expr(check.failures).alias("n")), check, F.col("n")))
    if not reports:
        raise ValueError("no checks given")
    return reduce(DataFrame.unionAll, reports)
