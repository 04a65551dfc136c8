"""Data-quality checks.

Result schema of every check: ``check, table, column, severity, failures,
status`` with ``status`` = ``pass`` or the check's severity (``warn`` /
``error``) when it finds failures.

Physical shape of :func:`run_checks`: all checks of a table come from **one**
scan. A row gives one value per unique column and one mark per check that it
fails; these are counted by value in one hash aggregate that starts in every
scan task (a hot value and all marks of a check collapse there), and the counts
become one row. Without unique columns ``count_if`` per check is enough: a
single-row exchange. Referential checks are a left-anti join. Nothing is
collected: the result is a small DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argent.functions.exprs import (
    EMAIL_PATTERN_TEST, full_match, lit_ts, type_of,
)

ROW_KINDS = ("not_null", "in_range", "not_after", "matches", "positive", "valid_email")
RESULT_COLUMNS = ("check", "table", "column", "severity", "failures", "status")


@dataclass(frozen=True)
class Check:
    kind: str                       # unique / not_null / in_range / not_after / matches / positive / has_type / valid_email
    column: str
    severity: str = "error"         # error fails the run, warn only reports
    min_value: Any = None           # in_range bounds, inclusive; None = open
    max_value: Any = None
    pattern: Optional[str] = None   # matches
    expected_type: Optional[str] = None  # has_type

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}".lower()


def unique(column: str, severity: str = "error") -> Check:
    return Check("unique", column, severity)


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", column, severity)


def in_range(column: str, min_value=None, max_value=None, severity: str = "error") -> Check:
    return Check("in_range", column, severity, min_value=min_value, max_value=max_value)


def not_after(column: str, severity: str = "warn") -> Check:
    """Value not later than the run's date (midnight; quirk Q8)."""
    return Check("not_after", column, severity)


def matches(column: str, pattern: str, severity: str = "warn") -> Check:
    return Check("matches", column, severity, pattern=pattern)


def positive(column: str, severity: str = "error") -> Check:
    return Check("positive", column, severity)


def has_type(column: str, expected_type: str, severity: str = "error") -> Check:
    return Check("has_type", column, severity, expected_type=expected_type)


def valid_email(column: str, severity: str = "error") -> Check:
    return Check("valid_email", column, severity)


def failure_condition(check: Check, as_of=None) -> Column:
    """The row-level predicate that flags a failing row. NULL never fails
    except for ``not_null``; a NULL predicate counts as passing."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "in_range":
        ok = F.lit(True)
        if check.min_value is not None:
            ok = ok & (c >= F.lit(check.min_value))
        if check.max_value is not None:
            ok = ok & (c <= F.lit(check.max_value))
        return ~ok
    if check.kind == "not_after":
        today = lit_ts(str(as_of)[:10]) if as_of is not None else F.current_date().cast("timestamp_ntz")
        return ~(c <= today)
    if check.kind == "matches":
        return ~c.rlike(full_match(check.pattern))
    if check.kind == "positive":
        return c.isNotNull() & (c <= 0)
    if check.kind == "valid_email":
        return c.isNotNull() & ~c.rlike(full_match(EMAIL_PATTERN_TEST))
    raise ValueError(f"not a row-level check: {check.kind}")


def _result(check_name: Column, table: str, column: Column, severity: Column, failures: Column) -> list:
    return [check_name.alias("check"), F.lit(table).alias("table"), column.alias("column"),
            severity.alias("severity"), failures.cast("long").alias("failures"),
            F.when(failures > 0, severity).otherwise(F.lit("pass")).alias("status")]


def _fails(check: Check, as_of=None) -> Column:
    if check.kind == "has_type":
        return type_of(check.column) != F.lit(str(check.expected_type).upper())
    return failure_condition(check, as_of)


def row_checks(df: DataFrame, checks: Sequence[Check], table: str, as_of=None) -> DataFrame:
    """All row-level checks of one table in a single aggregate pass."""
    checks = [c for c in checks if c.kind in ROW_KINDS]
    counts = df.agg(*[F.count_if(F.coalesce(failure_condition(c, as_of), F.lit(False))).alias(f"_c{i}")
                      for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("n"), F.lit(c.column).alias("c"), F.lit(c.severity).alias("s"),
                              F.col(f"_c{i}").alias("f")) for i, c in enumerate(checks)])
    r = counts.select(F.inline(rows))
    return r.select(*_result(F.col("n"), table, F.col("c"), F.col("s"), F.col("f")))


def duplicate_groups(df: DataFrame, column: str) -> DataFrame:
    """A2: values (not NULL) that occur more than once, with their counts."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def unique_check(df: DataFrame, check: Check, table: str) -> DataFrame:
    """failures = number of duplicate groups."""
    n = duplicate_groups(df, check.column).agg(F.count(F.lit(1)).alias("f"))
    return n.select(*_result(F.lit(check.name), table, F.lit(check.column), F.lit(check.severity), F.col("f")))


def type_check(df: DataFrame, check: Check, table: str) -> DataFrame:
    """Compare the column's type name case-insensitively on one row of
    the table; an empty table passes."""
    bad = type_of(check.column) != F.lit(str(check.expected_type).upper())
    one = df.select(bad.alias("bad")).limit(1).agg(F.count_if("bad").alias("f"))
    return one.select(*_result(F.lit(check.name), table, F.lit(check.column), F.lit(check.severity), F.col("f")))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_cond: Optional[Column] = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row meeting ``parent_cond``.

    Spelled as a left-anti join (the long form, left join + IS NULL, is not
    rewritten to an anti join by the optimizer).
    """
    p = parent.where(parent_cond) if parent_cond is not None else parent
    # Distinct parent keys: repeats collapse map-side (partial aggregation)
    # and the join reuses the aggregate's partitioning by key.
    return child.where(F.col(key).isNotNull()).join(p.select(key).distinct(), key, "left_anti")


def references(child: DataFrame, parent: DataFrame, key: str, table: str, parent_cond: Optional[Column] = None,
               severity: str = "error", name: Optional[str] = None) -> DataFrame:
    """Referential check as a result row (failures = orphan child rows).

    Child rows are first counted per key (partial aggregation map side, so a
    key holding a large share of the rows becomes one row per task), then the
    distinct keys are anti-joined with the parent and their counts summed.
    """
    p = parent.where(parent_cond) if parent_cond is not None else parent
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    n = per_key.join(p.select(key).distinct(), key, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("f"))
    return n.select(*_result(F.lit(name or f"references_{key}".lower()), table, F.lit(key),
                             F.lit(severity), F.col("f")))


def run_checks(df: DataFrame, checks: Sequence[Check], table: str, as_of=None) -> DataFrame:
    """A4: every check of one table -> result rows, from one scan.

    Type checks count as failed once, and pass on an empty table."""
    row = [c for c in checks if c.kind != "unique"]
    keys = list(dict.fromkeys(c.column for c in checks if c.kind == "unique"))
    if not keys:
        failed = [F.count_if(F.coalesce(_fails(c, as_of), F.lit(False))) for c in row]
        counts = df.agg(*[(F.least(f, F.lit(1)) if c.kind == "has_type" else f).alias(f"_c{i}") for i, (c, f) in enumerate(zip(row, failed))])
    else:
        def mark(number: int, key: Optional[str] = None) -> Column:
            return F.struct(F.lit(number).alias("g"), *[(F.col(k) if k == key else F.lit(None).cast(df.schema[k].dataType)).alias(f"u{j}") for j, k in enumerate(keys)])
        marks = [F.when(_fails(c, as_of), mark(i)) for i, c in enumerate(row)]
        marks += [F.when(F.col(k).isNotNull(), mark(len(row) + j, k)) for j, k in enumerate(keys)]
        found = df.select(F.explode(F.array(*marks)).alias("m")).where("m is not null").select("m.*")
        found = found.groupBy("g", *[f"u{j}" for j in range(len(keys))]).agg(F.count(F.lit(1)).alias("n"))
        g, n = F.col("g"), F.col("n")
        sums = [F.coalesce(F.sum(F.when(g == i, F.least(n, F.lit(1)) if c.kind == "has_type" else n)), F.lit(0)).alias(f"_c{i}") for i, c in enumerate(row)]
        counts = found.agg(*sums, *[F.count_if((g == len(row) + j) & (n > 1)).alias(f"_u{j}") for j in range(len(keys))])
    slot = {id(c): f"_c{i}" for i, c in enumerate(row)}
    out = [F.struct(F.lit(c.name).alias("n"), F.lit(c.column).alias("c"), F.lit(c.severity).alias("s"),
                    F.col(slot.get(id(c)) or f"_u{keys.index(c.column)}").cast("long").alias("f")) for c in checks]
    return counts.select(F.inline(F.array(*out))).select(*_result(F.col("n"), table, F.col("c"), F.col("s"), F.col("f")))


def run_status(results: DataFrame) -> DataFrame:
    """Roll-up of a run. ``error`` if any error-severity check failed,
    else ``warn`` if a warning fired, else ``pass``; warnings are not promoted."""
    return results.agg(
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
        F.count_if(F.col("status") == "pass").alias("passed"),
    ).select("errors", "warnings", "passed",
             F.when(F.col("errors") > 0, F.lit("error"))
              .when(F.col("warnings") > 0, F.lit("warn")).otherwise(F.lit("pass")).alias("run_status"))


# ---------------------------------------------------------------------------
# Source freshness
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Freshness:
    warn_minutes: int
    error_minutes: int


def freshness(df: DataFrame, source: str, loaded_at: str, rule: Freshness, as_of=None) -> DataFrame:
    """A3 + D10: newest load time of a source, its age in minutes and status.

    A partial ``max`` in every scan task, one row out. For a stored table
    ``silver_table.newest`` gives the same row from the files' footers:
    :func:`freshness_of`.
    """
    return freshness_of(df.agg(F.max(loaded_at).alias("max_loaded_at")), source, rule, as_of)


def freshness_of(newest: DataFrame, source: str, rule: Freshness, as_of=None) -> DataFrame:
    """Age and status of a source from its newest load time (one row, ``max_loaded_at``)."""
    from argent.functions.exprs import as_of_ts
    now = as_of_ts(as_of)
    micros = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now)
    age = micros / 60_000_000.0
    return newest.select(F.lit(source).alias("source"), "max_loaded_at", age.alias("age_minutes")).select(
        "source", "max_loaded_at", "age_minutes",
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(F.col("age_minutes") > rule.error_minutes, F.lit("error"))
         .when(F.col("age_minutes") > rule.warn_minutes, F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"))
