"""Freshness, volume, null and date-range checks over one table, and the gate on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.config import MAX_DAYS_OLD, MAX_HOURS_OLD
from prevascope.functions.casts import is_missing
from prevascope.functions.numeric import hours_between, instant_text, round2, whole_days_between

PASS, FAIL, ERROR = "PASS", "FAIL", "ERROR"

# Check names and field names as they appear in the report.
FRESHNESS, COUNTS, NULLS, DATES = "Data Freshness", "Record Counts", "Null Values Check", "Date Range Check"
CHECK_FIELDS = {
    "name": "string",
    "status": "string",
    "reason": "string",
    "error": "string",
    "last_load": "string",
    "hours_old": "double",
    "places_records": "bigint",
    "total_records": "bigint",
    "null_states": "bigint",
    "null_counties": "bigint",
    "null_diabetes": "bigint",
    "min_date": "string",
    "max_date": "string",
    "distinct_dates": "bigint",
}

#: role -> raw column
RAW_ROLES = {
    "loaded_at": "loaded_at",
    "state": "stateabbr",
    "county": "countyname",
    "diabetes": "diabetes_crudeprev",
}
_NEEDS = {FRESHNESS: ["loaded_at"], COUNTS: [], NULLS: ["state", "county", "diabetes"], DATES: ["loaded_at"]}


class QualityGateError(RuntimeError):
    """The quality report did not pass."""


def count_if_true(predicate: Column) -> Column:
    """Rows for which ``predicate`` holds; 0 on an empty table."""
    return F.coalesce(F.sum(F.when(predicate, 1).otherwise(0)), F.lit(0)).cast("bigint")


def missing_in(roles: Mapping[str, str], columns: list[str]) -> dict[str, Column]:
    """Whether a row lacks its state, county or diabetes measure, for those roles whose columns exist."""
    predicates = {"state": Column.isNull, "county": Column.isNull, "diabetes": is_missing}
    return {role: missing(F.col(roles[role])) for role, missing in predicates.items() if roles[role] in columns}


def _facts(roles: Mapping[str, str], columns: list[str]) -> dict[str, Column]:
    """Everything the checks need, from the columns that exist, for a single aggregate."""
    facts = {"records": F.count(F.lit(1))}
    if roles["loaded_at"] in columns:
        at = F.col(roles["loaded_at"]).try_cast("timestamp")
        facts |= {
            "bad_loads": count_if_true(F.col(roles["loaded_at"]).isNotNull() & at.isNull()),
            "min_load": F.min(at),
            "max_load": F.max(at),
            "load_dates": F.count_distinct(F.to_date(at)),
        }
    return facts | {f"missing_{role}": count_if_true(missing) for role, missing in missing_in(roles, columns).items()}


def _row(number: int, name: str, status: Column, **details: Column) -> Column:
    given = {"name": F.lit(name), "status": status, **details}
    fields = [given.get(f, F.lit(None)).cast(kind).alias(f) for f, kind in CHECK_FIELDS.items()]
    return F.struct(F.lit(number).alias("check_no"), *fields)


def _freshness(as_of: Column, max_hours: float) -> dict[str, Column]:
    last, hours = F.col("max_load"), hours_between(as_of, F.col("max_load"))
    fresh = hours <= F.lit(max_hours)
    return {
        "status": F.when(fresh, PASS).otherwise(FAIL),
        "reason": F.when(last.isNull(), "No data loaded").when(
            ~fresh,
            F.concat(F.lit("Data is "), round2(hours).cast("string"), F.lit(f" hours old (max: {max_hours})")),
        ),
        "last_load": F.when(fresh, instant_text(last)),
        "hours_old": F.when(fresh, round2(hours)),
    }


def _volume() -> dict[str, Column]:
    some = F.col("records") > 0
    return {
        "status": F.when(some, PASS).otherwise(FAIL),
        "reason": F.when(~some, "No records found"),
        "places_records": F.when(some, F.col("records")),
        "total_records": F.when(some, F.col("records")),
    }


def _nulls() -> dict[str, Column]:
    complete = (F.col("missing_state") == 0) & (F.col("missing_county") == 0)
    return {
        "status": F.when(complete, PASS).otherwise(FAIL),
        "null_states": F.col("missing_state"),
        "null_counties": F.col("missing_county"),
        "null_diabetes": F.col("missing_diabetes"),
    }


def _dates(as_of: Column, max_days: int) -> dict[str, Column]:
    last = F.col("max_load")
    recent = whole_days_between(as_of, last) < max_days
    return {
        "status": F.when(recent, PASS).otherwise(FAIL),
        "reason": F.when(last.isNull(), "No date data"),
        "min_date": instant_text(F.col("min_load")),
        "max_date": instant_text(last),
        "distinct_dates": F.when(last.isNotNull(), F.col("load_dates")),
    }


def quality_report(
    df: DataFrame,
    as_of: Column | None = None,
    roles: Mapping[str, str] = RAW_ROLES,
    max_hours: int = MAX_HOURS_OLD,
    max_days: int = MAX_DAYS_OLD,
) -> DataFrame:
    """The four checks as four rows, from one scan with one aggregate.

    ``as_of`` is the time of the check (default: now). A check whose columns the table lacks, or whose load
    times cannot be read, has status ``ERROR``; the others still run.
    """
    facts = df.agg(*[value.alias(name) for name, value in _facts(roles, df.columns).items()])
    return report_of_facts(facts, df.columns, as_of, roles, max_hours, max_days)


def report_of_facts(
    facts: DataFrame,
    columns: list[str],
    as_of: Column | None = None,
    roles: Mapping[str, str] = RAW_ROLES,
    max_hours: int = MAX_HOURS_OLD,
    max_days: int = MAX_DAYS_OLD,
) -> DataFrame:
    """The four checks from the one row of ``facts`` about a table with these columns."""
    as_of = F.current_timestamp() if as_of is None else as_of
    checks = {
        FRESHNESS: lambda: _freshness(as_of, max_hours),
        COUNTS: _volume,
        NULLS: _nulls,
        DATES: lambda: _dates(as_of, max_days),
    }
    rows = []
    for number, (name, details) in enumerate(checks.items(), start=1):
        absent = [roles[r] for r in _NEEDS[name] if roles[r] not in columns]
        if absent:
            rows.append(_row(number, name, F.lit(ERROR), error=F.lit(f"no column {', '.join(absent)}")))
        else:
            found = details()
            if "loaded_at" in _NEEDS[name]:  # a load time that is no time spoils these checks and no other
                bad = F.col("bad_loads") > 0
                text = F.concat(F.col("bad_loads").cast("string"), F.lit(f" values of {roles['loaded_at']} are no timestamps"))
                found = {f: F.when(~bad, c) for f, c in found.items()}
                found |= {"status": F.when(bad, ERROR).otherwise(found["status"]), "error": F.when(bad, text)}
            rows.append(_row(number, name, **found))
    return facts.select(F.inline(F.array(*rows)))


def quality_report_of_table(spark: SparkSession, table: str, **options) -> DataFrame:
    """:func:`quality_report` of a catalog table; every check is ``ERROR`` if it does not exist."""
    if spark.catalog.tableExists(table):
        return quality_report(spark.table(table), **options)
    rows = [
        _row(number, name, F.lit(ERROR), error=F.lit(f"table {table} does not exist"))
        for number, name in enumerate(_NEEDS, start=1)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def freshness(df: DataFrame, ts: str, as_of: Column, max_hours: int = MAX_HOURS_OLD) -> DataFrame:
    """The freshness check alone: status, last load, age in hours, reason."""
    return df.agg(F.max(ts).alias("max_load")).select(
        *[c.alias(name) for name, c in _freshness(as_of, max_hours).items()]
    )


def date_range(df: DataFrame, ts: str, as_of: Column, max_days: int = MAX_DAYS_OLD) -> DataFrame:
    """The date-range check alone: status, first and last date, distinct dates, reason."""
    return df.agg(
        F.min(ts).alias("min_load"),
        F.max(ts).alias("max_load"),
        F.count_distinct(F.to_date(ts)).alias("load_dates"),
    ).select(*[c.alias(name) for name, c in _dates(as_of, max_days).items()])


def null_counts(df: DataFrame, columns: Mapping[str, str], blank_is_null: bool = True) -> DataFrame:
    """Missing values per column in one row; ``columns`` maps column to output name."""
    return df.agg(
        *[
            count_if_true(is_missing(F.col(c)) if blank_is_null else F.col(c).isNull()).alias(out)
            for c, out in columns.items()
        ]
    )


def summary_columns() -> list[Column]:
    """Aggregates that summarise a check table; an ``ERROR`` counts as failed."""
    passed = count_if_true(F.col("status") == PASS)
    failed = count_if_true(F.col("status") != PASS)
    return [
        F.count(F.lit(1)).alias("total_checks"),
        passed.alias("passed"),
        failed.alias("failed"),
        F.when(failed == 0, PASS).otherwise(FAIL).alias("status"),
    ]


def dq_summary(checks: DataFrame) -> DataFrame:
    """Total, passed, failed and overall status."""
    return checks.agg(*summary_columns())


def assert_quality(checks: DataFrame) -> None:
    """Raise :class:`QualityGateError` unless every check passed."""
    failed = checks.where(F.col("status") != PASS).select("name", "status", "reason", "error").collect()
    if failed:
        raise QualityGateError("; ".join(f"{r.name}: {r.status} {r.reason or r.error or ''}".strip() for r in failed))
