"""Quality facts taken while a load is written and kept with it, so that the checks need no scan of what is loaded.

The facts of a load are one JSON text. Those of several loads combine: counts add up, first and last load times are the least and
the greatest, and the days are distinct over all of them (a load has few).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prevascope.operators.quality import RAW_ROLES, count_if_true, missing_in

#: Load times in microseconds and days since 1970.
FACTS = (
    "records bigint, bad_loads bigint, first_load bigint, last_load bigint, load_days array<int>, "
    "missing_state bigint, missing_county bigint, missing_diabetes bigint"
)


def load_facts(columns: list[str], roles: Mapping[str, str] = RAW_ROLES) -> Column:
    """An aggregate that gives the facts of a load with these columns; a column that it lacks is missing in all its rows."""
    facts = {"records": F.count(F.lit(1))}
    if roles["loaded_at"] in columns:
        at = F.col(roles["loaded_at"]).try_cast("timestamp")
        facts |= {
            "bad_loads": count_if_true(F.col(roles["loaded_at"]).isNotNull() & at.isNull()),
            "first_load": F.unix_micros(F.min(at)),
            "last_load": F.unix_micros(F.max(at)),
            "load_days": F.collect_set(F.unix_date(F.to_date(at))),
        }
    facts |= {f"missing_{role}": count_if_true(broken) for role, broken in missing_in(roles, columns).items()}
    return F.to_json(F.struct(*[value.alias(name) for name, value in facts.items()]))


def combined(loads: DataFrame) -> DataFrame:
    """One row with the facts of all ``loads`` (facts), as the checks of a whole table take them; zeros and nulls without any."""
    each = loads.select(F.from_json("facts", FACTS).alias("f")).select("f.*")
    days = each.select("*", F.posexplode_outer("load_days").alias("at", "day"))
    once = lambda value: F.when(F.coalesce("at", F.lit(0)) == 0, value)  # noqa: E731  a load's first row counts
    total = lambda value: F.coalesce(F.sum(once(value)), F.lit(0)).cast("bigint")
    return days.agg(
        total(F.col("records")).alias("records"),
        total(F.coalesce("bad_loads", F.lit(0))).alias("bad_loads"),
        F.timestamp_micros(F.min("first_load")).alias("min_load"),
        F.timestamp_micros(F.max("last_load")).alias("max_load"),
        F.count_distinct("day").alias("load_dates"),
        *[total(F.coalesce(f"missing_{r}", "records")).alias(f"missing_{r}") for r in ("state", "county", "diabetes")],
    )
