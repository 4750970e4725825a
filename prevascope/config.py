"""Names, labels and thresholds.

The operators take everything domain-specific from a :class:`PrevalenceConfig`; the default one
describes counties grouped by state.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# --------------------------------------------------------------------------------------------
# They have to equal the studied pipeline's for its inputs and results to fit.
# --------------------------------------------------------------------------------------------

#: raw column -> staged column, kept as text
KEY_COLUMNS = {
    "stateabbr": "state_code",
    "statedesc": "state_name",
    "countyname": "county_name",
    "countyfips": "county_fips",
}

#: raw column -> staged column, read as whole numbers
POPULATION_COLUMNS = {
    "totalpopulation": "total_population",
    "totalpop18plus": "adult_population",
}

#: raw column -> staged column, read as DECIMAL(5,2) percentages
MEASURE_COLUMNS = {
    "access2_crudeprev": "pct_uninsured",
    "checkup_crudeprev": "pct_healthcare_checkup",
    "arthritis_crudeprev": "pct_arthritis",
    "cancer_crudeprev": "pct_cancer",
    "copd_crudeprev": "pct_copd",
    "diabetes_crudeprev": "pct_diabetes",
    "bphigh_crudeprev": "pct_hypertension",
    "stroke_crudeprev": "pct_stroke",
    "chd_crudeprev": "pct_heart_disease",
    "casthma_crudeprev": "pct_asthma",
    "depression_crudeprev": "pct_depression",
    "binge_crudeprev": "pct_binge_drinking",
    "csmoking_crudeprev": "pct_current_smoker",
    "obesity_crudeprev": "pct_obesity",
    "lpa_crudeprev": "pct_low_physical_activity",
    "mhlth_crudeprev": "pct_mental_health_days",
    "phlth_crudeprev": "pct_physical_health_days",
    "ghlth_crudeprev": "pct_general_health_fair_poor",
    "isolation_crudeprev": "pct_social_isolation",
    "foodinsecu_crudeprev": "pct_food_insecurity",
    "housinsecu_crudeprev": "pct_housing_insecurity",
    "disability_crudeprev": "pct_any_disability",
}

#: raw column -> staged column, passed through
METADATA_COLUMNS = {
    "loaded_at": "data_loaded_timestamp",
    "source_file": "source_filename",
    "extracted_at": "extracted_at",
    "source": "source",
    "dataset_id": "dataset_id",
}

#: staged measure -> label in the long table
LONG_LABELS = {
    "pct_uninsured": "Uninsured",
    "pct_diabetes": "Diabetes",
    "pct_current_smoker": "Current Smoker",
    "pct_obesity": "Obesity",
}

#: source measure codes that get priority
PRIORITY_MEASURES = [
    "ACCESS2", "ARTHRITIS", "BINGE", "COPD", "CSMOKING", "DIABETES", "OBESITY", "STROKE", "CHD",
]

#: accepted group codes
STATE_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT",
    "VA", "WA", "WV", "WI", "WY", "DC",
]

INCOMPLETE, SMALL, VALID = "Incomplete Data", "Small Population", "Valid"

SOURCE_LABEL = "CDC_PLACES"
DATASET_ID = "d3i6-k6z5"
LANDING_PREFIX = "places_county"
LANDING_MARK = "places"
PAGE_SIZE = 50_000
RECENT_ROWS = 10_000
TOP_GROUPS = 20
SAMPLE_ROWS = 10
SMALL_POPULATION_BELOW = 10_000
FLAG_RANGE_SHARE = Decimal("0.1")
MAX_HOURS_OLD = 24
MAX_DAYS_OLD = 7

#: column names the report looks for, first match wins
CASES_CANDIDATES = [
    "cases", "case_count", "confirmed_cases", "covid_cases", "total_cases", "cases_total",
]
DEATHS_CANDIDATES = ["deaths", "death_count", "deaths_total"]
DATE_CANDIDATES = ["date", "report_date", "extracted_at"]
RATE_CANDIDATES = ["weighted_ili", "ili_percent", "weighted_ili_percent"]
GROUP_CANDIDATES = ["state", "state_code", "state_name", "statedesc", "stateabbr"]
POPULATION_CANDIDATES = ["total_population", "population", "total_populaton"]

# --------------------------------------------------------------------------------------------
# Limits of the physical strategies. They choose a plan; no row is ever dropped because of them.
# --------------------------------------------------------------------------------------------

#: group-level tables up to this many rows are broadcast, larger ones are joined by shuffle
BROADCAST_GROUPS = 50_000
#: groups up to this many rows are ranked inside one task, larger ones by a distributed sort
ROWS_PER_TASK = 2_000_000
#: pages that end before this row use a bounded top-k, deeper ones a distributed numbering
SHALLOW_PAGE_END = 100_000
#: top-k queries for more rows than this first narrow the input
NARROW_TOP_ABOVE = 1_000


@dataclass(frozen=True)
class RankedMeasure:
    """A measure that is ranked, profiled and scored, with the names its outputs carry."""

    column: str
    short: str
    #: suffix of the ``min_pct_``/``max_pct_`` columns
    bound: str
    #: compared with the group median and flagged when far above the group mean
    watched: bool = True


@dataclass(frozen=True)
class PrevalenceConfig:
    """Column roles. ``group_cols`` is the profile grain; its first column is the group key."""

    group_cols: tuple[str, ...] = ("state_code", "state_name")
    entity_name: str = "county_name"
    entity_key: str = "county_fips"
    population: str = "total_population"
    measures: tuple[str, ...] = (
        "pct_uninsured", "pct_diabetes", "pct_current_smoker", "pct_obesity", "pct_arthritis",
        "pct_heart_disease", "pct_stroke",
    )
    ranked: tuple[RankedMeasure, ...] = (
        RankedMeasure("pct_diabetes", "diabetes", "diabetes"),
        RankedMeasure("pct_obesity", "obesity", "obesity"),
        RankedMeasure("pct_current_smoker", "smoking", "smoking", watched=False),
    )
    #: measures averaged in the profile, in output order
    averaged: tuple[str, ...] = (
        "pct_uninsured", "pct_diabetes", "pct_obesity", "pct_current_smoker",
        "pct_heart_disease", "pct_stroke", "pct_arthritis",
    )
    group_noun: str = "state"
    entity_plural: str = "counties"
    flag_range_share: Decimal = FLAG_RANGE_SHARE
    small_population_below: int = SMALL_POPULATION_BELOW
    broadcast_groups: int = BROADCAST_GROUPS
    rows_per_task: int = ROWS_PER_TASK

    @property
    def group_key(self) -> str:
        return self.group_cols[0]

    @property
    def watched(self) -> tuple[RankedMeasure, ...]:
        return tuple(m for m in self.ranked if m.watched)

    @property
    def keys(self) -> list[str]:
        """Identifying columns every entity-level model carries, in output order."""
        return [*self.group_cols, self.entity_name, self.entity_key, self.population]


DEFAULT_CONFIG = PrevalenceConfig()
