import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from prevascope.session import build_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="test-warehouse-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


COUNTY = (
    "state_code string, state_name string, county_name string, county_fips string, total_population int, "
    "pct_uninsured decimal(5,2), pct_diabetes decimal(5,2), pct_current_smoker decimal(5,2), "
    "pct_obesity decimal(5,2), pct_arthritis decimal(5,2), pct_heart_disease decimal(5,2), pct_stroke decimal(5,2)"
)


@pytest.fixture(scope="session")
def counties(spark):
    """Staged rows from ``(state, county, fips, population, diabetes, obesity, smoking)`` tuples."""
    from decimal import Decimal

    def number(text):
        return None if text is None else Decimal(str(text))

    def build(*rows, state_name=None):
        full = []
        for state, county, fips, population, diabetes, obesity, smoking in rows:
            name = (state_name or {}).get(fips, f"State {state}")
            measures = [None, number(diabetes), number(smoking), number(obesity), None, None, None]
            full.append((state, name, county, fips, population, *measures))
        return spark.createDataFrame(full, COUNTY)

    return build


@pytest.fixture(scope="session")
def plan_of():
    """Text of the physical plan, adaptive parts included."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
