import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourgrid.session import get_spark  # noqa: E402
from hourgrid.spec import DemandSpec  # noqa: E402
from hourgrid.staging import release  # noqa: E402

DATA = os.environ.get("HOURGRID_TESTDATA", "/root/testdata")
START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def spec():
    return DemandSpec()


RAW = (
    "transit_timestamp timestamp_ntz, transit_mode string, station_complex_id string, station_complex string, "
    "borough string, ridership bigint, transfers bigint"
)
GRID = (
    "station_complex_id string, station_complex string, borough string, transit_mode string, "
    "transit_timestamp timestamp_ntz, entries bigint, transfers bigint"
)


@pytest.fixture
def raw_table(spark):
    """(hour, id, ridership, transfers[, mode]) to raw rows."""

    def make(rows, schema=RAW):
        full = []
        for row in rows:
            hour, sid, ridership, transfers = row[:4]
            ts = None if hour is None else START + timedelta(hours=hour)
            mode = row[4] if len(row) > 4 else "subway"
            full.append((ts, mode, sid, f"name {sid}", "Manhattan", ridership, transfers))
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def grid_table(spark):
    """(id, first hour, values) to a gap-free table; names default to the id."""

    def make(*series, names=None, step=timedelta(hours=1)):
        rows = []
        for sid, first, values in series:
            name = (names or {}).get(sid, f"name {sid}")
            for i, value in enumerate(values):
                rows.append((sid, name, "Manhattan", "subway", START + step * (first + i), value, 0))
        return spark.createDataFrame(rows, GRID)

    return make


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(df):
    """Plan text with complete scan details."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
