import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from callpulse.schema import CALL_FIELDS, CALL_SCHEMA  # noqa: E402
from callpulse.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "callpulse-tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__session__timeZone="UTC",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tmp_path_factory.mktemp("shared").as_uri(),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NOON = datetime(2024, 1, 1, 12)


def at(minutes: float) -> datetime:
    return NOON + timedelta(minutes=minutes)


@pytest.fixture
def calls_of(spark):
    """Builds observations from partial rows; ``pub`` and stages in minutes past noon."""

    def build(*rows):
        complete = []
        for index, row in enumerate(rows):
            values = dict.fromkeys(CALL_FIELDS)
            values.update(caseId=str(index), services_name="s", area="a", subarea="b")
            values["ind_forward_service_previous"] = "0"
            for name, value in row.items():
                timed = isinstance(value, (int, float))
                values[name] = at(value) if timed else value
            complete.append(tuple(values[name] for name in CALL_FIELDS))
        return spark.createDataFrame(complete, CALL_SCHEMA)

    return build


@pytest.fixture
def rows():
    def collect(df):
        return sorted(tuple(row) for row in df.collect())

    return collect
