"""Every query on tables without rows."""

import os

import pyarrow.parquet as pq
import pytest

from callpulse.plans.queries import QUERIES
from conftest import SMALL

#: Results that say 0, by their rows.
COUNTS = {"stream_accounting": [("read", 0), ("set_aside", 0), ("used", 0)]}


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in os.listdir(SMALL):
        pq.write_table(pq.read_table(f"{SMALL}/{name}").slice(0, 0), folder / name)
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows_give_none(spark, empty, name):
    found = QUERIES[name](spark, empty)
    full = COUNTS.get(name, [])
    assert sorted(map(tuple, found.collect())) == full and found.columns
