"""Every registered query against its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check_queries  # noqa: E402
from pulseboard.plans.catalog import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, folder, name):
    # A few reports are empty on the smallest tables; equal is enough there.
    problem = check_queries.compare(spark, duck, name, folder)
    assert problem in (None, "both empty"), problem


def test_every_query_has_sql():
    assert [name for name, q in QUERIES.items() if not q.sql] == []
