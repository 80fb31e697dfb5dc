from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cohortal.config import CohortConfig  # noqa: E402
from cohortal.sources.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staging"))
    session = local_session(8, app="tests", conf={"spark.checkpoint.dir": folder})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return CohortConfig()


def by_key(df, key: str = "patient_pseudo_id") -> dict:
    """Rows of a table with one row per key."""
    found = df.collect()
    assert len({r[key] for r in found}) == len(found), "key repeats"
    return {r[key]: r.asDict() for r in found}


def same_rows(left, right) -> None:
    """Equal as multisets, columns matched by name."""
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
