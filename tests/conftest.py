import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stepmill.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4)
    session.sparkContext.setLogLevel("OFF")
    ship(session)
    return session


@pytest.fixture
def frame(spark):
    """frame("a bigint, b string", [(1, "x")]) -> DataFrame"""
    return lambda ddl, rows: spark.createDataFrame(rows, ddl)


def values(df, column=None):
    rows = [tuple(row) for row in df.collect()]
    if column is not None:
        at = df.columns.index(column)
        return [row[at] for row in rows]
    return rows
