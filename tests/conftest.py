import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cartwheel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(
        "tests", "4", 4,
        **{"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"},
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def rows():
    """Rows as plain tuples of the named columns, sorted, NULL first."""

    def position(row):
        return [(value is not None, 0 if value is None else value) for value in row]

    def take(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=position)

    return take
