import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="stratalake-tests-")
    session = build_session(
        "stratalake-tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Rows(list):
    """Rows in any order: equal to any list with the same rows."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


@pytest.fixture
def rows_of():
    """Rows of a DataFrame as tuples, compared without regard to order."""
    return lambda df: Rows(tuple(row) for row in df.collect())


@pytest.fixture
def table(spark):
    """A DataFrame from a DDL schema and tuples."""

    def make(ddl, *rows):
        return spark.createDataFrame([tuple(r) if isinstance(r, (tuple, list)) else (r,) for r in rows], ddl)

    return make
