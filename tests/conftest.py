from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from chainlytics.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as tuples, in the given order or sorted."""
    found = [tuple(r) for r in df.collect()]
    return found if order == ("as is",) else sorted(found, key=repr)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
