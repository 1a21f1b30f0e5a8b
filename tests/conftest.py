import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradewind.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def database(spark, tmp_path):
    """A database in its own folder, named after the test run."""
    name = f"db_{os.path.basename(tmp_path).lower().replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df, *order):
    """Collected rows as tuples in a stable order."""
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=lambda t: tuple((v is None, str(v)) for v in t))
