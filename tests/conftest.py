import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="6g")
    # Small inputs would otherwise be merged into one part, and nothing would be carried over.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return session


@pytest.fixture(scope="session")
def retail(spark):
    from millrace.sources.history import History

    return History(spark, SF)


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
