import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lexispark.session import local_session, shared_dir

    s = local_session(4, shuffle_partitions=4, app="lexispark-tests")
    shared_dir(s)  # sets spark.checkpoint.dir only where it is unset
    yield s
    s.stop()


@pytest.fixture()
def corpus(spark):
    """Build an ephemeral index from a list of (id, header_key, text)."""
    from lexispark.operators.indexing import build_index

    def make(rows):
        df = spark.createDataFrame(rows, "id string, header_key string, text string")
        return build_index(df)

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]


def ids(df):
    return [r.id for r in df.collect()]
