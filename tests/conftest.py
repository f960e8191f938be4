import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import checkpoint_dir, local_session

    s = local_session(4, shuffle_partitions=4, app="tidemark-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # tests: a local folder only when the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tidemark.sources.tables import Tables

    return Tables(spark, SF_SMALL)
