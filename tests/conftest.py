import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from streamguard.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


def typed_rows(spark, rows, cols):
    """Hand-written capture rows -> typed frame (conform + standardize)."""
    from streamguard.sources import ingest
    df = spark.createDataFrame(rows, cols)
    return ingest.typed_packets(df)
