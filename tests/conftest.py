import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickwise.session import get_session
    s = get_session("local[8]", shuffle_partitions=8,
                    extra={"spark.sql.maxMetadataStringLength": "2000",
                           "tickwise.tables.partitions": "8"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickwise-test-"))
    yield s


@pytest.fixture(scope="module", autouse=True)
def _own_cache(spark):
    """What the tests of a module cache is not found by the plans of the next."""
    yield
    spark.catalog.clearCache()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
