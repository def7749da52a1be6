import contextlib
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from panelwatch.session import get_session

    s = get_session("local[8]", "panelwatch-tests", shuffle_partitions=8, driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(params=[1, 16])
def ranges(spark, request):
    """Number of range partitions that ordered scans cut their rows into."""
    with as_many_ranges(spark, request.param):
        yield request.param


@contextlib.contextmanager
def as_many_ranges(spark, n):
    """Ordered scans cut their rows into ``n`` ranges: small neighbours are not merged."""
    new = {"spark.sql.shuffle.partitions": n, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)
