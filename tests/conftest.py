import os
import sys

import pytest
from karate import KARATE_LINES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rambler.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def karate(spark):
    from rambler.sources.text import parse_edge_lines
    lines = spark.createDataFrame([(x,) for x in KARATE_LINES], "value string")
    return parse_edge_lines(lines, weighted=False).select("src", "dst", "w")
