import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tablelift.session import get_spark

    import tempfile

    # tests only: keep the catalog's default warehouse out of the working directory
    s = get_spark("local[*]", **{"spark.sql.shuffle.partitions": "8",
                                 "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tablelift-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tablelift.session import scratch_path

    return scratch_path(spark, "test")
