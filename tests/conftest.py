import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tableferry.session import build_session

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session(
        master="local[4]",
        shuffle_partitions=8,
        extra={
            "spark.driver.extraJavaOptions": f"-Dderby.stream.error.file={scratch}/derby.log",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def source(spark):
    from tableferry.sources.tables import read_database

    return read_database(spark, SF_SMALL)
