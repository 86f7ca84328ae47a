import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session

    scratch = tempfile.mkdtemp(prefix="tillroll-tests-")
    session = build_session(
        "local[8]", app_name="tillroll-tests", shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
               "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tillroll-case-")


def rows(df, order=None):
    """Sorted list of tuples, for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
