import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickfeat.operators.slices import BROADCAST_CUTS_CONF, SLICE_ROWS_CONF  # noqa: E402
from clickfeat.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="clickfeat-tests")
    yield session
    session.stop()


@pytest.fixture(params=["whole", "sliced", "shuffled cuts"])
def slicing(request, spark):
    """Runs a test with whole groups, with groups cut into many slices, and with the cuts joined by shuffling."""
    rows, cuts = {"whole": (None, None), "sliced": (3, None), "shuffled cuts": (2, 0)}[request.param]
    for conf, value in ((SLICE_ROWS_CONF, rows), (BROADCAST_CUTS_CONF, cuts)):
        if value is not None:
            spark.conf.set(conf, str(value))
    yield request.param
    spark.conf.unset(SLICE_ROWS_CONF)
    spark.conf.unset(BROADCAST_CUTS_CONF)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
