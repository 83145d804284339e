import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from callsheet.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, app_name="callsheet-tests")
    checkpoint_dir(s)  # only sets a scratch folder when the session has none
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_of_other_modules(spark):
    """The catalog lists temp views beside the tables of any namespace."""
    for t in spark.catalog.listTables():
        if t.isTemporary:
            spark.catalog.dropTempView(t.name)
