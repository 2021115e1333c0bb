import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    # the shared folder comes from spark.checkpoint.dir; build_session only
    # falls back to a private temp folder when the setting is absent
    s = build_session("local[4]", 8, app_name="tidewater-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from tidewater.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
