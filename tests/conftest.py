import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from geonest.session import build_session

    s = build_session(
        app_name="geonest-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests run where no shared folder is configured: use a private one.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="geonest-test-"))
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from geonest.session import new_scratch_dir

    path = new_scratch_dir(spark, "test")
    os.makedirs(path.replace("file:", ""))
    return path
