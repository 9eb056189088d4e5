import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shoplens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {"spark.sql.maxMetadataStringLength": "10000"}
    if not os.environ.get("SHOPLENS_TEST_KEEP_CKPT"):
        # tests set their own checkpoint folder; a cluster would name one
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="shoplens-test-ckpt-")
    session = build_session("local[*]", app_name="shoplens-tests", shuffle_partitions=8, extra=extra)
    yield session
    session.stop()
