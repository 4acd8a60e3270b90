import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vidlens.session import get_session
    s = get_session("local[4]", 4, app_name="vidlens-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from vidlens.session import scratch_path
    import uuid
    return scratch_path(spark, f"test-{uuid.uuid4().hex}")
