import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cabmeter.session import build_session, drop_scratch, shared_dir

    s = build_session("local[*]", 8, "cabmeter-tests")
    # The shared folder comes from the session's spark.checkpoint.dir; only
    # when that is unset does shared_dir give this local session its own.
    shared_dir(s)
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
