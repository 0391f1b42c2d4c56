import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import spark_session
    session = spark_session(8)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loanpanel-test-"))
    from loanpanel.session import tune
    return tune(session)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
