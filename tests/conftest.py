import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake.session import build_session, shared_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(app="orderlake-tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    shared_root(s)  # sets a local checkpoint folder only where none is configured
    yield s
    s.stop()


@pytest.fixture
def scratch(spark, request):
    from orderlake.session import scratch_path
    return scratch_path(spark, request.node.name.replace("[", "-").replace("]", ""))


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
